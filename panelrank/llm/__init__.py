"""Training-data operators: deduplication, decontamination, filtering, tokenizing and scoring of text tables.

Each operator is a module with a function from DataFrames to a DataFrame. Nothing outside this
subpackage imports it. `queries.py` registers the thin queries over the given tables.
"""
