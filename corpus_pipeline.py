"""Corpus pipeline: toxicity, line dedup, n-gram Jaccard join, benchmark decontamination, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelrank.llm import stages
from panelrank.llm.common import stored, table

#: (name, function) in order; a function takes (spark, docs, sf_dir) and returns the next one's documents.
STAGES = [
    ("toxicity", stages.without_toxic),
    ("line_dedup", stages.without_repeated_lines),
    ("ngram_jaccard_join", stages.without_near_copies),
    ("benchmark_decontamination", stages.without_benchmarks),
    ("byte_bpe", stages.tokenized),
]

#: SQL cannot express the first and last stages; their operators have brute-force tests, and `run` is tested on planted documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each result is written and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, name)
    return docs
