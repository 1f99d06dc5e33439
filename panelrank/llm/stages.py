"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir), and all but the last keep the columns of documents.

Nulls in any column, empty and long texts, repeated rows, rows that share an id and empty tables are taken; what becomes of
them stands with each stage. Extra columns of any name pass through all stages but the last, which gives digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.llm import decontaminate, line_dedup, ngram_join, queries, toxicity
from panelrank.llm.common import packed, stored, table, unpacked


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose score reaches the threshold; null and empty texts score as texts without evidence.

    Learns from the labelled documents outside the held-out quarter.
    """
    scored = toxicity.score(packed(docs, ["doc_id", "text"]), queries.toxicity_model(spark, docs, sf_dir))
    return unpacked(scored.where(F.col("score") < queries.TOXIC), {}, ["doc_id", "text"]).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated chunks of lines, then repeated blocks of two lines or more; a document of which nothing is left goes.

    The first place of a block, by (doc_id, text hash, position), stays. `n_chars` of changed texts is counted anew. Null and
    empty texts and those of one line stay as they are; rows equal in id and text share one decision.
    """
    mine = packed(docs, ["doc_id", "text"])
    chunked = line_dedup.line_dedup(mine).where(~F.col("emptied")).select("doc_id", "text", "rest", (F.col("n_removed_chunks") > 0).alias("cut"))
    left = line_dedup.block_dedup(stored(chunked, "chunked")).where(~F.col("emptied"))
    changed = F.col("cut") | (F.col("n_removed_lines") > 0)
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("rest").getField("n_chars")).cast(docs.schema["n_chars"].dataType)
    return unpacked(left, {"n_chars": n_chars}, ["doc_id", "text"]).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked documents: that of the least id, of equal ids that of the least text hash.

    Null ids come last. Of repeated rows, equal in id and text, one stays. Texts without words are linked with nothing.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"))
    found = ngram_join.near_duplicates(docs.select(key.alias("doc_id"), "text"), count_links=False)
    rows = stored(found.groupBy("doc_id").agg(F.min("component_id").alias("least"), F.count("*").alias("n")), "decided")
    gone = rows.where(F.col("least") != F.col("doc_id")).select(F.col("doc_id").alias("is_gone"))
    mine = packed(docs, ["doc_id", "text"], key=key)
    left = mine.join(gone, F.col("key") == F.col("is_gone"), "left_anti")
    repeated = stored(rows.where((F.col("least") == F.col("doc_id")) & (F.col("n") > 1)).select(F.col("doc_id").alias("again")), "repeated")
    if repeated.head(1):
        again = mine.join(repeated, F.col("key") == F.col("again"), "left_semi").dropDuplicates(["key"])
        left = left.join(repeated, F.col("key") == F.col("again"), "left_anti").unionByName(again)
    return unpacked(left, {}, ["doc_id", "text"]).select(*docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds a benchmark passage, whatever their id; null and empty texts stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the bytes decoded from them."""
    return queries.bpe_digests(docs)
