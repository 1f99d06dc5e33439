"""Small helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.functions.tables import discard, stored

__all__ = ["arrow_batches", "lean_disk", "discard", "lower_ascii", "packed", "stored", "table", "unpacked", "words_col"]

#: Word separators of every contract: space and the control characters 9 to 13.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def words_col(text: Column) -> Column:
    """The words of a text column as an array; null and blank texts give an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_SPLIT)
    return F.filter(parts, lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def arrow_batches(spark: SparkSession, size: str = "8m"):
    """Python workers get batches of at most `size` bytes in jobs that run inside."""
    return _set(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": size})


def lean_disk(spark: SparkSession):
    """Jobs that run inside delete their shuffle files when they end, and write their tables with zstd. No result may be run twice."""
    return _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"})


def packed(docs: DataFrame, own: list[str], **more: Column) -> DataFrame:
    """The columns `own`, those of `more`, computed on `docs`, and all others of `docs` in one struct, `rest`.

    Operators add columns to this without meeting a name of the caller's.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    rest = F.struct(*others) if others else F.struct(F.lit(True).alias("none"))
    return docs.select(*own, *(c.alias(n) for n, c in more.items()), rest.alias("rest"))


def unpacked(df: DataFrame, made: dict[str, Column], first: list[str] = ()) -> DataFrame:
    """The columns `first`, those in `rest`, and `made`, which replaces columns of these names."""
    fields = [f for f in df.schema["rest"].dataType.names if f not in made and f not in first]
    if fields == ["none"] and not df.schema["rest"].dataType["none"].nullable:
        fields = []
    return df.select(*first, *(F.col("rest").getField(f).alias(f) for f in fields), *(c.alias(n) for n, c in made.items()))
