"""Shared helpers."""

from pyspark.sql import functions as F

from panelrank.llm.common import discard, lower_ascii, stored, words_col


def test_words(spark):
    df = spark.createDataFrame([(" a\tB\x0bc\x1cd \n",), (None,), ("",)], "text string")
    assert [r.w for r in df.select(words_col(lower_ascii(F.col("text"))).alias("w")).collect()] == [["a", "b", "c\x1cd"], [], []]


def test_stored_and_discarded(spark):
    df = stored(spark.range(5), "numbers")
    assert df.count() == 5 and df.inputFiles()
    discard(spark, df)
    assert spark.range(1).count() == 1
