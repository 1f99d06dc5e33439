"""Windows over a symbol's rows with a least count, ranks inside a date, and ranks over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelrank.functions.tables import stored


def by_symbol() -> Window:
    """A symbol's rows by date; made on use, as windows need a session."""
    return Window.partitionBy("symbol").orderBy("date")


def last_rows(n: int) -> Window:
    return by_symbol().rowsBetween(1 - n, 0)


def rolling(agg, x: Column | str, n: int, least: int | None = None) -> Column:
    """`agg` of the last n rows, null with fewer than `least` (default: n) known values among them."""
    x = F.col(x) if isinstance(x, str) else x
    w = last_rows(n)
    return F.when(F.count(x).over(w) >= (n if least is None else least), agg(x).over(w))


def rolling_pair(agg, x: str, y: str, n: int) -> Column:
    """`agg` of two columns over the last n rows in which both are known."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b, w = F.when(both, F.col(x)), F.when(both, F.col(y)), last_rows(n)
    return F.when(F.count(a).over(w) >= n, agg(a, b).over(w))


def rank_pct(x: Column | str, *by: str, ascending: bool = True) -> Column:
    """Percentile rank with the mean rank for ties, as a share of the known values; null where x is null."""
    x = F.col(x) if isinstance(x, str) else x
    order = x.asc_nulls_last() if ascending else x.desc_nulls_last()
    rank = F.rank().over(Window.partitionBy(*by).orderBy(order)) + (F.count(x).over(Window.partitionBy(*by, x)) - 1) / 2
    return F.when(x.isNotNull(), rank / F.count(x).over(Window.partitionBy(*by)))


def mean_rank(x: Column | str, *by: str) -> Column:
    """Descending rank, ties with their mean."""
    x = F.col(x) if isinstance(x, str) else x
    rank = F.rank().over(Window.partitionBy(*by).orderBy(x.desc_nulls_last()))
    return F.when(x.isNotNull(), rank + (F.count(x).over(Window.partitionBy(*by, x)) - 1) / 2)


def first_rank(x: Column | str, *by: str) -> Column:
    """Descending rank, ties by symbol; null where x is null."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x.isNotNull(), F.row_number().over(Window.partitionBy(*by).orderBy(x.desc_nulls_last(), "symbol")))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their number from 1 in an order of all rows, without a task that holds them all.

    Rows are dealt out by ranges of the order and written; the ranges are counted, and a row's number is that inside its range
    after all rows of the ranges before. `order` must be total.
    """
    dealt = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))  # a row a range
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn(name, inside).join(before, "_range").withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")
