"""Daily bars and their companions, derived from the driver's tables: a brand is a symbol.

Prices are summed as decimals, so the bars are the same whatever the order of the rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bars(spark: SparkSession, sf_dir: str, date_column: str = "l_shipdate", returnflag: str | None = None) -> DataFrame:
    """date, symbol, open, high, low, close (mean price of 30 rows), volume, quote_volume."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("symbol"))
    lines = table(spark, sf_dir, "lineitem")
    if returnflag:
        lines = lines.where(F.col("l_returnflag") == returnflag)
    if date_column == "o_orderdate":
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    trades = lines.select("l_partkey", F.to_date(date_column).alias("date"), "l_quantity", F.col("l_extendedprice").cast("decimal(18,2)").alias("notional"))
    daily = (
        trades.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("symbol", "date")
        .agg(F.sum("l_quantity").alias("volume"), F.sum("notional").alias("notional"))
    )
    by_date = W.partitionBy("symbol").orderBy("date")
    w = by_date.rowsBetween(-29, 0)
    priced = daily.withColumn("close", F.sum("notional").over(w).cast("double") / F.sum("volume").over(w))
    opened = priced.withColumn("open", F.coalesce(F.lag("close").over(by_date), "close"))
    return opened.select(
        "date", "symbol", "open", F.greatest("open", "close").alias("high"), F.least("open", "close").alias("low"), "close", "volume", F.col("notional").cast("double").alias("quote_volume")
    )


def dense_bars(history: DataFrame) -> DataFrame:
    """Every calendar day of each symbol from its first bar on; filled days repeat the close and have no volume."""
    span = history.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    spine = history.select("symbol").distinct().crossJoin(F.broadcast(span)).select("symbol", F.explode(F.sequence("a", "b")).alias("date"))
    w = W.partitionBy("symbol").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    filled = spine.join(history, ["symbol", "date"], "left").withColumn("last", F.last("close", ignorenulls=True).over(w)).where("last is not null")
    price = lambda c: F.coalesce(c, "last").alias(c)
    return filled.select("date", "symbol", price("open"), price("high"), price("low"), price("close"), F.coalesce("volume", F.lit(0.0)).alias("volume"), F.coalesce("quote_volume", F.lit(0.0)).alias("quote_volume"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.col("p_brand")
    return table(spark, sf_dir, "part").select(brand.alias("symbol")).distinct().select(
        "symbol",
        F.col("symbol").alias("base_asset"),
        F.lit("USDT").alias("quote_asset"),
        F.when(F.col("symbol") == "Brand#25", "BREAK").otherwise("TRADING").alias("status"),
        (F.col("symbol") != "Brand#24").alias("is_spot_trading_allowed"),
    )


def market_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("symbol")).agg(F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double").alias("market_cap_usd"))
    return cap.withColumn("market_cap_rank", F.row_number().over(W.orderBy(F.desc("market_cap_usd"), "symbol")))


BARS_SQL = """
trades AS (
  SELECT p_brand AS symbol, CAST({date} AS DATE) AS date, CAST(l_extendedprice AS DECIMAL(18,2)) AS notional, l_quantity AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey {more}),
daily AS (SELECT symbol, date, sum(qty) AS volume, sum(notional) AS notional FROM trades GROUP BY symbol, date),
vw AS (SELECT *, CAST(sum(notional) OVER w AS DOUBLE) / sum(volume) OVER w AS close FROM daily
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
oc AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY date), close) AS open FROM vw),
{name} AS (SELECT date, symbol, open, greatest(open, close) AS high, least(open, close) AS low, close, volume, CAST(notional AS DOUBLE) AS quote_volume FROM oc)"""


def bars_sql(name: str = "bars", date: str = "l_shipdate", more: str = "") -> str:
    """The same as SQL common table expressions, for the oracles."""
    text = BARS_SQL.format(name=name, date=date, more=more)
    if name != "bars":
        for cte in ("trades", "daily", "vw", "oc"):
            text = text.replace(f"{cte} AS", f"{cte}_{name} AS").replace(f"FROM {cte}", f"FROM {cte}_{name}")
    return text.strip()


META_SQL = """
meta AS (SELECT DISTINCT p_brand AS symbol, p_brand AS base_asset, 'USDT' AS quote_asset,
  CASE WHEN p_brand = 'Brand#25' THEN 'BREAK' ELSE 'TRADING' END AS status, p_brand <> 'Brand#24' AS is_spot_trading_allowed FROM part)""".strip()
