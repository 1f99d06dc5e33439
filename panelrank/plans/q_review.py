"""Queries of the review tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.functions import nulls
from panelrank.operators import history, review
from panelrank.plans import panel as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
B = "WITH " + fixtures.bars_sql()


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


@query("a15_track_metrics", B + """, m AS (SELECT symbol AS track, date, CASE WHEN day(date) % 3 = 0 THEN close END AS a, open AS b, low - high AS d FROM bars),
v AS (SELECT *, coalesce(a, b) AS sharpe, abs(d) AS dd, row_number() OVER (PARTITION BY track ORDER BY date DESC) AS r FROM m)
SELECT track, 'sharpe' AS metric, round(max(sharpe) FILTER (r = 1), 5) AS current, round(avg(sharpe), 5) AS baseline FROM v GROUP BY track
UNION ALL SELECT track, 'max_dd', round(max(dd) FILTER (r = 1), 5), round(avg(dd), 5) FROM v GROUP BY track""")
def track_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.bars(spark, sf_dir).select(F.col("symbol").alias("track"), "date", F.when(F.dayofmonth("date") % 3 == 0, F.col("close")).alias("sharpe_ratio"), F.col("open").alias("sharpe"), (F.col("low") - F.col("high")).alias("max_drawdown"))
    out = review.track_metrics(rows, {"sharpe": ["sharpe_ratio", "sharpe"], "max_dd": ["max_drawdown"]}, "date")
    return out.withColumns({c: F.round(c, 5) for c in ("current", "baseline")})


@query("a16_a17_tidy_and_wide", B + """, d AS (SELECT DISTINCT date FROM bars), s AS (SELECT DISTINCT symbol FROM bars)
SELECT d.date, s.symbol AS metric, round(close, 6) AS value FROM d CROSS JOIN s LEFT JOIN bars ON bars.date = d.date AND bars.symbol = s.symbol""")
def tidy_and_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = review.wide_field(fixtures.bars(spark, sf_dir), "close")
    return review.tidy(wide, ["date"]).withColumn("value", F.round("value", 6))


@query("h5_selection_boundary", P.sql("rules", """
, c AS (SELECT date, symbol, final_score, current_rank, row_number() OVER (PARTITION BY date ORDER BY current_rank NULLS LAST, coalesce(nullif(final_score, 0), '-inf'::DOUBLE) DESC, coalesce(nullif(confidence, 0), '-inf'::DOUBLE) DESC,
  coalesce(nullif(liquidity_stability, 0), '-inf'::DOUBLE) DESC, coalesce(nullif(avg_quote_vol_180, 0), '-inf'::DOUBLE) DESC, upper(symbol)) AS p, count(*) OVER (PARTITION BY date) AS n FROM scored),
z AS (SELECT date, max(symbol) FILTER (p = least(5, n)) AS cutoff_symbol, max(final_score) FILTER (p = least(5, n)) AS cutoff_score, max(symbol) FILTER (p = least(5, n) + 1) AS next_symbol, max(final_score) FILTER (p = least(5, n) + 1) AS next_score FROM c GROUP BY date)
SELECT date, cutoff_symbol, round(cutoff_score, 6) AS cutoff_score, next_symbol, round(next_score, 6) AS next_score, round(cutoff_score - next_score, 6) AS score_gap_to_next FROM z""".lstrip()))  # fmt: skip
def boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = review.selection_boundary(P.scored_panel(spark, sf_dir), 5)
    return out.withColumns({c: F.round(c, 6) for c in ("cutoff_score", "next_score", "score_gap_to_next")})


def _pools(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Tracks by month: pools by volume, by return, and one that lacks every third month."""
    bars = fixtures.bars(spark, sf_dir).withColumn("ret", F.col("close") / F.col("open"))
    last = bars.groupBy(F.date_trunc("month", "date").alias("u")).agg(F.max("date").alias("date")).select("date")
    at = bars.join(last, "date")
    out = None
    for track, key in (("by_volume", "quote_volume"), ("by_return", "ret"), ("sparse", "volume")):
        r = F.row_number().over(Window.partitionBy("date").orderBy(F.desc(key), "symbol"))
        one = at.where(F.month("date") % 3 != 0) if track == "sparse" else at
        pools = one.withColumn("r", r).where(F.col("r") <= n).groupBy("date").agg(F.array_sort(F.collect_list(F.struct("r", "symbol")))["symbol"].alias("symbols"))
        pools = pools.select(F.lit(track).alias("track"), F.datediff("date", F.lit("1970-01-01")).alias("pos"), F.col("date").alias("as_of_date"), F.concat_ws("-", F.col("date").cast("string"), F.lit(track)).alias("version"), "symbols")
        out = pools if out is None else out.unionByName(pools)
    return out


@query("h6_j14_track_previews", B + """, last AS (SELECT max(date) AS date FROM bars GROUP BY date_trunc('month', date)), x AS (SELECT *, close / open AS ret FROM bars JOIN last USING (date)),
t AS (SELECT 'by_volume' AS track, date, symbol, row_number() OVER (PARTITION BY date ORDER BY quote_volume DESC, symbol) AS r FROM x UNION ALL SELECT 'by_return', date, symbol, row_number() OVER (PARTITION BY date ORDER BY ret DESC, symbol) FROM x
  UNION ALL SELECT 'sparse', date, symbol, row_number() OVER (PARTITION BY date ORDER BY volume DESC, symbol) FROM x WHERE month(date) % 3 <> 0),
p AS (SELECT track, date, list(symbol ORDER BY r) AS s FROM t WHERE r <= 5 GROUP BY track, date),
aim AS (SELECT max(date) AS date FROM last WHERE date <= DATE '1997-09-30'),
c AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY date = (SELECT date FROM aim) DESC, date DESC) AS k FROM p),
o AS (SELECT s AS o FROM p WHERE track = 'by_volume' AND date = (SELECT date FROM aim))
SELECT track, date AS as_of_date, date::VARCHAR || '-' || track AS version, array_to_string(s, '|') AS symbols, len(list_intersect(s, o))::INT AS overlap,
  array_to_string(list_filter(s, lambda y: NOT list_contains(o, y)), '|') AS only_in_track, array_to_string(list_filter(o, lambda y: NOT list_contains(s, y)), '|') AS only_in_official FROM c, o WHERE k = 1""")  # fmt: skip
def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    pools = _pools(spark, sf_dir, 5)
    aim = pools.where((F.col("track") == "by_volume") & (F.col("as_of_date") <= "1997-09-30")).agg(F.max("as_of_date")).first()[0]
    official = pools.where((F.col("track") == "by_volume") & (F.col("as_of_date") == F.lit(aim)))
    out = review.track_previews(pools, official, F.lit(aim))
    return out.withColumns({c: F.concat_ws("|", c) for c in ("symbols", "only_in_track", "only_in_official")})


@query("q14_j17_lifecycle_report", P.sql("rules", """
, ls AS (SELECT date, count(DISTINCT CASE WHEN in_universe THEN upper(symbol) END) AS n FROM scored WHERE final_score IS NOT NULL AND date < DATE '1998-08-01' GROUP BY date),
lm AS (SELECT date, max((symbol = 'Brand#1')::INT) AS a, max((symbol = 'Brand#2')::INT) AS b FROM scored WHERE symbol IN ('Brand#1', 'Brand#2') AND date < DATE '1998-08-01' GROUP BY date),
lr AS (SELECT count(*) FILTER (a = 1) AS n0, count(*) FILTER (b = 1) AS n1, count(*) FILTER (a = 1 AND b = 1) AS n2, DATE '1998-08-01' - max(date) FILTER (a = 1) AS age,
  min(date) FILTER (b = 1) <= min(date) FILTER (a = 1) AND max(date) FILTER (b = 1) >= max(date) FILTER (a = 1) AS spans FROM lm),
lh AS (SELECT count(*) AS d, coalesce(min(n), 0) AS l, DATE '1998-08-01' - max(date) AS age FROM ls)
SELECT 'scored_dates' AS "check", d::DOUBLE AS value, d >= 730 AS ok FROM lh UNION ALL SELECT 'least_members', l, l >= 2 FROM lh UNION ALL SELECT 'reference_dates', n0, n0 >= 900 FROM lr
UNION ALL SELECT 'panel_age', age, coalesce(age <= 3, false) FROM lh UNION ALL SELECT 'market_age', age, coalesce(age <= 3, false) FROM lr
UNION ALL SELECT 'rows_BRAND#1', n0, n0 > 0 FROM lr UNION ALL SELECT 'coverage_BRAND#1', CASE WHEN n0 > 0 THEN 1 END, n0 > 0 FROM lr
UNION ALL SELECT 'rows_BRAND#2', n1, n1 > 0 FROM lr UNION ALL SELECT 'coverage_BRAND#2', n2 / nullif(n0, 0), coalesce(n2 / nullif(n0, 0) >= 0.99, false) AND coalesce(spans, false) FROM lr""".lstrip()))  # fmt: skip
def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.lifecycle_report(P.scored_panel(spark, sf_dir, columns=("close",)), F.lit("1998-08-01").cast("date"), ("BRAND#1", "BRAND#2"))


@query("q15_fingerprint", """WITH h AS (SELECT ('0x' || substr(sha256('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}'), 1, 12))::BIGINT AS h FROM orders)
SELECT count(*) AS n_rows, sum(h)::BIGINT AS sum_hash, bit_xor(h) AS xor_hash FROM h""")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.fingerprint(fixtures.table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus"])


@query("q16_training_windows", B + " SELECT symbol, min(date) AS start, max(date) AS \"end\", count(*) AS n_rows FROM bars GROUP BY symbol")
def training_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.training_window(fixtures.bars(spark, sf_dir), ["symbol"])


@query("p1_p3_p9_cleaned_values", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN o_totalprice::DOUBLE END AS finite_price,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice::DOUBLE END AS parsed, o_orderkey % 2 = 0 AS flag FROM orders""")
def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.table(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    raw = orders.select(
        "o_orderkey", F.when(key % 5 == 0, float("inf")).when(key % 7 == 0, float("nan")).otherwise(price).alias("finite_price"),
        F.when(key % 3 == 0, "n/a").otherwise(price.cast("string")).alias("t"), F.when(key % 2 == 0, F.when(key % 4 == 0, " TRUE ").otherwise("y")).otherwise(F.when(key % 3 == 0, "off")).alias("f"),
    )
    return nulls.clean_numeric(raw).select("o_orderkey", "finite_price", nulls.number("t").alias("parsed"), nulls.truthy("f").alias("flag"))
