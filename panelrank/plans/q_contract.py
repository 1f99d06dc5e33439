"""Queries of the release contract. A release is a month: its last day's symbols by volume, with one rule broken in most months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.operators import contract

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
AS_OF, MAX_AGE = "1998-06-30", 900


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = fixtures.bars(spark, sf_dir).select("date", "symbol", "quote_volume")
    last = bars.groupBy(F.date_trunc("month", "date").alias("u")).agg(F.max("date").alias("date")).select("date")
    r = F.row_number().over(Window.partitionBy("date").orderBy(F.desc("quote_volume"), "symbol"))
    day = F.col("date").cast("string")
    return bars.join(last, "date").select(day.alias("release"), "date", ((F.year("date") * 12 + F.month("date")) % 15).alias("m"), F.upper(F.translate("symbol", "#", "")).alias("base"), r.alias("r"))


def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when((F.col("m") == 9) & (F.col("r") == 2), "n/a").when((F.col("m") == 10) & (F.col("r") == 3), "2").otherwise(F.col("r").cast("string"))
    return _placed(spark, sf_dir).select("release", F.col("release").alias("as_of_date"), F.concat("base", F.lit("USDT")).alias("symbol"), rank.alias("current_rank"), F.when(F.col("r") <= 5, " True").otherwise("no").alias("selected_flag"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = lambda least, most: F.filter("all", lambda x: x["r"].between(least, most))
    names = lambda rows: F.transform(rows, lambda x: F.concat(x["base"], F.lit("USDT")))
    rows = _placed(spark, sf_dir).groupBy("release", "date", "m").agg(F.array_sort(F.collect_list(F.struct("r", "base"))).alias("all"))
    is_ = lambda m: F.col("m") == m
    pool, entries = names(some(1, 5)), F.map_from_arrays(names(some(1, 5)), some(1, 5)["base"])
    symbols = F.when(is_(2), F.reverse(pool)).when(is_(3), F.concat(pool, F.slice(pool, 1, 1))).when(is_(6), F.concat(pool, F.array(F.lit(" btcxyz")))).when(is_(12), names(some(6, 10))).otherwise(pool)
    spoiled = F.map_from_arrays(names(some(1, 5)), F.transform(some(1, 5), lambda x: F.when(x["r"] == 1, " ").otherwise(x["base"])))
    day = F.col("release")
    return rows.select(
        "release", day.alias("universe_as_of_date"), F.when(is_(5), names(some(2, 10))).otherwise(names(some(1, 10))).alias("universe_symbols"),
        day.alias("as_of_date"), F.concat(day, F.when(is_(1), "_").otherwise("-"), F.lit("core")).alias("version"), F.lit("core").alias("mode"),
        F.when(is_(4), "7").when(is_(13), "many").otherwise(F.size(symbols).cast("string")).alias("pool_size"), F.lit("demo").alias("source_project"), symbols.alias("symbols"), F.when(is_(7), spoiled).otherwise(entries).alias("symbol_map"),
        F.when(is_(8), F.date_add("date", 1).cast("string")).otherwise(day).alias("legacy_as_of_date"), F.concat(day, F.lit("-core")).alias("legacy_version"), F.when(~is_(14), "core").alias("legacy_mode"), F.lit("5").alias("legacy_pool_size"),
        F.when(is_(11), "other").otherwise("demo").alias("legacy_source_project"), entries.alias("legacy_symbols"), entries.alias("legacy_symbol_map"),
    )


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was published: the release's own fields, but for an old version and size in one month of fifteen."""
    rows = releases(spark, sf_dir)
    old = (F.year(F.to_date("release")) * 12 + F.month(F.to_date("release"))) % 15 == 0
    return rows.select("release", "as_of_date", "mode", "source_project", "symbols", "symbol_map", F.when(old, "old").otherwise(F.col("version")).alias("version"), F.when(old, "4").otherwise(F.col("pool_size")).alias("pool_size"))


RELEASES_SQL = "WITH " + fixtures.bars_sql() + """,
last AS (SELECT max(date) AS date FROM bars GROUP BY date_trunc('month', date)),
pl AS (SELECT date::VARCHAR AS release, date, (year(date) * 12 + month(date)) % 15 AS m, upper(replace(symbol, '#', '')) AS base, row_number() OVER (PARTITION BY date ORDER BY quote_volume DESC, symbol) AS r FROM bars JOIN last USING (date)),
rk AS (SELECT release, base || 'USDT' AS symbol, CASE WHEN m = 9 AND r = 2 THEN NULL WHEN m = 10 AND r = 3 THEN 2 ELSE r END AS rank, r <= 5 AS sel, r FROM pl),
g AS (SELECT release, date, m, list(base || 'USDT' ORDER BY r) FILTER (r <= 5) AS pool, list(base || 'USDT' ORDER BY r) FILTER (r <= 10) AS ten, count(*) AS n_rows, count(*) FILTER (r <= 5) AS n_sel FROM pl GROUP BY release, date, m),
s AS (SELECT *, CASE m WHEN 2 THEN list_reverse(pool) WHEN 3 THEN list_append(pool, pool[1]) WHEN 6 THEN list_append(pool, ' btcxyz') WHEN 12 THEN ten[6:10] ELSE pool END AS raw FROM g),
t AS (SELECT *, list_filter(raw, lambda x, i: x LIKE '%USDT' AND list_position(raw, x) = i) AS p, CASE WHEN m = 5 THEN ten[2:10] ELSE ten END AS u, CASE WHEN m = 7 THEN pool[2:] ELSE pool END AS mapped,
  CASE m WHEN 4 THEN 7 WHEN 13 THEN NULL ELSE len(raw) END AS size FROM s),"""

REPORT_SQL = RELEASES_SQL + f"""
by_rank AS (SELECT release, list(symbol ORDER BY rank, symbol) AS br, bool_or(rank IS NULL) AS bad FROM rk WHERE sel GROUP BY release),
x AS (SELECT t.*, CASE WHEN bad THEN [] ELSE br END AS br, bad FROM t LEFT JOIN by_rank USING (release)),
rep AS (
  SELECT release, 'missing_legacy_mode' AS "check" FROM x WHERE m = 14 UNION ALL SELECT release, 'empty_legacy_mode' FROM x WHERE m = 14
  UNION ALL SELECT release, 'invalid_in_symbols' FROM x WHERE len(list_filter(raw, lambda y: NOT y LIKE '%USDT')) > 0
  UNION ALL SELECT release, 'duplicate_in_symbols' FROM x WHERE len(list_filter(raw, lambda y: y LIKE '%USDT')) > len(p)
  UNION ALL SELECT release, 'invalid_in_symbol_map' FROM x WHERE m = 7
  UNION ALL SELECT release, 'symbols_differ_from_symbol_map' FROM x WHERE len(p) > 0 AND len(mapped) > 0 AND list_sort(p) <> list_sort(mapped)
  UNION ALL SELECT release, 'legacy_symbols_differ' FROM x WHERE len(p) > 0 AND list_sort(p) <> list_sort(pool)
  UNION ALL SELECT release, 'pool_size_no_integer' FROM x WHERE size IS NULL
  UNION ALL SELECT release, 'pool_size_not_positive' FROM x WHERE size <= 0
  UNION ALL SELECT release, 'pool_size_differs' FROM x WHERE len(p) > 0 AND size > 0 AND size <> len(p)
  UNION ALL SELECT release, 'legacy_pool_size_differs' FROM x WHERE len(pool) <> 5
  UNION ALL SELECT release, 'pool_not_in_universe' FROM x WHERE len(u) > 0 AND NOT list_has_all(u, p)
  UNION ALL SELECT release, 'empty_universe_symbols' FROM x WHERE len(u) = 0 UNION ALL SELECT release, 'empty_symbols' FROM x WHERE len(coalesce(raw, [])) = 0
  UNION ALL SELECT release, 'version_not_date_and_mode' FROM x WHERE m = 1
  UNION ALL SELECT release, 'as_of_dates_differ' FROM x WHERE m = 8
  UNION ALL SELECT release, 'legacy_version_not_date_and_mode' FROM x WHERE m = 8
  UNION ALL SELECT release, 'legacy_version_differs' FROM x WHERE m = 1
  UNION ALL SELECT release, 'legacy_source_project_differs' FROM x WHERE m = 11
  UNION ALL SELECT release, 'unexpected_pool_size' FROM x WHERE size <> 5
  UNION ALL SELECT release, 'rank_no_number' FROM x WHERE bad
  UNION ALL SELECT release, 'equal_ranks' FROM (SELECT release FROM rk WHERE sel GROUP BY release HAVING count(rank) = count(*) AND count(DISTINCT rank) < count(*))
  UNION ALL SELECT release, 'pool_not_selected' FROM x WHERE len(p) > 0 AND NOT list_has_all(pool, p)
  UNION ALL SELECT release, 'selected_count_differs' FROM x WHERE len(p) > 0 AND n_sel <> len(p)
  UNION ALL SELECT release, 'pool_not_in_rank_order' FROM x WHERE len(p) > 0 AND len(br) > 0 AND p <> br[1:len(p)]
  UNION ALL SELECT release, 'summary_symbols_differ' FROM x WHERE raw <> p
  UNION ALL SELECT release, 'summary_symbol_map_differs' FROM x WHERE m = 7
  UNION ALL SELECT release, 'summary_version_differs' FROM x WHERE m = 0
  UNION ALL SELECT release, 'summary_pool_size_differs' FROM x WHERE coalesce(CASE WHEN m = 0 THEN 4 ELSE size END, -1) <> len(p)
  UNION ALL SELECT release, 'as_of_date_in_future' FROM x WHERE date > DATE '{AS_OF}'),
report AS (SELECT *, 'error' AS severity FROM rep UNION ALL SELECT release, 'stale', 'warning' FROM x WHERE DATE '{AS_OF}' - date > {MAX_AGE})"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.validate(releases(spark, sf_dir), ranking(spark, sf_dir), F.lit(AS_OF).cast("date"), MAX_AGE, expected={"mode": "core", "source_project": "demo", "pool_size": 5}, summary=summary(spark, sf_dir))


@query("q10_q11_p10_j12_contract", REPORT_SQL + ' SELECT release, "check", severity FROM report')
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@query("q12_release_status", REPORT_SQL + """,
c AS (SELECT release, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings FROM report GROUP BY release),
top AS (SELECT release, array_to_string((list(symbol ORDER BY rank NULLS LAST, symbol))[1:5], '|') AS preview FROM rk GROUP BY release)
SELECT release, len(p)::INT AS n_symbols, n_rows AS n_ranked, n_sel AS n_selected, coalesce(errors, 0)::BIGINT AS errors, coalesce(warnings, 0)::BIGINT AS warnings,
  CASE WHEN errors > 0 THEN 'error' WHEN warnings > 0 THEN 'warning' ELSE 'ok' END AS status, preview FROM t LEFT JOIN c USING (release) LEFT JOIN top USING (release)""")  # fmt: skip
def release_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.status(releases(spark, sf_dir), ranking(spark, sf_dir), _report(spark, sf_dir))


@query("q13_consistency", RELEASES_SQL + """
v AS (SELECT release, m, date, CASE WHEN m = 8 THEN date + 1 ELSE date END AS ld, size FROM t)
SELECT release, 'as_of_dates_differ' AS warning FROM v WHERE m = 8
UNION ALL SELECT release, 'versions_differ' FROM v WHERE m IN (0, 1)
UNION ALL SELECT release, 'pool_sizes_differ' FROM v WHERE size IS NOT NULL AND (m = 0 OR size <> 5)
UNION ALL SELECT release, 'pool_size_unexpected' FROM v WHERE greatest(size, 5) <> 5
UNION ALL SELECT release, 'output_lags' FROM v WHERE m = 8""")
def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = releases(spark, sf_dir)
    day = lambda c: F.to_date(c).alias("as_of_date")
    tables = {
        "pool": rows.select("release", day("as_of_date"), "version", "pool_size"),
        "legacy": rows.select("release", day("legacy_as_of_date"), F.col("legacy_version").alias("version"), F.col("legacy_pool_size").alias("pool_size")),
        "summary": summary(spark, sf_dir).select("release", day("as_of_date"), "version", "pool_size"),
    }
    return contract.consistency(tables, 0, 5)
