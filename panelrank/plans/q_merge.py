"""Queries of the source merge. The external history shifts the prices of brands 1 to 15 a little and differs for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.functions.tables import stored
from panelrank.operators import merge
from panelrank.plans.q_panel import rounds

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SOURCES = ["primary", "alternate", "archive"]
GATE = merge.Gate(max_gaps=100_000, max_gap_days=60, max_jumps=50, min_check_days=200)


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def _histories(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The primary, external, check and third histories. The bars are derived and written once each, as the gate reads a history many times:
    the lines are read three times, whatever is asked of the histories."""
    near, far, lines_a = (stored(fixtures.bars(spark, sf_dir, *given), name) for name, given in {"near": (), "far": ("o_orderdate",), "check": ("l_shipdate", "A")}.items())
    return _primary(near), _external(near, far), merge.normalize(lines_a, "archive", "check", True), _third(near)


def _primary(near):
    return merge.normalize(near.where("date >= '1996-01-01'"), "primary", "primary", False)


def _external(near, far):
    number = F.regexp_extract("symbol", r"(\d+)$", 1).cast("int")
    factor = 1 + 0.001 * (F.dayofmonth("date") % 3 - 1)
    close = near.where(number <= 15).withColumns({c: F.col(c) * factor for c in ("open", "high", "low", "close")})
    return merge.normalize(close, "alternate", "feed", True).unionByName(merge.normalize(far.where(number > 15), "archive", "feed", True))


def _tiers(spark, sf_dir):
    number = F.regexp_extract("symbol", r"(\d+)$", 1).cast("int")
    tier = F.when(number <= 18, "core").when(number <= 22, "cautious")
    return fixtures.metadata(spark, sf_dir).where(number <= 22).select(F.upper("symbol").alias("symbol"), tier.alias("tier"), F.when(number > 18, "thin market").alias("caution"))


BASE = ("WITH " + fixtures.bars_sql() + ",\n" + fixtures.bars_sql("far", "o_orderdate", "JOIN orders ON l_orderkey = o_orderkey") + ",\n" + fixtures.bars_sql("chk", more="WHERE l_returnflag = 'A'") + """,
pri AS MATERIALIZED (SELECT date, upper(symbol) AS symbol, open, high, low, close, volume, quote_volume, 'primary' AS data_source, 'primary' AS data_provider FROM bars WHERE date >= DATE '1996-01-01'),
ext AS MATERIALIZED (SELECT date, upper(symbol) AS symbol, open * f AS open, high * f AS high, low * f AS low, close * f AS close, volume, quote_volume, 'alternate' AS data_source, 'feed' AS data_provider
    FROM (SELECT *, 1 + 0.001::DOUBLE * (day(date) % 3 - 1) AS f FROM bars WHERE regexp_extract(symbol, '([0-9]+)$', 1)::INT <= 15)
  UNION ALL SELECT date, upper(symbol), open, high, low, close, volume, quote_volume, 'archive', 'feed' FROM far WHERE regexp_extract(symbol, '([0-9]+)$', 1)::INT > 15),
ck AS MATERIALIZED (SELECT date, upper(symbol) AS symbol, close FROM chk)""")  # fmt: skip
QUALITY = """,
st AS (SELECT symbol, min(date) AS primary_start FROM pri GROUP BY symbol),
e1 AS (SELECT ext.*, primary_start, abs(close / lag(close) OVER (PARTITION BY ext.symbol ORDER BY date) - 1) AS r, coalesce(date_diff('day', lag(date) OVER (PARTITION BY ext.symbol ORDER BY date), date), 1) AS step FROM ext JOIN st USING (symbol)),
e2 AS (SELECT symbol, count(*) AS external_rows, count(*) FILTER (date < primary_start) AS rows_added, count(*) FILTER (r > 3.0) AS jumps, max(r) AS max_abs_return, count(*) FILTER (step > 1) AS gap_count, max(step) AS max_gap_days FROM e1 GROUP BY symbol),
c1 AS (SELECT symbol, coalesce(date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date), 1) AS step FROM ck),
c2 AS (SELECT symbol, count(*) FILTER (step > 1) AS check_gaps FROM c1 GROUP BY symbol),
o1 AS (SELECT 'o' AS k, symbol, date, pri.close AS a, ext.close AS b FROM pri JOIN ext USING (symbol, date) UNION ALL SELECT 'c', symbol, date, ext.close, ck.close FROM ext JOIN ck USING (symbol, date)),
o2 AS (SELECT *, a / lag(a) OVER w - 1 AS ra, b / lag(b) OVER w - 1 AS rb, a / b AS ratio FROM o1 WINDOW w AS (PARTITION BY k, symbol ORDER BY date)),
o3 AS (SELECT k, symbol, count(*) AS days, CASE WHEN count(ra) >= 2 THEN corr(ra, rb) END AS corr, CASE WHEN count(ra) >= 2 THEN median(abs(ra - rb)) END AS diff, CASE WHEN count(*) >= 2 THEN stddev_pop(ratio) / abs(avg(ratio)) END AS cv FROM o2 GROUP BY k, symbol),
q1 AS (SELECT st.symbol, primary_start, coalesce(external_rows, 0) AS external_rows, coalesce(rows_added, 0) AS rows_added, coalesce(jumps, 0) AS jumps, max_abs_return, coalesce(gap_count, 0) AS gap_count, coalesce(max_gap_days, 0) AS max_gap_days,
  coalesce(o.days, 0) AS overlap_days, o.corr AS overlap_corr, o.diff AS overlap_diff, o.cv AS overlap_cv, coalesce(c.days, 0) AS check_days, c.corr AS check_corr, c.diff AS check_diff, c.cv AS check_cv, check_gaps IS NOT NULL AS hc, coalesce(check_gaps, 0) AS check_gaps,
  CASE WHEN n <= 18 THEN 'core' WHEN n <= 22 THEN 'cautious' ELSE 'none' END AS tier, CASE WHEN n > 18 AND n <= 22 THEN 'thin market' END AS caution
  FROM (SELECT *, regexp_extract(symbol, '([0-9]+)$', 1)::INT AS n FROM st) st LEFT JOIN e2 USING (symbol) LEFT JOIN c2 USING (symbol) LEFT JOIN o3 o ON o.symbol = st.symbol AND o.k = 'o' LEFT JOIN o3 c ON c.symbol = st.symbol AND c.k = 'c'),
q2 AS (SELECT *, hc AND check_days >= 200 AS lc FROM q1),
q3 AS (SELECT *, concat_ws(',', CASE WHEN gap_count > 100000 THEN 'excessive_gap_count' END, CASE WHEN max_gap_days > 60 THEN 'excessive_max_gap' END, CASE WHEN jumps > 50 THEN 'suspicious_jump_count' END, CASE WHEN overlap_days < 180 THEN 'insufficient_overlap_days' END,
    CASE WHEN overlap_days >= 180 AND overlap_corr < 0.97 THEN 'low_overlap_return_corr' END, CASE WHEN overlap_days >= 180 AND overlap_diff > 0.03 THEN 'high_overlap_return_diff' END, CASE WHEN overlap_days >= 180 AND overlap_cv > 0.05 THEN 'unstable_overlap_price_ratio' END,
    CASE WHEN lc AND (coalesce(check_corr < 0.8, false) OR coalesce(check_cv > 0.18, false) OR coalesce(check_diff > 0.08, false) OR check_gaps > 60) THEN 'crosscheck_severe_anomaly' END) AS reasons,
  concat_ws(',', caution, CASE WHEN hc AND NOT lc THEN 'limited_crosscheck_history' END, CASE WHEN lc AND check_corr < 0.8 THEN 'crosscheck_return_corr_reject' WHEN lc AND check_corr < 0.92 THEN 'crosscheck_return_corr_warn' END,
    CASE WHEN lc AND check_cv > 0.18 THEN 'crosscheck_price_ratio_reject' WHEN lc AND check_cv > 0.08 THEN 'crosscheck_price_ratio_warn' END, CASE WHEN lc AND check_diff > 0.08 THEN 'crosscheck_return_diff_reject' WHEN lc AND check_diff > 0.03 THEN 'crosscheck_return_diff_warn' END,
    CASE WHEN lc AND check_gaps > 60 THEN 'crosscheck_gap_count_reject' WHEN lc AND check_gaps > 15 THEN 'crosscheck_gap_count_warn' END) AS notes,
  CASE WHEN NOT hc THEN 'unavailable' WHEN NOT lc THEN 'limited' WHEN coalesce(check_corr >= 0.8 AND check_corr < 0.92, false) OR coalesce(check_cv <= 0.18 AND check_cv > 0.08, false) OR coalesce(check_diff <= 0.08 AND check_diff > 0.03, false) OR (check_gaps <= 60 AND check_gaps > 15) THEN 'warn' ELSE 'pass' END AS check_status FROM q2),
q4 AS (SELECT *, CASE WHEN tier = 'none' THEN 'not_whitelisted' WHEN external_rows = 0 THEN 'no_external_rows' WHEN rows_added < 30 THEN 'insufficient_extension' WHEN reasons <> '' THEN 'rejected_quality_gate' ELSE 'merged' END AS quality_status FROM q3)"""
_STATS = ["max_abs_return", "overlap_corr", "overlap_diff", "overlap_cv", "check_corr", "check_diff", "check_cv"]
_COUNTS = ["external_rows", "rows_added", "jumps", "gap_count", "overlap_days", "check_days", "check_gaps"]


@query("q4_q8_a7_a11_quality_gate", BASE + QUALITY + f""" SELECT symbol, {', '.join(f'{c}::BIGINT AS {c}' for c in _COUNTS)}, {rounds(_STATS, 5)}, tier, CASE WHEN quality_status IN ('merged', 'rejected_quality_gate') THEN check_status WHEN hc THEN 'informational' ELSE 'unavailable' END AS check_status,
  CASE WHEN quality_status IN ('merged', 'rejected_quality_gate') THEN notes ELSE '' END AS notes, quality_status,
  CASE quality_status WHEN 'not_whitelisted' THEN 'symbol_not_in_backfill_whitelist' WHEN 'no_external_rows' THEN 'no_external_rows_available' WHEN 'insufficient_extension' THEN 'insufficient_pre_binance_extension' WHEN 'rejected_quality_gate' THEN reasons ELSE '' END AS quality_reasons,
  CASE quality_status WHEN 'not_whitelisted' THEN 'binance_only' WHEN 'merged' THEN CASE tier WHEN 'cautious' THEN 'approved_cautious' ELSE 'approved_core' END ELSE 'rejected' END AS final_decision FROM q4""")  # fmt: skip
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, external, check, _ = _histories(spark, sf_dir)
    out = merge.quality(primary, external, check, _tiers(spark, sf_dir), SOURCES, GATE)
    return out.select("symbol", *(F.col(c).cast("long").alias(c) for c in _COUNTS), *(F.round(c, 5).alias(c) for c in _STATS), "tier", "check_status", "notes", "quality_status", "quality_reasons", "final_decision")


MERGED = """,
al AS (SELECT * FROM pri UNION ALL SELECT ext.* FROM ext JOIN q4 USING (symbol) WHERE quality_status = 'merged'),
mr AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY CASE data_source WHEN 'primary' THEN 0 WHEN 'alternate' THEN 1 WHEN 'archive' THEN 2 ELSE 103 END, data_provider) AS r FROM al),
mg AS (SELECT * FROM mr WHERE r = 1)"""


@query("q1_q3_q9_merged_history", BASE + QUALITY + MERGED + " SELECT date, symbol, round(close, 6) AS close, data_source, data_provider FROM mg")
def merged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, external, check, _ = _histories(spark, sf_dir)
    merged, _ = merge.merge_histories(primary, external, check, _tiers(spark, sf_dir), SOURCES, GATE)
    return merged.select("date", "symbol", F.round("close", 6).alias("close"), "data_source", "data_provider")


@query("j11_coverage", BASE + QUALITY + MERGED + """, bs AS (SELECT symbol, data_source, count(*) AS n, min(date) AS f FROM mg GROUP BY symbol, data_source)
SELECT symbol, primary_start, primary_rows, merged_start, merged_rows, rows_by_source, date_diff('day', merged_start, primary_start)::INT AS days_gained
FROM (SELECT symbol, min(date) AS primary_start, count(*) AS primary_rows FROM pri GROUP BY symbol)
JOIN (SELECT symbol, min(f) AS merged_start, sum(n)::BIGINT AS merged_rows, '{' || string_agg('"' || data_source || '":' || n, ',' ORDER BY data_source) || '}' AS rows_by_source FROM bs GROUP BY symbol) USING (symbol)""")  # fmt: skip
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, external, check, _ = _histories(spark, sf_dir)
    merged, _ = merge.merge_histories(primary, external, check, _tiers(spark, sf_dir), SOURCES, GATE)
    return merge.coverage(primary, merged)


@query("s10_s11_normalized", "WITH " + fixtures.bars_sql() + ", n AS (SELECT date, symbol, close, volume, CASE WHEN day(date) % 2 = 0 THEN quote_volume END AS q FROM bars WHERE date <= DATE '1997-06-30') SELECT date, upper(symbol) AS symbol, round(coalesce(q, close * volume), 6) AS quote_volume, 'feed' AS data_source, 'demo' AS data_provider, true AS is_external_source FROM n")
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.bars(spark, sf_dir).withColumn("quote_volume", F.when(F.dayofmonth("date") % 2 == 0, F.col("quote_volume")))
    out = merge.normalize(rows, "feed", "demo", True, F.lit("1997-06-30").cast("date"))
    return out.select("date", "symbol", F.round("quote_volume", 6).alias("quote_volume"), "data_source", "data_provider", "is_external_source")


@query("s8_s15_upsert", "WITH " + fixtures.bars_sql() + """, a AS (SELECT date, symbol, round(close, 6) AS close, 1 AS received_at, 0 AS new FROM bars WHERE date <= DATE '1997-12-31'
  UNION ALL SELECT date, symbol, round(close, 6) + 1, CASE WHEN day(date) % 2 = 0 THEN 2 ELSE 0 END, 1 FROM bars WHERE date >= DATE '1997-06-01')
SELECT date, symbol, round(arg_max(close, received_at * 2 + new), 6) AS close, max(received_at) AS received_at FROM a GROUP BY date, symbol""")  # fmt: skip
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.bars(spark, sf_dir).select("date", "symbol", F.round("close", 6).alias("close"))
    stored = rows.where("date <= '1997-12-31'").withColumn("received_at", F.lit(1))
    fetched = rows.where("date >= '1997-06-01'").withColumns({"close": F.col("close") + 1, "received_at": F.when(F.dayofmonth("date") % 2 == 0, 2).otherwise(0)})
    return merge.upsert(stored, fetched).select("date", "symbol", F.round("close", 6).alias("close"), "received_at")


@query("s16_s17_cache_checks", "WITH " + fixtures.bars_sql() + """, s AS (SELECT symbol, date, date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS step FROM bars)
SELECT symbol, max(date) AS latest, coalesce(max(date) >= DATE '2001-11-01' OR date_diff('day', max(date), DATE '2001-11-01') <= 7, false) AS fresh, count(*) AS n_rows, round(avg(CASE WHEN step IS NOT NULL THEN CASE WHEN step <= 1 THEN 1.0 ELSE 0.0 END END), 6) AS density,
  coalesce(count(*) >= 30 AND avg(CASE WHEN step IS NOT NULL THEN CASE WHEN step <= 1 THEN 1.0 ELSE 0.0 END END) >= 0.6, false) AS dense FROM s GROUP BY symbol""")  # fmt: skip
def cache_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.bars(spark, sf_dir)
    return merge.freshness(rows, F.lit("2001-11-01").cast("date"), 7).join(merge.density(rows, 0.6), "symbol").withColumn("density", F.round("density", 6))


#: Profiles: sources, what differs from GATE, and the last core and cautious symbol. A third source repeats days of the first two.
PROFILES = {
    "plain": ({}, ("primary", "alternate", "archive", "third"), 18, 22),
    "third_first": ({}, ("primary", "third", "alternate", "archive"), 18, 22),
    "strict": ({"max_gap_days": 20, "max_jumps": 3, "min_overlap_corr": 0.999}, ("primary", "alternate", "archive", "third"), 12, 24),
    "loose": ({"min_overlap_corr": 0.1, "max_overlap_diff": 0.9, "max_overlap_cv": 0.9, "check_rejects": False}, ("primary", "third", "alternate", "archive"), 18, 24),
    "core_only": ({"merge_cautious": False}, ("primary", "alternate", "archive", "third"), 10, 22),
    "open": ({"enabled": False}, ("primary", "alternate", "archive", "third"), 18, 22),
}
_SHARED = {"max_gaps": 100_000, "max_gap_days": 60, "max_jumps": 50, "min_check_days": 200, "max_duplicates": 1_000_000}


def _third(near):
    """Every third day of brands up to 20, half a percent dearer."""
    rows = near.where((F.dayofyear("date") % 3 == 0) & (F.regexp_extract("symbol", r"(\d+)$", 1).cast("int") <= 20))
    return merge.normalize(rows.withColumns({c: F.col(c) * 1.005 for c in ("open", "high", "low", "close")}), "third", "feed", True)


def _sweep(spark, sf_dir):
    profiles = merge.profile_table(spark, {n: {"sources": sources, **_SHARED, **given} for n, (given, sources, *_) in PROFILES.items()})
    number = F.regexp_extract("symbol", r"(\d+)$", 1).cast("int")
    bounds = F.explode(F.array(*(F.struct(F.lit(n).alias("profile"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, (_, _, a, b) in PROFILES.items())))
    tiers = fixtures.metadata(spark, sf_dir).select(F.upper("symbol").alias("symbol"), number.alias("n"), bounds.alias("x")).select("symbol", "n", "x.*").where("n <= b")
    tiers = tiers.select("profile", "symbol", F.when(F.col("n") <= F.col("a"), "core").otherwise("cautious").alias("tier"), F.when(F.col("n") > F.col("a"), "thin market").alias("caution"))
    primary, external, check, third = _histories(spark, sf_dir)
    external = external.unionByName(third)
    return primary, external, profiles, merge.sweep(primary, external, check, profiles, tiers)


_SETS = {">".join(p[1]): p[1] for p in PROFILES.values()}


def _sweep_sql() -> str:
    """The gate's statistics over symbols that begin with their set of sources, then q1 to q4 once for each profile with its limits."""
    sets = "(VALUES " + ", ".join(f"('{k}', [{', '.join(repr(x) for x in v)}])" for k, v in _SETS.items()) + ")"
    base = BASE.replace("pri AS MATERIALIZED", "pri0 AS MATERIALIZED").replace("ext AS MATERIALIZED", "ext0 AS MATERIALIZED").replace("ck AS MATERIALIZED", "ck0 AS MATERIALIZED")
    text = base + f""",
sets(set_, srcs) AS {sets},
ext1 AS MATERIALIZED (SELECT * FROM ext0 UNION ALL SELECT date, upper(symbol), open * 1.005::DOUBLE, high * 1.005::DOUBLE, low * 1.005::DOUBLE, close * 1.005::DOUBLE, volume, quote_volume, 'third', 'feed' FROM bars WHERE dayofyear(date) % 3 = 0 AND regexp_extract(symbol, '([0-9]+)$', 1)::INT <= 20),
pri AS MATERIALIZED (SELECT * REPLACE (set_ || '|' || symbol AS symbol) FROM pri0, sets),
ext AS MATERIALIZED (SELECT * EXCLUDE (r, set_, srcs) FROM (SELECT * REPLACE (set_ || '|' || symbol AS symbol), row_number() OVER (PARTITION BY set_, symbol, date ORDER BY list_position(srcs, data_source) NULLS LAST, data_provider) AS r FROM ext1, sets) WHERE r = 1),
ck AS MATERIALIZED (SELECT * REPLACE (set_ || '|' || symbol AS symbol) FROM ck0, sets)"""
    cut = QUALITY.index("q1 AS (")
    text += QUALITY[:cut].rstrip().rstrip(",")
    for name, (given, sources, core, cautious) in PROFILES.items():
        chain = QUALITY[cut:]
        for a, b in (("n <= 18", f"n <= {core}"), ("n <= 22", f"n <= {cautious}"), ("n > 18", f"n > {core}"), ("FROM st)", f"FROM st WHERE starts_with(symbol, '{'>'.join(sources)}|'))"),
                     ("max_gap_days > 60", f"max_gap_days > {given.get('max_gap_days', 60)}"), ("jumps > 50", f"jumps > {given.get('max_jumps', 50)}"), ("overlap_corr < 0.97", f"overlap_corr < {given.get('min_overlap_corr', 0.97)}"),
                     ("overlap_diff > 0.03", f"overlap_diff > {given.get('max_overlap_diff', 0.03)}"), ("overlap_cv > 0.05", f"overlap_cv > {given.get('max_overlap_cv', 0.05)}"),
                     ("CASE WHEN lc AND (coalesce(check_corr < 0.8", f"CASE WHEN {str(given.get('check_rejects', True)).lower()} AND lc AND (coalesce(check_corr < 0.8"),
                     ("WHEN external_rows = 0", ("" if given.get("merge_cautious", True) else "WHEN tier = 'cautious' THEN 'cautious_holdout' ") + "WHEN external_rows = 0"),
                     ("WHEN rows_added < 30", ("" if given.get("enabled", True) else "WHEN true THEN 'merged' ") + "WHEN rows_added < 30")):
            chain = chain.replace(a, b)
        for q in ("q1", "q2", "q3", "q4"):
            chain = chain.replace(f"{q} AS (", f"{q}_{name} AS (").replace(f"FROM {q})", f"FROM {q}_{name})")
        text += ",\n" + chain
    rows = " UNION ALL ".join(f"SELECT '{n}' AS profile, regexp_replace(symbol, '^.*[|]', '') AS symbol, tier, quality_status, CASE WHEN quality_status = 'rejected_quality_gate' THEN reasons ELSE '' END AS reasons, rows_added FROM q4_{n}" for n in PROFILES)
    return text + f""",
dc AS MATERIALIZED (SELECT *, CASE quality_status WHEN 'not_whitelisted' THEN 'binance_only' WHEN 'cautious_holdout' THEN 'cautious_holdout' WHEN 'merged' THEN CASE tier WHEN 'cautious' THEN 'approved_cautious' ELSE 'approved_core' END ELSE 'rejected' END AS final_decision FROM ({rows}))"""


@query("v10_profile_decisions", _sweep_sql() + " SELECT profile, symbol, tier, quality_status, reasons, final_decision FROM dc")
def profile_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = _sweep(spark, sf_dir)[3]
    return decisions.select("profile", "symbol", "tier", "quality_status", F.when(F.col("quality_status") == "rejected_quality_gate", F.col("quality_reasons")).otherwise("").alias("reasons"), "final_decision")


@query("v10_profile_summary", _sweep_sql() + """, al AS (SELECT p.profile, pri0.* FROM pri0, (SELECT DISTINCT profile FROM dc) p UNION ALL SELECT dc.profile, e.* FROM ext1 e JOIN dc ON dc.symbol = e.symbol AND quality_status = 'merged'),
od(profile, srcs) AS (VALUES """ + ", ".join(f"('{n}', [{', '.join(repr(x) for x in p[1])}])" for n, p in PROFILES.items()) + """),
mh AS (SELECT *, row_number() OVER (PARTITION BY profile, symbol, date ORDER BY list_position(srcs, data_source) NULLS LAST, data_provider) AS r FROM al JOIN od USING (profile)),
ms AS (SELECT profile, count(*) AS history_rows, count(*) FILTER (data_source = 'third') AS third_rows, round(sum(round(close, 6)::DECIMAL(18, 6)), 4)::DOUBLE AS closes FROM mh WHERE r = 1 GROUP BY profile)
SELECT profile, count(*) AS symbols, count(*) FILTER (final_decision = 'approved_core') AS approved_core, count(*) FILTER (final_decision = 'approved_cautious') AS approved_cautious, count(*) FILTER (final_decision = 'rejected') AS rejected,
  count(*) FILTER (final_decision = 'cautious_holdout') AS cautious_holdout, count(*) FILTER (quality_status = 'merged') AS merged, coalesce(sum(rows_added) FILTER (quality_status = 'merged'), 0)::BIGINT AS merged_rows_added,
  any_value(history_rows) AS history_rows, any_value(third_rows) AS third_rows FROM dc JOIN ms USING (profile) GROUP BY profile""")
def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions by profile, and what the merged histories of the profiles hold."""
    primary, external, profiles, decisions = _sweep(spark, sf_dir)
    decisions = stored(decisions, "decisions")
    held = merge.sweep_histories(primary, external, decisions, profiles).groupBy("profile").agg(F.count("*").alias("history_rows"), F.count_if(F.col("data_source") == "third").alias("third_rows"))
    return merge.sweep_summary(decisions).join(held, "profile")
