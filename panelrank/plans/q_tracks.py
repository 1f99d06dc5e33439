"""Queries of release tracks: the scored panel ranked under several targets, their histories, metrics and monthly reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelrank.functions.tables import stored
from panelrank.operators import history, review
from panelrank.plans import panel as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


#: Tracks: id, profile, target, source, status, and the score that they rank by; one skips months, one never has a pool.
TRACKS = (
    ("official_baseline", "baseline_blended", "blended_rank_pct", "official", "production", "rule_score_balanced_leader"),
    ("challenger_topk_60", "challenger_topk", "future_topk_label_60", "shadow", "candidate", "CASE WHEN month(date) % 3 <> 0 THEN rule_score_relative_strength_focus END"),
    ("defensive", "conservative", "future_rank_pct_90", "shadow", "candidate", "rule_score_conservative_trend_quality"),
    ("idle", "unused", "future_return_30", "shadow", "retired", "CASE WHEN month(date) = 13 THEN 1.0 END"),
)
_SCHEMES = ("rule_score_balanced_leader", "rule_score_relative_strength_focus", "rule_score_conservative_trend_quality")


def ranked_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track_id, date, symbol, current_rank, regime, regime_confidence, confidence: the panel once for each track."""
    panel = P.scored_panel(spark, sf_dir, columns=_SCHEMES)
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("track_id"), F.expr(e).cast("double").alias("score")) for t, *_, e in TRACKS)))
    rows = panel.where("in_universe").select("date", "symbol", "regime", "regime_confidence", "confidence", each.alias("x")).select("*", "x.*").drop("x")
    place = F.row_number().over(Window.partitionBy("track_id", "date").orderBy(F.round("score", 12).desc_nulls_last(), "symbol"))
    return rows.withColumn("current_rank", F.when(F.col("score").isNotNull(), place))


def track_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([t[:5] for t in TRACKS], "track_id string, profile_name string, target_mode string, source_track string, candidate_status string")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(history.release_index(ranked_tracks(spark, sf_dir), 5, "core", by=("track_id",), source_project="demo"), "release_index")


_VALUES = ", ".join("(" + ", ".join(f"'{x}'" for x in t[:5]) + ")" for t in TRACKS)
INDEX = P.sql("rules", f"""
, td AS (SELECT date, lead(date) OVER (ORDER BY date) AS nd FROM (SELECT DISTINCT date FROM scored WHERE in_universe)), tm AS (SELECT max(date) AS date FROM td GROUP BY date_trunc('month', date) UNION SELECT min(date) FROM td),
tl AS (SELECT date, symbol, regime, regime_confidence, confidence, unnest([{', '.join(f"'{t[0]}'" for t in TRACKS)}]) AS track_id, unnest([{', '.join(f'({t[5]})::DOUBLE' for t in TRACKS)}]) AS score FROM scored WHERE in_universe),
tr AS (SELECT *, row_number() OVER (PARTITION BY track_id, date ORDER BY round(score, 12) DESC NULLS LAST, symbol) AS r FROM tl JOIN tm USING (date)),
tp AS (SELECT track_id, date, list(symbol ORDER BY r) FILTER (score IS NOT NULL AND r <= 5) AS pool, max(regime) AS regime, max(regime_confidence) AS regime_confidence FROM tr GROUP BY track_id, date HAVING count(*) FILTER (score IS NOT NULL AND r <= 5) = 5),
ti AS MATERIALIZED (SELECT tp.*, date::VARCHAR || '-core' AS version, coalesce(nd, date) AS activation_date, CASE WHEN lag(pool) OVER w IS NOT NULL THEN len(list_intersect(pool, lag(pool) OVER w)) / 5.0::DOUBLE END AS stability FROM tp JOIN td USING (date) WINDOW w AS (PARTITION BY track_id ORDER BY date)),
tt(track_id, profile_name, target_mode, source_track, candidate_status) AS (VALUES {_VALUES})""".lstrip())


@query("h1_track_release_index", INDEX + """ SELECT track_id, date AS as_of_date, version, activation_date, 'core' AS mode, 'demo' AS source_project, 5 AS pool_size, 5 AS expected_pool_size, array_to_string(pool, '|') AS symbols, regime,
  round(regime_confidence, 5) AS regime_confidence, round(stability, 6) AS stability, round(1 - stability, 6) AS churn, true AS has_selection_meta FROM ti""")
def track_release_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).withColumns({"regime_confidence": F.round("regime_confidence", 5), **{c: F.round(c, 6) for c in ("stability", "churn")}})


@query("h2_h3_candidate_tracks", INDEX + """, s AS (SELECT track_id, count(*) AS release_count, min(date) AS first_as_of_date, max(date) AS last_as_of_date, round(avg(stability), 6) AS mean_pool_stability, round(avg(1 - stability), 6) AS mean_pool_churn FROM ti GROUP BY track_id)
SELECT tt.*, coalesce(release_count, 0) AS release_count, first_as_of_date, last_as_of_date, mean_pool_stability, mean_pool_churn, CASE WHEN release_count > 0 THEN 5.0::DOUBLE END AS mean_pool_size, CASE WHEN release_count > 0 THEN 1.0::DOUBLE END AS selection_meta_coverage FROM tt LEFT JOIN s USING (track_id)""")
def candidate_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    means = history.history_summary(index, ("track_id",)).select("track_id", F.round("mean_pool_stability", 6).alias("mean_pool_stability"), F.round("mean_pool_churn", 6).alias("mean_pool_churn"), "mean_pool_size", "selection_meta_coverage")
    return history.candidate_tracks(index, track_table(spark)).join(means, "track_id", "left")


_METRICS = {"pool_stability": ["pool_stability", "stability"], "pool_churn": ["churn"], "regime_confidence": ["regime_confidence"]}


@query("h4_a15_strategy_metrics", INDEX + """, hv AS (SELECT track_id, date, unnest(['pool_stability', 'pool_churn', 'regime_confidence']) AS metric, unnest([stability, 1 - stability, regime_confidence]) AS x FROM ti),
hm AS (SELECT track_id, metric, arg_max_null(x, date) AS current, avg(x) AS baseline FROM hv GROUP BY track_id, metric)
SELECT tt.track_id, profile_name AS strategy_profile, 'demo' AS repo, coalesce(string_agg(CASE WHEN current IS NOT NULL THEN metric || '=' || printf('%.4f', current) END, ',' ORDER BY metric), '') AS current, coalesce(string_agg(CASE WHEN baseline IS NOT NULL THEN metric || '=' || printf('%.4f', baseline) END, ',' ORDER BY metric), '') AS baseline
FROM tt LEFT JOIN hm USING (track_id) GROUP BY ALL""")
def strategy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir).withColumn("pool_stability", F.lit(None).cast("double"))
    out = review.strategy_metrics(index, track_table(spark), _METRICS, "demo")
    text = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(f"{c}_metrics")), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.4f", e["value"]))), ",").alias(c)
    return out.select("track_id", "strategy_profile", "repo", text("current"), text("baseline"))


@query("h7_monthly_reviews", INDEX + """,
ho AS (SELECT * FROM ti WHERE track_id = 'official_baseline'),
hc AS (SELECT o.date, count(t.date) AS n, max(t.date) AS last, arg_max(t.pool, t.date) AS pool FROM ho o LEFT JOIN ti t ON t.track_id = 'challenger_topk_60' AND t.date <= o.date GROUP BY o.date),
he AS (SELECT date, symbol, row_number() OVER (PARTITION BY date ORDER BY current_rank NULLS LAST, coalesce(nullif(final_score, 0), '-inf'::DOUBLE) DESC, coalesce(nullif(confidence, 0), '-inf'::DOUBLE) DESC,
  coalesce(nullif(liquidity_stability, 0), '-inf'::DOUBLE) DESC, coalesce(nullif(avg_quote_vol_180, 0), '-inf'::DOUBLE) DESC, upper(symbol)) AS p, count(*) OVER (PARTITION BY date) AS n FROM scored),
hb AS (SELECT date, max(symbol) FILTER (p = least(5, n)) AS cut, max(symbol) FILTER (p = least(5, n) + 1) AS nxt FROM he GROUP BY date),
hf AS (SELECT o.*, c.n, c.last, c.pool AS cp, row_number() OVER (ORDER BY o.date) AS i, b.cut, b.nxt FROM ho o JOIN hc c USING (date) JOIN hb b USING (date))
SELECT date AS as_of_date, CASE WHEN i % 5 = 0 OR n = 0 OR last <> date THEN 'warning' ELSE 'ok' END AS status,
  concat_ws('|', CASE WHEN i % 5 = 0 THEN 'manifest version differs' END, CASE WHEN n = 0 THEN 'no release of challenger_topk_60' END, CASE WHEN n > 0 AND last <> date THEN 'last release of challenger_topk_60 is of another date' END) AS warnings,
  version, array_to_string(pool, '|') AS symbols, i AS official_releases, n AS challenger_releases, last::VARCHAR AS challenger_last, CASE WHEN n > 0 THEN len(list_intersect(cp, pool))::INT END AS challenger_overlap, cut AS cutoff_symbol, nxt AS next_symbol FROM hf""")
def monthly_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews of all months, read back from their payloads; every fifth manifest names another version."""
    index = _index(spark, sf_dir)
    listed = index.withColumn("symbols", F.split("symbols", r"\|"))
    official = listed.where("track_id = 'official_baseline'").select("as_of_date", "version", "mode", "pool_size", "symbols")
    place = F.row_number().over(Window.orderBy("as_of_date"))
    manifest = official.select("as_of_date", F.col("as_of_date").cast("string").alias("manifest_date"), F.when(place % 5 == 0, "other").otherwise(F.col("version")).alias("manifest_version"), F.col("mode").alias("manifest_mode"))
    out = review.monthly_reviews(official, listed, review.selection_boundary(P.scored_panel(spark, sf_dir), 5), manifest)
    get = lambda path, kind="string": F.get_json_object("payload", path).cast(kind)
    pool = F.array_join(F.from_json(get("$.official_baseline.symbols"), "array<string>"), "|")
    return out.select(
        "as_of_date", "status", F.concat_ws("|", "warnings").alias("warnings"), get("$.official_baseline.version").alias("version"), pool.alias("symbols"), get("$.tracks.official_baseline.release_count", "long").alias("official_releases"),
        get("$.tracks.challenger_topk_60.release_count", "long").alias("challenger_releases"), get("$.tracks.challenger_topk_60.last_as_of_date").alias("challenger_last"),
        get("$.track_release_previews.challenger_topk_60.overlap", "int").alias("challenger_overlap"), get("$.selection_boundary.cutoff_symbol").alias("cutoff_symbol"), get("$.selection_boundary.next_symbol").alias("next_symbol"),
    )
