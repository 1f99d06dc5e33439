"""Queries of the panel: features, calendars, universe, context, labels, scores and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.config import TEST
from panelrank.functions.windows import first_rank, mean_rank, rank_pct
from panelrank.operators import calendar, features, scores, universe
from panelrank.plans import panel as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def rounded(df: DataFrame, keys: list[str], columns: list[str], digits: int = 6) -> DataFrame:
    return df.select(*keys, *(F.round(c, digits).alias(c) for c in columns))


def rounds(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


KEY = ["date", "symbol"]


@query("fixture_bars", P.sql("bars", f"SELECT date, symbol, {rounds(['open', 'high', 'low', 'close'])}, volume, round(quote_volume, 2) AS quote_volume FROM bars"))
def fixture_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bars(spark, sf_dir).select("date", "symbol", *(F.round(c, 6).alias(c) for c in ("open", "high", "low", "close")), "volume", F.round("quote_volume", 2).alias("quote_volume"))


def _feature_query(name: str, build, columns: list[str], upto: str = "f4", digits: int = 6, extra: str = ""):
    @query(name, P.sql("features", f"SELECT date, symbol, {rounds(columns, digits)} FROM {upto} {extra}"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(fixtures.bars(spark, sf_dir)), KEY, columns, digits)


_feature_query("w1_w4_averages", features.averages, [*(f"sma{n}" for n in (20, 60, 120, 200)), "gma200", "roc20", "roc60", "roc120", "ret1"], digits=5)
_feature_query("w5_w11_volatility", lambda b: features.volatility(features.averages(b)), ["vol20", "vol60", "downside_vol60", "true_range", "atr14", "drawdown180", "ulcer50", "zscore120"], digits=5)
_feature_query("w19_w24_position", lambda b: features.position(features.volatility(features.averages(b))), [*(f"price_vs_sma{n}" for n in (20, 60, 120, 200)), "trend_persist_90", "ma200_slope", "dist_to_90d_high", "dist_to_180d_high", "breakout_proximity", "momentum_combo", "risk_adjusted_momentum", "atr_ratio", "drawdown_severity", "downside_vol_penalty", "drawdown_penalty"], digits=5)
_feature_query("w25_w29_liquidity", features.liquidity, ["avg_quote_vol_30", "avg_quote_vol_90", "avg_quote_vol_180", "liquidity_stability", "tradable_ratio_180", "liquidity_acceleration", "age_days"], digits=4)
_feature_query("w32_liquid_days", lambda b: features.liquid_days(b, TEST.mode), ["liquid_days_90", "liquid_days_180"], digits=0)
_feature_query("w30_symbol_features", features.symbol_features, ["sma200", "vol20", "atr14", "ulcer50", "liquidity_stability", "risk_adjusted_momentum", "trend_persist_90"], digits=5)
_feature_query("w12_w13_r1_relative", lambda b: features.feature_panel(b, TEST), ["rs20", "rs60", "rs120", "rs_combo", "rs_risk_adj", "beta60", "corr60", "benchmark_above_sma200", "benchmark_z120"], "panel", 5)
_feature_query("w31_feature_panel", lambda b: features.feature_panel(b, TEST).where("rs_risk_adj is not null"), ["close", "rs_risk_adj", "momentum_combo", "liquidity_stability", "benchmark_z120"], "panel", 6, "WHERE rs_risk_adj IS NOT NULL")

_CYCLE = ["close", "sma200", "gma200", "mayer", "power_law", "ahr999", "mvrv_proxy", "high252", "drawdown_252d", "sma200_gap"]


@query("w14_w18_cycle_snapshot", P.sql("features", f"""
, v1 AS (SELECT *, close / nullif(sma200, 0) AS mayer, pow(10.0::DOUBLE, 5.84::DOUBLE * log10(greatest(1, date_diff('day', DATE '2009-01-03', date))::DOUBLE) - 17.01::DOUBLE) AS power_law,
  max(close) OVER w252 AS high252 FROM f1 WHERE date <= DATE '1997-12-31' {P.WINDOWS}),
v2 AS (SELECT *, close / nullif(gma200, 0) * (close / power_law) AS ahr999, (mayer - {P._roll('avg', 'mayer', 200)}) / nullif({P._roll('stddev_samp', 'mayer', 200)}, 0) AS mvrv_proxy,
  coalesce(1 - close / high252, 0) AS drawdown_252d, coalesce(close / sma200 - 1, 0) AS sma200_gap, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r FROM v1 {P.WINDOWS})
SELECT date, symbol, {", ".join(f"round({c}, 4) AS {c}" if c not in ("power_law", "ahr999") else f"round(log10({c}), 4) AS {c}" for c in _CYCLE)} FROM v2 WHERE r = 1""".replace("\n, v1", ", v1").lstrip()))  # fmt: skip
def cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.cycle_snapshot(fixtures.bars(spark, sf_dir), F.lit("1997-12-31").cast("date"))
    return out.select(*KEY, *(F.round(F.log10(c) if c in ("power_law", "ahr999") else F.col(c), 4).alias(c) for c in _CYCLE))


@query("slice_top5_relative_strength", P.sql("features", f"""
, k AS (SELECT date, symbol, rs_combo, rs_risk_adj, {P.rank_sql('rs_risk_adj')} AS rank_pct FROM panel),
t AS (SELECT *, row_number() OVER (ORDER BY rank_pct DESC NULLS LAST, symbol) AS place, lead(rank_pct) OVER (ORDER BY rank_pct DESC NULLS LAST, symbol) AS nx FROM k
  WHERE date = (SELECT max(date) FROM k WHERE rs_risk_adj IS NOT NULL) AND rs_risk_adj IS NOT NULL)
SELECT date, symbol, place, round(rs_combo, 5) AS rs_combo, round(rs_risk_adj, 5) AS rs_risk_adj, round(rank_pct, 6) AS rank_pct, round(rank_pct - nx, 6) AS gap_to_next FROM t WHERE place <= 5""".replace("\n, k", ", k").lstrip()))  # fmt: skip
def top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five symbols strongest relative to the benchmark on the last date, with the gap to the next."""
    rows = P.features_panel(spark, sf_dir).where("rs_risk_adj is not null").withColumn("rank_pct", rank_pct("rs_risk_adj", "date"))
    last = rows.agg(F.max("date").alias("date"))
    order = Window.partitionBy("date").orderBy(F.desc_nulls_last("rank_pct"), "symbol")
    snap = rows.join(F.broadcast(last), "date").withColumns({"place": F.row_number().over(order), "gap_to_next": F.col("rank_pct") - F.lead("rank_pct").over(order)})
    return snap.where("place <= 5").select(*KEY, "place", F.round("rs_combo", 5).alias("rs_combo"), F.round("rs_risk_adj", 5).alias("rs_risk_adj"), F.round("rank_pct", 6).alias("rank_pct"), F.round("gap_to_next", 6).alias("gap_to_next"))


@query("n1_n2_n3_ranks", P.sql("features", f"""SELECT date, symbol, round({P.rank_sql('roc60')}, 6) AS pct_rank, CASE WHEN roc60 IS NOT NULL THEN row_number() OVER (PARTITION BY date ORDER BY roc60 DESC NULLS LAST, symbol) END AS first_rank,
  CASE WHEN volume IS NOT NULL THEN rank() OVER (PARTITION BY date ORDER BY volume DESC NULLS LAST) + (count(volume) OVER (PARTITION BY date, volume) - 1) / 2.0::DOUBLE END AS mean_rank FROM f4"""))  # fmt: skip
def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.averages(fixtures.bars(spark, sf_dir))
    return rows.select(*KEY, F.round(rank_pct("roc60", "date"), 6).alias("pct_rank"), first_rank("roc60", "date").alias("first_rank"), mean_rank("volume", "date").alias("mean_rank"))


def _schedule_sql(unit: str) -> str:
    return f"SELECT max(date) AS date, '{unit}ly' AS frequency FROM d GROUP BY date_trunc('{unit}', date) UNION SELECT min(date), '{unit}ly' FROM d"


@query("c1_c2_schedules", P.sql("bars", f""", d AS (SELECT DISTINCT date FROM bars), w AS ({_schedule_sql('week')}), m AS ({_schedule_sql('month')}),
s1 AS (SELECT date, lead(date) OVER (ORDER BY date) AS nx, row_number() OVER (ORDER BY date DESC) AS r FROM m),
a AS (SELECT * FROM w UNION ALL SELECT * FROM m UNION ALL SELECT date, 'daily' FROM d
  UNION ALL SELECT date, 'refresh' FROM s1 WHERE NOT (r = 2 AND date_diff('day', date, nx) = 1 AND month(nx) <> month(date)))
SELECT date, frequency, lead(date) OVER (PARTITION BY frequency ORDER BY date) AS next_date FROM a"""))  # fmt: skip
def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar.calendar(fixtures.bars(spark, sf_dir))
    named = [(calendar.schedule(days, f), f) for f in ("daily", "weekly", "monthly")] + [(calendar.refresh_schedule(days), "refresh")]
    out = None
    for one, name in named:
        one = one.select("date", F.lit(name).alias("frequency"), "next_date")
        out = one if out is None else out.unionByName(one)
    return out


@query("c3_j13_next_trading_date", P.sql("bars", ", d AS (SELECT DISTINCT date FROM bars) SELECT date, lead(date, 1) OVER (ORDER BY date) AS next1, lead(date, 3) OVER (ORDER BY date) AS next3 FROM d"))
def next_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar.calendar(fixtures.bars(spark, sf_dir))
    return calendar.after(days, 1).withColumnRenamed("later", "next1").join(calendar.after(days, 3).withColumnRenamed("later", "next3"), "date")


@query("c4_continuity", P.sql("bars", "SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS n_dates, (date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date))::BIGINT AS missing, date_diff('day', min(date), max(date)) + 1 = count(DISTINCT date) AS continuous FROM bars"))
def continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.continuity(fixtures.bars(spark, sf_dir))


WINDOWS_SQL = """
d AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM bars)),
c AS (SELECT pos AS cur, n, ((pos - 720) // 60)::INT AS window_id FROM d WHERE pos >= 720 AND (pos - 720) % 60 = 0 AND (pos = 720 OR pos + 120 - 60 - 1 < n - 1)),
wins AS (SELECT window_id, d1.date AS train_start, d2.date AS train_end, d3.date AS effective_train_end, d4.date AS test_start, d5.date AS test_end, 90 AS purge_days
  FROM c JOIN d d1 ON d1.pos = cur - 720 JOIN d d2 ON d2.pos = cur - 1 JOIN d d3 ON d3.pos = cur - 91 JOIN d d4 ON d4.pos = cur JOIN d d5 ON d5.pos = least(c.n - 1, cur + 119))"""


@query("c5_walkforward_windows", P.sql("bars", "," + WINDOWS_SQL + " SELECT * FROM wins"))
def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.walkforward_windows(calendar.calendar(fixtures.bars(spark, sf_dir)), TEST)


@query("p5_metadata_filter", "WITH " + fixtures.META_SQL + " SELECT symbol, ((status = 'TRADING' AND quote_asset = 'USDT' AND is_spot_trading_allowed) OR symbol = 'Brand#1') AS metadata_eligible, symbol = 'Brand#1' AS is_benchmark FROM meta")
def metadata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.metadata_filter(fixtures.metadata(spark, sf_dir), TEST)


_TESTS = ["metadata_eligible", "history_eligible", "liquidity_eligible", "tradable_eligible", "continuous_eligible", "candidate_eligible"]


@query("u1_u5_eligibility", P.sql("universe", f"SELECT date, symbol, {', '.join(_TESTS)} FROM u2"))
def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.eligibility(P.features_panel(spark, sf_dir), fixtures.metadata(spark, sf_dir), TEST).select(*KEY, *_TESTS)


@query("u6_hysteresis", P.sql("universe", "SELECT snap AS snapshot_date, symbol, member FROM member"))
def hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = universe.eligibility(P.features_panel(spark, sf_dir), fixtures.metadata(spark, sf_dir), TEST)
    return universe.memberships(tested.select("date", "symbol", "candidate_eligible"), calendar.refresh_schedule(calendar.calendar(tested)), TEST.mode)


@query("u7_u8_dynamic_universe", P.sql("universe", "SELECT date, symbol, universe_snapshot_date, in_universe FROM uni"))
def dynamic_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.universe_panel(spark, sf_dir, columns=()).select(*KEY, "universe_snapshot_date", "in_universe")


@query("j9_market_cap_screen", "WITH c AS (SELECT p_brand AS symbol, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS usd FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY usd DESC, symbol) AS rank FROM c) SELECT upper(symbol) AS symbol, usd >= 50000 AND rank <= 20 AS market_cap_eligible FROM r")
def market_cap_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.market_cap_screen(fixtures.market_cap(spark, sf_dir), 50_000, 20)


STATS_SQL = """
k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back FROM bars),
st AS (SELECT symbol, count(*) AS history_days, max(date) AS last_date, avg(quote_volume) FILTER (back <= 30) AS avg_quote_vol_30, avg(quote_volume) FILTER (back <= 90) AS avg_quote_vol_90,
  avg(quote_volume) FILTER (back <= 180) AS avg_quote_vol_180, avg(CASE WHEN quote_volume > 0 THEN 1.0 ELSE 0.0 END) FILTER (back <= 180) AS tradable_ratio_180,
  count(*) FILTER (back <= 90 AND quote_volume >= 20000) AS liquid_days_90, count(*) FILTER (back <= 180 AND quote_volume >= 20000) AS liquid_days_180 FROM k GROUP BY symbol),
stats AS (SELECT *, least(avg_quote_vol_30, avg_quote_vol_90, avg_quote_vol_180) / greatest(avg_quote_vol_30, avg_quote_vol_90, avg_quote_vol_180) AS liquidity_stability FROM st)"""
_STATS = ["avg_quote_vol_30", "avg_quote_vol_90", "avg_quote_vol_180", "tradable_ratio_180", "liquidity_stability"]


@query("u9_recent_stats", P.sql("bars", "," + STATS_SQL + f" SELECT symbol, last_date, history_days, liquid_days_90, liquid_days_180, {rounds(_STATS, 4)} FROM stats"))
def recent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(universe.recent_stats(fixtures.bars(spark, sf_dir), 20_000), ["symbol", "last_date", "history_days", "liquid_days_90", "liquid_days_180"], _STATS, 4)


@query("u10_live_candidates", P.sql("bars", "," + fixtures.META_SQL + "," + STATS_SQL + """,
o AS (SELECT *, coalesce(history_days >= 328 AND avg_quote_vol_30 >= 60000 AND avg_quote_vol_90 >= 62400 AND avg_quote_vol_180 >= 62800 AND liquidity_stability >= 0.765 AND tradable_ratio_180 >= 0.882 AND liquid_days_90 >= 54 AND liquid_days_180 >= 108, false) AS ok
  FROM stats JOIN meta USING (symbol) WHERE (status = 'TRADING' AND is_spot_trading_allowed) OR symbol = 'Brand#1'),
r AS (SELECT *, row_number() OVER (ORDER BY ok DESC, avg_quote_vol_180 DESC, avg_quote_vol_90 DESC, avg_quote_vol_30 DESC, liquidity_stability DESC, tradable_ratio_180 DESC, history_days DESC, symbol) AS r, sum(ok::INT) OVER () AS n FROM o),
a AS (SELECT symbol, CASE WHEN ok OR r <= least(greatest(n, 6, 1), 10) THEN 'ranked' ELSE 'previous' END AS source, r FROM r
  WHERE ok OR r <= least(greatest(n, 6, 1), 10) OR symbol IN ('Brand#2', 'Brand#3', 'Brand#25', 'Brand#99')
  UNION ALL SELECT s, 'previous', NULL FROM (SELECT unnest(['Brand#2', 'Brand#3', 'Brand#25', 'Brand#99']) AS s) WHERE s NOT IN (SELECT symbol FROM r)),
b AS (SELECT symbol, source, r FROM a WHERE symbol <> 'Brand#1' UNION ALL SELECT 'Brand#1', 'benchmark', 0)
SELECT symbol, source, row_number() OVER (ORDER BY r NULLS LAST, symbol) AS place FROM b"""))  # fmt: skip
def live_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = universe.recent_stats(fixtures.bars(spark, sf_dir), 20_000)
    previous = spark.createDataFrame([(f"Brand#{n}",) for n in (2, 3, 25, 99)], "symbol string")
    return universe.live_candidates(stats, TEST, previous, 6, 10, fixtures.metadata(spark, sf_dir))


@query("u11_u12_download_candidates", P.sql("bars", "," + fixtures.META_SQL + "," + STATS_SQL + """,
t AS (SELECT p_brand AS symbol, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS ticker_volume, count(*)::DOUBLE AS trades FROM part GROUP BY 1),
j AS (SELECT meta.symbol, meta.symbol = 'Brand#1' AS bm, coalesce(history_days, 0)::DOUBLE AS history_days, coalesce(avg_quote_vol_180, 0) AS v180, coalesce(avg_quote_vol_90, 0) AS v90, coalesce(avg_quote_vol_30, 0) AS v30,
  coalesce(liquidity_stability, 0) AS ls, coalesce(tradable_ratio_180, 0) AS tr, coalesce(ticker_volume, 0) AS ticker_volume, coalesce(trades, 0) AS trades FROM meta LEFT JOIN stats USING (symbol) LEFT JOIN t USING (symbol)
  WHERE (status = 'TRADING' AND is_spot_trading_allowed OR meta.symbol = 'Brand#1') AND base_asset NOT LIKE '%USD%' AND upper(base_asset) <> 'BRAND#7'),
k2 AS (SELECT *, row_number() OVER (ORDER BY history_days > 0 DESC, v180 DESC, v90 DESC, v30 DESC, ls DESC, tr DESC, history_days DESC, ticker_volume DESC, trades DESC, symbol) AS download_rank FROM j),
k3 AS (SELECT *, row_number() OVER (ORDER BY bm DESC, download_rank) AS place FROM k2)
SELECT symbol, download_rank, place, round(v180, 4) AS avg_quote_vol_180, history_days, ticker_volume, trades FROM k3 WHERE place <= 12"""))  # fmt: skip
def download_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = universe.recent_stats(fixtures.bars(spark, sf_dir), 20_000)
    part = fixtures.table(spark, sf_dir, "part")
    tickers = part.groupBy(F.col("p_brand").alias("symbol")).agg(F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double").alias("ticker_volume"), F.count("*").alias("trades"))
    out = universe.download_candidates(fixtures.metadata(spark, sf_dir), stats, tickers, TEST, ("BRAND#7",), 12)
    return out.select("symbol", "download_rank", "place", F.round("avg_quote_vol_180", 4).alias("avg_quote_vol_180"), "history_days", "ticker_volume", "trades")


@query("a1_a3_date_context", P.sql("context", f"SELECT date, n_members, {rounds(list(scores.CONTEXT), 5)} FROM ctx"))
def date_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.date_context(P.universe_panel(spark, sf_dir, columns=P.CONTEXT_INPUTS), TEST), ["date", "n_members"], list(scores.CONTEXT), 5)


_LABELS = [f"{k}_{h}" for h in TEST.horizons for k in ("future_return", "future_rank_pct", "future_topk_label")] + ["blended_target"]


@query("l1_l5_labels", P.sql("labels", f"SELECT date, symbol, {rounds(_LABELS, 5)} FROM lab WHERE in_universe"))
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.labelled_panel(spark, sf_dir, columns=()).where("in_universe"), KEY, _LABELS, 5)


#: Every target that a model may be trained on.
_TARGETS = ("blended_rank_pct", *(f"{kind}_{h}" for h in TEST.horizons for kind in ("future_rank_pct", "future_return", "future_topk_label")))


@query("l5_targets", P.sql("labels", f"""SELECT date, symbol, unnest([{', '.join(f"'{t}'" for t in _TARGETS)}]) AS target, round(unnest([{', '.join('blended_target' if t == 'blended_rank_pct' else t for t in _TARGETS)}]), 5) AS value FROM lab WHERE in_universe"""))
def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column that each target's name selects."""
    panel = P.labelled_panel(spark, sf_dir, columns=()).where("in_universe")
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("target"), F.round(scores.target(t, TEST), 5).alias("value")) for t in _TARGETS)))
    return panel.select(*KEY, each.alias("x")).select(*KEY, "x.*")


@query("l6_label_ends", P.sql("labels", "SELECT date, max(CASE WHEN in_universe THEN greatest(end_30, end_60, end_90) END) AS label_end FROM lab GROUP BY date"))
def label_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.label_ends(P.universe_panel(spark, sf_dir, columns=()), TEST)


_RULES = ["rule_score_relative_strength_focus", "rule_score_balanced_leader", "rule_score_conservative_trend_quality"]


@query("e1_rule_scores", P.sql("rules", f"SELECT date, symbol, {rounds(_RULES)} FROM e2 WHERE in_universe"))
def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.rule_scores(P.universe_panel(spark, sf_dir, columns=P.RULE_INPUTS), TEST).where("in_universe"), KEY, _RULES)


@query("a4_e2_regime", P.sql("rules", "SELECT date, regime, round(regime_confidence, 5) AS regime_confidence FROM reg"))
def regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = P.universe_panel(spark, sf_dir, columns=(*P.CONTEXT_INPUTS, *P.REGIME_INPUTS))
    return scores.regimes(scores.date_facts(panel, TEST)).select("date", "regime", F.round("regime_confidence", 5).alias("regime_confidence"))


@query("e4_n5_final_ranking", P.sql("rules", "SELECT date, symbol, regime, round(final_score, 6) AS final_score, round(confidence, 6) AS confidence, current_rank, coalesce(current_rank <= 5, false) AS selected_flag FROM scored WHERE in_universe"))
def final_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.scored_panel(spark, sf_dir).where("in_universe").select(*KEY, "regime", F.round("final_score", 6).alias("final_score"), F.round("confidence", 6).alias("confidence"), "current_rank", "selected_flag")


@query("e3_e5_n6_three_components", P.sql("rules", f"""
, c0 AS (SELECT *, CASE WHEN in_universe AND raw IS NOT NULL THEN rs_risk_adj END AS lr, CASE WHEN in_universe AND raw IS NOT NULL AND day(date) % 4 <> 0 THEN momentum_combo END AS mr, CASE WHEN age_days % 7 < 5 THEN 1 ELSE 0 END AS seen FROM e3),
c1 AS (SELECT *, {P.rank_sql('raw')} AS r, {P.rank_sql('lr')} AS l, {P.rank_sql('mr')} AS m FROM c0),
c2 AS (SELECT *, CASE regime WHEN 'risk_off' THEN 0.5 WHEN 'broad_alt_strength' THEN 0.25 WHEN 'btc_dominant' THEN 0.4 ELSE 0.35 END::DOUBLE AS wr,
  CASE regime WHEN 'risk_off' THEN 0.25 WHEN 'broad_alt_strength' THEN 0.15 WHEN 'late_momentum' THEN 0.15 ELSE 0.2 END::DOUBLE AS wl,
  CASE regime WHEN 'risk_off' THEN 0.25 WHEN 'btc_dominant' THEN 0.4 WHEN 'broad_alt_strength' THEN 0.6 WHEN 'late_momentum' THEN 0.5 ELSE 0.45 END::DOUBLE AS wm FROM c1),
c3 AS (SELECT *, (coalesce(r * wr, 0) + coalesce(l * wl, 0) + coalesce(m * wm, 0)) / nullif(CASE WHEN r IS NULL THEN 0 ELSE wr END + CASE WHEN l IS NULL THEN 0 ELSE wl END + CASE WHEN m IS NULL THEN 0 ELSE wm END, 0) AS f,
  1 - 2 * least(greatest(coalesce((SELECT stddev_samp(x) FROM unnest([r, l, m]) AS t(x)), 0.5), 0), 0.5) AS agree FROM c2),
c4 AS (SELECT *, CASE WHEN f IS NOT NULL THEN least(greatest(0.6::DOUBLE * agree + 0.4::DOUBLE * abs(f - 0.5) * 2, 0), 1) END AS c FROM c3),
c5 AS (SELECT *, row_number() OVER (PARTITION BY date, in_universe AND f IS NOT NULL ORDER BY round(f, 12) DESC NULLS LAST, round(c, 12) DESC NULLS LAST, liquidity_stability DESC NULLS LAST, avg_quote_vol_180 DESC NULLS LAST, upper(symbol), symbol) AS k FROM c4)
SELECT date, symbol, CASE WHEN seen = 1 THEN round(f, 5) END AS final_score, CASE WHEN seen = 1 THEN round(c, 5) END AS confidence, CASE WHEN seen = 1 AND f IS NOT NULL THEN k END AS current_rank,
  coalesce(seen = 1 AND f IS NOT NULL AND k <= 5, false) AS selected_flag FROM c5 WHERE in_universe""".lstrip()))  # fmt: skip
def three_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and two stand-ins for model scores, one of them missing on every fourth day, and rows outside the prediction windows."""
    panel = P.universe_panel(spark, sf_dir, columns=(*P.RULE_INPUTS, *P.CONTEXT_INPUTS, *P.REGIME_INPUTS))
    panel = scores.with_regime(scores.rule_scores(scores.with_context(panel, TEST), TEST))
    models = {"linear_score_raw": F.col("rs_risk_adj"), "ml_score_raw": F.when(F.dayofmonth("date") % 4 != 0, F.col("momentum_combo")), "prediction_window_count": F.when(F.col("age_days") % 7 < 5, 1).otherwise(0)}
    out = scores.final_scores(panel.withColumns(models), TEST).where("in_universe")
    return out.select(*KEY, F.round("final_score", 5).alias("final_score"), F.round("confidence", 5).alias("confidence"), "current_rank", "selected_flag")


@query("n7_n8_p8_latest_snapshot", P.sql("rules", "SELECT date, symbol, current_rank, round(final_score, 6) AS final_score, round(avg_quote_vol_180, 4) AS avg_quote_vol_180 FROM scored WHERE in_universe AND date = (SELECT max(date) FROM scored WHERE date <= DATE '1998-06-30')"))
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = scores.snapshot(P.scored_panel(spark, sf_dir), F.lit("1998-06-30").cast("date"))
    return snap.where("in_universe").select(*KEY, "current_rank", F.round("final_score", 6).alias("final_score"), F.round("avg_quote_vol_180", 4).alias("avg_quote_vol_180"))
