"""The panel over the driver's tables, up to any stage, and the same as SQL for the oracles.

Features are a lazy plan; what follows reads the written feature panel, and portfolios the written scored one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelrank.config import RULE_SCHEMES, TEST, Params
from panelrank.fixtures import META_SQL, bars, bars_sql, metadata
from panelrank.functions.tables import stored
from panelrank.operators import features, scores, universe


def features_panel(spark: SparkSession, sf_dir: str, params: Params = TEST) -> DataFrame:
    return features.feature_panel(bars(spark, sf_dir), params)


#: What the tests of membership read, and what context, regime and ranking read beside it.
TESTED = ("date", "symbol", "quote_volume", "age_days", "avg_quote_vol_30", "avg_quote_vol_90", "avg_quote_vol_180", "liquidity_stability", "tradable_ratio_180")
CONTEXT_INPUTS = ("price_vs_sma60", "price_vs_sma200", "momentum_combo", "rs_combo")
REGIME_INPUTS = ("benchmark_above_sma200", "benchmark_z120")
RULE_INPUTS = tuple(sorted({f for scheme in RULE_SCHEMES.values() for f in scheme}))


def universe_panel(spark: SparkSession, sf_dir: str, params: Params = TEST, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The panel with membership; `columns` of the features beside those that membership needs, by default all. Only these are
    written, so only these are computed."""
    panel = features_panel(spark, sf_dir, params)
    if columns is not None:
        panel = panel.select(*(c for c in dict.fromkeys((*TESTED, *columns)) if c in panel.columns))
    return universe.dynamic_universe(stored(panel, "features"), metadata(spark, sf_dir), params)


def labelled_panel(spark: SparkSession, sf_dir: str, params: Params = TEST, columns: tuple[str, ...] | None = None) -> DataFrame:
    """With context and labels; `columns` as above, CONTEXT_INPUTS among them where the context is wanted."""
    panel = universe_panel(spark, sf_dir, params, None if columns is None else ("close", *columns))
    wants_context = columns is None or set(CONTEXT_INPUTS) <= set(columns)
    return scores.labels(scores.with_context(panel, params) if wants_context else panel, params)


def scored_panel(spark: SparkSession, sf_dir: str, params: Params = TEST, columns: tuple[str, ...] = ()) -> DataFrame:
    """Membership, context, regime, rule and final scores, and `columns`: final_score comes from the rules alone."""
    wanted = (*RULE_INPUTS, *CONTEXT_INPUTS, *REGIME_INPUTS, *columns)
    panel = universe_panel(spark, sf_dir, params, wanted)
    dates = stored(scores.regimes(scores.date_facts(panel, params)), "dates")
    panel = scores.rule_scores(panel, params).join(dates.select("date", "regime", "regime_confidence"), "date", "left")
    kept = ("date", "symbol", "in_universe", "universe_snapshot_date", "regime", "regime_confidence", "rule_score", "linear_score", "ml_score", "final_score", "confidence", "current_rank", "selected_flag", "liquidity_stability", "avg_quote_vol_180", *columns)
    return stored(scores.final_scores(panel, params).select(*dict.fromkeys(kept)), "scored")


def _roll(agg: str, x: str, n: int, least: int | None = None) -> str:
    return f"CASE WHEN count({x}) OVER w{n} >= {n if least is None else least} THEN {agg}({x}) OVER w{n} END"


WINDOWS = "WINDOW w AS (PARTITION BY symbol ORDER BY date), " + ", ".join(
    f"w{n} AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (14, 20, 30, 50, 60, 90, 120, 180, 200, 252)
)
YEAR = "sqrt(365.0::DOUBLE)"

FEATURES_SQL = f"""
f1 AS (SELECT *, {", ".join(f"{_roll('avg', 'close', n)} AS sma{n}" for n in (20, 60, 120, 200))},
  exp({_roll('avg', 'ln(greatest(close, 1e-10))', 200)}) AS gma200,
  {", ".join(f"close / lag(close, {n}) OVER w - 1 AS roc{n}" for n in (20, 60, 120))}, close / lag(close) OVER w - 1 AS ret1,
  lag(close) OVER w AS pc FROM bars {WINDOWS}),
f2 AS (SELECT *, {_roll('stddev_samp', 'ret1', 20)} * {YEAR} AS vol20, {_roll('stddev_samp', 'ret1', 60)} * {YEAR} AS vol60,
  {_roll('stddev_samp', '(CASE WHEN ret1 < 0 THEN ret1 ELSE 0.0::DOUBLE END)', 60)} * {YEAR} AS downside_vol60,
  greatest(high - low, abs(high - pc), abs(low - pc)) AS true_range,
  close / max(close) OVER w180 - 1 AS drawdown180,
  (close / {_roll('max', 'close', 50)} - 1) * 100 AS dd,
  (close - {_roll('avg', 'close', 120)}) / nullif({_roll('stddev_samp', 'close', 120)}, 0) AS zscore120,
  CASE WHEN close > sma200 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS above200,
  {", ".join(f"{_roll('avg', 'quote_volume', n)} AS avg_quote_vol_{n}" for n in (30, 90, 180))},
  row_number() OVER w AS age_days, CASE WHEN quote_volume > 0 AND close IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS trade,
  CASE WHEN quote_volume >= 20000 THEN 1 ELSE 0 END AS above_floor
  FROM f1 {WINDOWS}),
f3 AS (SELECT *, {_roll('avg', 'true_range', 14)} AS atr14, sqrt({_roll('avg', '(dd * dd)', 50)}) AS ulcer50,
  {", ".join(f"close / nullif(sma{n}, 0) - 1 AS price_vs_sma{n}" for n in (20, 60, 120, 200))},
  {_roll('avg', 'above200', 90)} AS trend_persist_90, sma200 / nullif(lag(sma200, 20) OVER w, 0) - 1 AS ma200_slope,
  close / {_roll('max', 'close', 90)} - 1 AS dist_to_90d_high, close / {_roll('max', 'close', 180)} - 1 AS dist_to_180d_high,
  0.5::DOUBLE * roc20 + 0.3::DOUBLE * roc60 + 0.2::DOUBLE * roc120 AS momentum_combo,
  least(avg_quote_vol_30, avg_quote_vol_90, avg_quote_vol_180) / nullif(greatest(avg_quote_vol_30, avg_quote_vol_90, avg_quote_vol_180), 0) AS liquidity_stability,
  {_roll('avg', 'trade', 180, 30)} AS tradable_ratio_180, avg_quote_vol_30 / nullif(avg_quote_vol_180, 0) - 1 AS liquidity_acceleration,
  {_roll('sum', 'above_floor', 90)} AS liquid_days_90, {_roll('sum', 'above_floor', 180)} AS liquid_days_180
  FROM f2 {WINDOWS}),
f4 AS (SELECT *, 1 + dist_to_90d_high AS breakout_proximity, momentum_combo / nullif(vol20, 0) AS risk_adjusted_momentum, atr14 / nullif(close, 0) AS atr_ratio,
  abs(drawdown180) * (1 + coalesce(ulcer50, 0) / 100) AS drawdown_severity, -downside_vol60 AS downside_vol_penalty,
  -(abs(drawdown180) * (1 + coalesce(ulcer50, 0) / 100)) AS drawdown_penalty FROM f3),
b AS (SELECT date, roc20 AS b20, roc60 AS b60, roc120 AS b120, ret1 AS bret, close AS bclose, sma200 AS bsma, zscore120 AS benchmark_z120, ma200_slope AS benchmark_ma200_slope FROM f4 WHERE symbol = 'Brand#1'),
r1 AS (SELECT f4.*, roc20 - b20 AS rs20, roc60 - b60 AS rs60, roc120 - b120 AS rs120, bret, benchmark_z120, benchmark_ma200_slope,
  CASE WHEN bclose IS NOT NULL THEN CASE WHEN bclose > bsma THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS benchmark_above_sma200,
  CASE WHEN ret1 IS NOT NULL AND bret IS NOT NULL THEN ret1 END AS pr, CASE WHEN ret1 IS NOT NULL AND bret IS NOT NULL THEN bret END AS pb
  FROM f4 LEFT JOIN b ON f4.date = b.date),
r2 AS (SELECT *, 0.5::DOUBLE * rs20 + 0.3::DOUBLE * rs60 + 0.2::DOUBLE * rs120 AS rs_combo,
  CASE WHEN symbol = 'Brand#1' THEN 1.0::DOUBLE ELSE (CASE WHEN count(pr) OVER w60 >= 60 THEN covar_samp(pr, pb) OVER w60 END) / nullif({_roll('var_samp', 'bret', 60)}, 0) END AS beta60,
  CASE WHEN symbol = 'Brand#1' THEN 1.0::DOUBLE ELSE CASE WHEN count(pr) OVER w60 >= 60 THEN corr(pr, pb) OVER w60 END END AS corr60
  FROM r1 {WINDOWS}),
panel AS (SELECT *, rs_combo / nullif(vol20, 0) AS rs_risk_adj FROM r2)""".strip()

UNIVERSE_SQL = """
m AS (SELECT symbol, ((status = 'TRADING' AND quote_asset = 'USDT' AND is_spot_trading_allowed AND NOT regexp_matches(upper(base_asset), 'UP|DOWN|BULL|BEAR')) OR symbol = 'Brand#1') AS metadata_eligible,
  symbol = 'Brand#1' AS is_benchmark FROM meta),
u1 AS (SELECT p.*, m.metadata_eligible, m.is_benchmark, coalesce(age_days >= 365, false) AS history_eligible,
  coalesce(avg_quote_vol_30 >= 75000 AND avg_quote_vol_90 >= 78000 AND avg_quote_vol_180 >= 78500 AND liquidity_stability >= 0.85, false) AS liquidity_eligible,
  coalesce(tradable_ratio_180 >= 0.9, false) AS tradable_eligible, coalesce(liquid_days_90, 0) >= 60 AND coalesce(liquid_days_180, 0) >= 120 AS continuous_eligible
  FROM panel p LEFT JOIN m USING (symbol)),
u2 AS (SELECT *, metadata_eligible AND history_eligible AND liquidity_eligible AND tradable_eligible AND continuous_eligible AND NOT is_benchmark AS candidate_eligible FROM u1),
s0 AS (SELECT max(date) AS date FROM u2 GROUP BY date_trunc('month', date) UNION SELECT min(date) FROM u2),
s1 AS (SELECT date, lead(date) OVER (ORDER BY date) AS nx, row_number() OVER (ORDER BY date DESC) AS r FROM s0),
refresh AS (SELECT date FROM s1 WHERE NOT (r = 2 AND date_diff('day', date, nx) = 1 AND month(nx) <> month(date))),
g0 AS (SELECT s.symbol, refresh.date AS snap, coalesce(candidate_eligible, false) AS ok FROM (SELECT DISTINCT symbol FROM u2) s CROSS JOIN refresh LEFT JOIN u2 ON u2.symbol = s.symbol AND u2.date = refresh.date),
g1 AS (SELECT *, CASE WHEN ok = lag(ok) OVER (PARTITION BY symbol ORDER BY snap) THEN 0 ELSE 1 END AS new FROM g0),
g2 AS (SELECT *, sum(new) OVER (PARTITION BY symbol ORDER BY snap) AS island FROM g1),
g3 AS (SELECT *, row_number() OVER (PARTITION BY symbol, island ORDER BY snap) AS streak FROM g2),
g4 AS (SELECT *, CASE WHEN ok AND streak >= 2 THEN true WHEN NOT ok AND streak >= 2 THEN false END AS event FROM g3),
member AS (SELECT symbol, snap, coalesce(last_value(event IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY snap ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS member FROM g4),
days AS (SELECT DISTINCT date FROM u2),
snaps AS (SELECT days.date, max(refresh.date) AS universe_snapshot_date FROM days JOIN refresh ON refresh.date <= days.date GROUP BY days.date),
uni AS (SELECT u2.*, universe_snapshot_date, coalesce(member.member, false) AND NOT is_benchmark AS in_universe
  FROM u2 JOIN snaps USING (date) LEFT JOIN member ON member.symbol = u2.symbol AND member.snap = universe_snapshot_date)""".strip()

CONTEXT_SQL = """
ctx0 AS (SELECT date, count(*) AS n_members, avg(CASE WHEN price_vs_sma60 > 0 THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN price_vs_sma200 > 0 THEN 1.0 ELSE 0.0 END) AS b,
  stddev_samp(momentum_combo) AS c, stddev_samp(rs_combo) AS d, max(momentum_combo) - median(momentum_combo) AS e FROM uni WHERE in_universe GROUP BY date),
ctx AS (SELECT date, n_members, CASE WHEN n_members >= 5 THEN a END AS breadth_above_sma60, CASE WHEN n_members >= 5 THEN b END AS breadth_above_sma200,
  CASE WHEN n_members >= 5 THEN c END AS momentum_dispersion, CASE WHEN n_members >= 5 THEN d END AS rs_dispersion, CASE WHEN n_members >= 5 THEN e END AS single_leader_burst FROM ctx0)""".strip()


def rank_sql(x: str, by: str = "date") -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY {by} ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY {by}, {x}) - 1) / 2.0::DOUBLE) / count({x}) OVER (PARTITION BY {by}) END"


LABELS_SQL = f"""
l1 AS (SELECT uni.*, ctx.n_members, breadth_above_sma60, breadth_above_sma200, momentum_dispersion, rs_dispersion, single_leader_burst,
  {", ".join(f"lead(close, {h}) OVER w / close - 1 AS future_return_{h}, lead(date, {h}) OVER w AS end_{h}" for h in (30, 60, 90))}
  FROM uni LEFT JOIN ctx USING (date) WINDOW w AS (PARTITION BY symbol ORDER BY date)),
l2 AS (SELECT *, {", ".join(f"CASE WHEN in_universe THEN future_return_{h} END AS m{h}" for h in (30, 60, 90))} FROM l1),
l3 AS (SELECT *, {", ".join(f"{rank_sql(f'm{h}')} AS future_rank_pct_{h}, CASE WHEN m{h} IS NOT NULL THEN CASE WHEN row_number() OVER (PARTITION BY date ORDER BY m{h} DESC NULLS LAST, symbol) <= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS future_topk_label_{h}" for h in (30, 60, 90))} FROM l2),
lab AS (SELECT *, CASE WHEN coalesce(future_rank_pct_30, future_rank_pct_60, future_rank_pct_90) IS NOT NULL THEN
  (coalesce(future_rank_pct_30, 0) * 0.5::DOUBLE + coalesce(future_rank_pct_60, 0) * 0.35::DOUBLE + coalesce(future_rank_pct_90, 0) * 0.15::DOUBLE) / 1.0::DOUBLE END AS blended_target FROM l3)""".strip()

_USED = sorted({f for s in RULE_SCHEMES.values() for f in s})
RULES_SQL = f"""
e0 AS (SELECT *, {", ".join(f"CASE WHEN in_universe THEN {f} END AS u_{f}" for f in _USED)} FROM lab),
e1 AS (SELECT *, {", ".join(f"{rank_sql(f'u_{f}')} AS k_{f}" for f in _USED)} FROM e0),
e2 AS (SELECT *, {", ".join("CASE WHEN in_universe THEN " + " + ".join(f"coalesce(k_{f}, 0) * {w}::DOUBLE" for f, w in s.items()) + f" END AS rule_score_{n}" for n, s in RULE_SCHEMES.items())} FROM e1),
g AS (SELECT date, max(breadth_above_sma60) AS b60, max(breadth_above_sma200) AS b200, max(momentum_dispersion) AS md, max(rs_dispersion) AS rd, max(single_leader_burst) AS sb,
  coalesce(max(benchmark_above_sma200) > 0, false) AS above, max(benchmark_z120) AS z FROM e2 GROUP BY date),
h AS (SELECT date, CASE WHEN (NOT above AND coalesce(b200 < 0.35, false)) OR coalesce(b60 < 0.25, false) THEN 'risk_off'
  WHEN above AND coalesce(b60 < 0.35, false) AND coalesce(z > 0, false) THEN 'btc_dominant'
  WHEN above AND coalesce(b60 > 0.55, false) AND coalesce(b200 > 0.4, false) AND (sb IS NULL OR coalesce(sb < greatest(md, 0), false)) THEN 'broad_alt_strength' ELSE 'late_momentum' END AS regime, b60, b200, rd, sb, z FROM g),
reg AS (SELECT date, regime, CASE regime WHEN 'risk_off' THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.35::DOUBLE - coalesce(b200, 0)) * 2.5::DOUBLE)
  WHEN 'btc_dominant' THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.35::DOUBLE - b60) * 2.5::DOUBLE + least(0.5::DOUBLE, z / 3))
  WHEN 'broad_alt_strength' THEN least(1.0::DOUBLE, 2 * greatest(0.0::DOUBLE, b60 - 0.55::DOUBLE) + 2 * greatest(0.0::DOUBLE, b200 - 0.4::DOUBLE))
  ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(sb, 0)) + greatest(0.0::DOUBLE, coalesce(rd, 0))) END AS regime_confidence FROM h),
e3 AS (SELECT e2.*, regime, regime_confidence, CASE WHEN in_universe THEN rule_score_balanced_leader END AS raw FROM e2 LEFT JOIN reg USING (date)),
e4 AS (SELECT *, {rank_sql('raw')} AS rule_score FROM e3),
e5 AS (SELECT *, rule_score AS final_score, CASE WHEN rule_score IS NOT NULL THEN least(greatest(0.4::DOUBLE * abs(rule_score - 0.5::DOUBLE) * 2, 0), 1) END AS confidence FROM e4),
scored AS (SELECT *, CASE WHEN in_universe AND final_score IS NOT NULL THEN row_number() OVER (PARTITION BY date, in_universe AND final_score IS NOT NULL
  ORDER BY round(final_score, 12) DESC NULLS LAST, round(confidence, 12) DESC NULLS LAST, liquidity_stability DESC NULLS LAST, avg_quote_vol_180 DESC NULLS LAST, upper(symbol), symbol) END AS current_rank FROM e5)""".strip()


def sql(upto: str, select: str) -> str:
    """An oracle: the common table expressions up to a stage, then `select`."""
    parts = {"bars": [bars_sql()], "features": [FEATURES_SQL], "universe": [META_SQL, UNIVERSE_SQL], "context": [CONTEXT_SQL], "labels": [LABELS_SQL], "rules": [RULES_SQL]}
    names = list(parts)
    ctes = [c for n in names[: names.index(upto) + 1] for c in parts[n]]
    return "WITH " + ",\n".join(ctes) + "\n" + select
