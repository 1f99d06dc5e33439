"""Queries of portfolios, returns and their evaluation. They run on bars of every calendar day."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.config import TEST
from panelrank.functions.windows import by_symbol
from panelrank.operators import calendar, evaluation, features, portfolio
from panelrank.plans.q_panel import rounded, rounds

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
PARAMS = replace(TEST, horizons=(30, 60, 90))


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def momentum_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense bars with 60-row momentum as score, 20-row volatility, future returns, and names of age over 120 as members."""
    dense = features.volatility(features.averages(fixtures.dense_bars(fixtures.bars(spark, sf_dir))))
    aged = dense.withColumn("age", F.row_number().over(by_symbol()))
    member = (F.col("age") > 120) & (F.col("symbol") != TEST.benchmark)
    future = {f"future_return_{h}": F.try_divide(F.lead("close", h).over(by_symbol()), F.col("close")) - 1 for h in PARAMS.horizons}
    out = aged.withColumns(future).withColumns({"in_universe": member, "score": F.round("roc60", 9), "vol20": F.round("vol20", 9)})
    return out.select("date", "symbol", "open", "close", "vol20", "in_universe", "score", *future)


MOMENTUM = ("WITH " + fixtures.bars_sql() + """,
sp AS (SELECT s.symbol, d.date FROM (SELECT DISTINCT symbol FROM bars) s CROSS JOIN (SELECT unnest(generate_series((SELECT min(date) FROM bars)::TIMESTAMP, (SELECT max(date) FROM bars)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date) d),
de0 AS (SELECT sp.symbol, sp.date, open, close, last_value(close IGNORE NULLS) OVER (PARTITION BY sp.symbol ORDER BY sp.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lc
  FROM sp LEFT JOIN bars ON bars.symbol = sp.symbol AND bars.date = sp.date),
de AS (SELECT symbol, date, coalesce(open, lc) AS open, coalesce(close, lc) AS close FROM de0 WHERE lc IS NOT NULL),
de1 AS (SELECT *, close / lag(close) OVER w - 1 AS ret1, close / lag(close, 60) OVER w - 1 AS roc60, row_number() OVER w AS age,
  lead(close, 30) OVER w / close - 1 AS future_return_30, lead(close, 60) OVER w / close - 1 AS future_return_60, lead(close, 90) OVER w / close - 1 AS future_return_90
  FROM de WINDOW w AS (PARTITION BY symbol ORDER BY date)),
mp AS MATERIALIZED (SELECT date, symbol, open, close, round(CASE WHEN count(ret1) OVER v >= 20 THEN stddev_samp(ret1) OVER v * sqrt(365.0::DOUBLE) END, 9) AS vol20, age > 120 AND symbol <> 'Brand#1' AS in_universe, round(roc60, 9) AS score,
  future_return_30, future_return_60, future_return_90 FROM de1 WINDOW v AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""")  # fmt: skip

EVENTS = """,
cal AS MATERIALIZED (SELECT date, lead(date) OVER (ORDER BY date) AS nd FROM (SELECT DISTINCT date FROM mp)),
sg AS (SELECT max(date) AS date FROM cal GROUP BY date_trunc('week', date) UNION SELECT min(date) FROM cal),
ev AS MATERIALIZED (SELECT row_number() OVER (ORDER BY nd) - 1 AS k, sg.date AS signal_date, nd AS effective_date, lag(nd) OVER (ORDER BY nd) AS prev_date FROM sg JOIN cal USING (date) WHERE nd IS NOT NULL),
sel AS (SELECT date, symbol, 1 / greatest(vol20, 0.05::DOUBLE) AS x, row_number() OVER (PARTITION BY date ORDER BY score DESC, symbol) AS r FROM mp WHERE in_universe AND score IS NOT NULL AND vol20 IS NOT NULL),
wt AS MATERIALIZED (SELECT date, symbol, x / sum(x) OVER (PARTITION BY date) AS weight FROM sel WHERE r <= 3),
tg AS MATERIALIZED (SELECT k, effective_date, symbol, weight FROM ev JOIN wt ON ev.signal_date = wt.date),
cr AS (SELECT ev.k, p.symbol, p.weight AS wp, p.weight * p1.open / p0.open AS gr FROM tg p JOIN ev ON ev.prev_date = p.effective_date
  JOIN mp p0 ON p0.date = p.effective_date AND p0.symbol = p.symbol JOIN mp p1 ON p1.date = ev.effective_date AND p1.symbol = p.symbol),
cb AS (SELECT k, symbol, gr / (1 - sum(wp) OVER (PARTITION BY k) + sum(gr) OVER (PARTITION BY k)) AS b FROM cr),
bo AS MATERIALIZED (SELECT k, symbol, coalesce(b, 0) AS b, coalesce(weight, 0) AS w FROM cb FULL JOIN (SELECT k, symbol, weight FROM tg) USING (k, symbol)),
-- g + c * sum|w g - b| = 1 is piecewise linear and rising in g: try each piece between the sorted b / w
br AS (SELECT DISTINCT k, CASE WHEN w > 0 THEN b / w ELSE 0 END AS t FROM bo UNION SELECT k, 0 FROM bo UNION SELECT k, 1 FROM bo),
vl AS (SELECT br.k, t, t + 0.0015::DOUBLE * sum(abs(w * t - b)) AS f FROM br JOIN bo USING (k) WHERE t <= 1 GROUP BY br.k, t),
lo AS (SELECT k, max(t) AS t FROM vl WHERE f <= 1 GROUP BY k),
gs AS (SELECT lo.k, lo.t, sum(CASE WHEN w > 0 AND b / w <= lo.t THEN w WHEN w > 0 THEN -w ELSE 0 END) AS slope, sum(CASE WHEN w > 0 AND b / w <= lo.t THEN -b WHEN w > 0 THEN b ELSE b END) AS base FROM lo JOIN bo USING (k) GROUP BY lo.k, lo.t),
fg AS (SELECT k, (1 - 0.0015::DOUBLE * base) / (1 + 0.0015::DOUBLE * slope) AS g FROM gs),
pl AS MATERIALIZED (SELECT ev.*, coalesce(g, 1) AS g, coalesce((SELECT sum(abs(w * fg.g - b)) / 2 FROM bo WHERE bo.k = ev.k), 0) AS turnover FROM ev LEFT JOIN fg USING (k)),
se AS MATERIALIZED (SELECT cal.date, cal.nd, (SELECT max(effective_date) FROM ev WHERE effective_date <= cal.date) AS sd FROM cal),
mv AS (SELECT se.date, tg.symbol, weight, weight * q.open / p.open AS m0, CASE WHEN n.open IS NOT NULL THEN weight * n.open / p.open END AS m1 FROM se JOIN tg ON tg.effective_date = sd
  JOIN mp p ON p.date = sd AND p.symbol = tg.symbol JOIN mp q ON q.date = se.date AND q.symbol = tg.symbol LEFT JOIN mp n ON n.date = se.nd AND n.symbol = tg.symbol),
va AS (SELECT date, 1 - sum(weight) + sum(m0) AS v0, 1 - sum(weight) + sum(m1) AS v1 FROM mv GROUP BY date),
rt AS MATERIALIZED (SELECT se.date, CASE WHEN sd IS NULL THEN 0 ELSE (CASE WHEN se.nd IS NULL THEN 1 ELSE coalesce(v1, 1) / coalesce(v0, 1) END) * coalesce(g, 1) - 1 END AS net_return, coalesce(turnover, 0) AS turnover
  FROM se LEFT JOIN va USING (date) LEFT JOIN pl ON pl.effective_date = se.date),
re AS (SELECT *, exp(sum(ln(1 + net_return)) OVER (ORDER BY date)) AS equity FROM rt)"""


@query("b1_b3_weights", MOMENTUM + EVENTS + " SELECT date, symbol, round(weight, 6) AS weight FROM wt")
def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.select_weights(momentum_panel(spark, sf_dir), "score", PARAMS), ["date", "symbol"], ["weight"])


@query("b4_b6_b9_events", MOMENTUM + EVENTS + " SELECT k, signal_date, effective_date, round(g, 6) AS g, round(turnover, 6) AS turnover FROM pl")
def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, _, _ = portfolio.rebalances(momentum_panel(spark, sf_dir), "score", PARAMS)
    return rounded(plan, ["k", "signal_date", "effective_date"], ["g", "turnover"])


@query("b5_b10_trades", MOMENTUM + EVENTS + " SELECT effective_date, signal_date, symbol, round(b, 6) AS weight_before, round(w * g, 6) AS weight_after, round(w * g - b, 6) AS weight_change, 'score' AS score_source FROM bo JOIN pl USING (k) WHERE round(w * g - b, 12) <> 0")
def trade_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.trades(momentum_panel(spark, sf_dir), "score", PARAMS), ["effective_date", "signal_date", "symbol", "score_source"], ["weight_before", "weight_after", "weight_change"])


@query("b7_b8_daily_returns", MOMENTUM + EVENTS + " SELECT date, round(net_return, 6) AS net_return, round(turnover, 6) AS turnover, round(ln(equity), 5) AS log_equity FROM re")
def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = portfolio.daily_returns(momentum_panel(spark, sf_dir), "score", PARAMS)
    return out.select("date", F.round("net_return", 6).alias("net_return"), F.round("turnover", 6).alias("turnover"), F.round(F.ln("equity"), 5).alias("log_equity"))


@query("b11_holdings", MOMENTUM + EVENTS + " SELECT date, symbol, round(m0 / (1 - sum(weight) OVER (PARTITION BY date) + sum(m0) OVER (PARTITION BY date)), 6) AS weight FROM mv")
def held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.holdings(momentum_panel(spark, sf_dir), "score", PARAMS), ["date", "symbol"], ["weight"])


@query("b12_guards", MOMENTUM + EVENTS + """ SELECT unnest(['membership_missing', 'score_not_finite', 'days_missing', 'price_not_positive', 'weights_not_long_only', 'cost_out_of_range']) AS "check",
  unnest([(SELECT count(*) FROM mp WHERE in_universe IS NULL), (SELECT count(*) FROM mp WHERE in_universe AND isinf(score)), (SELECT date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) FROM mp),
  (SELECT count(*) FROM tg LEFT JOIN mp ON mp.date = effective_date AND mp.symbol = tg.symbol WHERE NOT coalesce(open > 0, false)), (SELECT count(*) FROM (SELECT k FROM tg GROUP BY k HAVING sum(weight) > 1 + 1e-12 OR min(weight) < 0)), 0]) AS violations""")  # fmt: skip
def guard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.guards(momentum_panel(spark, sf_dir), "score", PARAMS)


PERFORMANCE = """ma AS (SELECT *, equity / greatest(max(equity) OVER (ORDER BY date), 1) - 1 AS dd FROM re),
pf AS (SELECT 'score' AS strategy, count(*) AS observations, exp(sum(ln(1 + net_return))) ** (365.0::DOUBLE / count(*)) - 1 AS cagr, stddev_pop(net_return) * sqrt(365.0::DOUBLE) AS volatility, avg(net_return) * 365 AS mean,
  sqrt(avg(CASE WHEN net_return < 0 THEN net_return * net_return ELSE 0 END)) * sqrt(365.0::DOUBLE) AS down, min(dd) AS max_drawdown, avg(CASE WHEN net_return > 0 THEN 1.0 ELSE 0.0 END) AS win_rate, avg(turnover) * 365 AS turnover FROM ma)"""


@query("v2_v7_performance", MOMENTUM + EVENTS + "," + PERFORMANCE + """ SELECT strategy, observations, round(cagr, 4) AS cagr, round(volatility, 5) AS volatility, round(mean / volatility, 4) AS sharpe, round(mean / down, 4) AS sortino,
  round(max_drawdown, 5) AS max_drawdown, round(cagr / abs(max_drawdown), 4) AS calmar, round(win_rate, 6) AS win_rate, round(turnover, 4) AS turnover FROM pf""")  # fmt: skip
def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = portfolio.suite(momentum_panel(spark, sf_dir), ["score"], PARAMS)
    digits = {"cagr": 4, "volatility": 5, "sharpe": 4, "sortino": 4, "max_drawdown": 5, "calmar": 4, "win_rate": 6, "turnover": 4}
    return evaluation.performance(daily, ["strategy"]).select("strategy", "observations", *(F.round(c, d).alias(c) for c, d in digits.items()))


@query("v1_return_faults", MOMENTUM + EVENTS + " SELECT 'score' AS strategy, count(*) AS n_rows, 0::BIGINT AS leading_gap, count(*) - count(DISTINCT date) AS repeated_dates, count(*) FILTER (net_return IS NULL) AS inner_gaps, count(*) FILTER (isinf(net_return)) AS not_finite, count(*) FILTER (net_return <= -1) AS at_most_minus_one FROM re")
def faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = portfolio.suite(momentum_panel(spark, sf_dir), ["score"], PARAMS)
    return evaluation.return_faults(daily, ["strategy"])


LEADERS = """,
wk AS (SELECT max(date) AS date FROM (SELECT DISTINCT date FROM mp) GROUP BY date_trunc('week', date) UNION SELECT min(date) FROM mp),
lg AS (SELECT date, symbol, score, unnest([30, 60, 90]) AS horizon, unnest([future_return_30, future_return_60, future_return_90]) AS future FROM mp JOIN wk USING (date) WHERE in_universe AND score IS NOT NULL),
lr AS (SELECT *, row_number() OVER (PARTITION BY date, horizon ORDER BY score DESC, symbol) AS r, row_number() OVER (PARTITION BY date, horizon ORDER BY future DESC, symbol) AS f, count(*) OVER (PARTITION BY date, horizon) AS n FROM lg WHERE future IS NOT NULL),
ld AS (SELECT date, horizon, count(*) FILTER (r <= 3 AND f <= 3) AS o, max(CASE WHEN r <= 3 AND f = 1 THEN 1.0 ELSE 0.0 END) AS c, avg(CASE WHEN f <= 3 THEN r END) AS a FROM lr WHERE n >= 3 GROUP BY date, horizon)"""


@query("v3_leader_selection", MOMENTUM + LEADERS + " SELECT horizon, count(*) AS dates, round(avg(o / 3.0), 6) AS precision, round(avg(o / 3.0), 6) AS recall, round(avg(CASE WHEN o > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate, round(avg(c), 6) AS leader_capture, round(avg(a), 6) AS avg_rank, round(avg(o), 6) AS overlap FROM ld GROUP BY horizon")
def leader_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.leader_selection(momentum_panel(spark, sf_dir), "score", PARAMS), ["horizon", "dates"], list(evaluation.LEADER))


POOLS = """,
mo AS (SELECT max(date) AS date FROM (SELECT DISTINCT date FROM mp) GROUP BY date_trunc('month', date) UNION SELECT min(date) FROM mp),
pr AS (SELECT mp.*, row_number() OVER (PARTITION BY date ORDER BY score DESC, symbol) AS r, count(*) OVER (PARTITION BY date) AS n FROM mp JOIN mo USING (date) WHERE in_universe AND score IS NOT NULL),
po AS (SELECT date, list(symbol ORDER BY r) AS pool FROM pr WHERE n >= 5 AND r <= 5 GROUP BY date),
ps AS (SELECT *, CASE WHEN lag(pool) OVER (ORDER BY date) IS NOT NULL THEN len(list_intersect(pool, lag(pool) OVER (ORDER BY date))) / 5.0::DOUBLE END AS stability FROM po),
ph AS (SELECT date, symbol, r, unnest([30, 60, 90]) AS horizon, unnest([future_return_30, future_return_60, future_return_90]) AS future FROM pr WHERE n >= 5),
pf0 AS (SELECT *, row_number() OVER (PARTITION BY date, horizon ORDER BY future DESC, symbol) AS f, count(*) OVER (PARTITION BY date, horizon) AS m,
  rank() OVER (PARTITION BY date, horizon ORDER BY future DESC) + (count(*) OVER (PARTITION BY date, horizon, future) - 1) / 2.0::DOUBLE AS fr FROM ph WHERE future IS NOT NULL),
pm AS (SELECT date, horizon, count(*) FILTER (r <= 5) AS seen, count(*) FILTER (r <= 5 AND f <= 3) AS overlap, max(CASE WHEN r <= 5 AND f = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS leader_capture,
  avg(CASE WHEN r <= 5 THEN fr END) AS avg_future_rank, avg(CASE WHEN r <= 5 THEN future END) AS mean_future_return FROM pf0 WHERE m >= 5 GROUP BY date, horizon HAVING count(*) FILTER (r <= 5) > 0),
pv AS (SELECT ps.date, h.horizon, array_to_string(pool, ',') AS pool_symbols, stability, 1 - stability AS churn, overlap, overlap / 5.0::DOUBLE AS precision, overlap / 3.0::DOUBLE AS recall, leader_capture, avg_future_rank, mean_future_return
  FROM ps CROSS JOIN (SELECT unnest([30, 60, 90]) AS horizon) h LEFT JOIN pm ON pm.date = ps.date AND pm.horizon = h.horizon)"""
_POOL = ["stability", "churn", "precision", "recall", "leader_capture", "avg_future_rank", "mean_future_return"]


@query("v4_n9_pool_validation", MOMENTUM + POOLS + f" SELECT date, horizon, pool_symbols, overlap, {rounds(_POOL)} FROM pv")
def pool_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.pool_validation(momentum_panel(spark, sf_dir), "score", PARAMS), ["date", "horizon", "pool_symbols", "overlap"], _POOL)


@query("v5_a14_pool_summary", MOMENTUM + POOLS + f" SELECT horizon, count(*) AS evaluation_dates, {', '.join(f'round(avg({c}), 5) AS {c}' for c in [*_POOL, 'overlap'])} FROM pv GROUP BY horizon")
def pool_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluation.pool_validation(momentum_panel(spark, sf_dir), "score", PARAMS)
    return rounded(evaluation.summary(table, ["horizon"]), ["horizon", "evaluation_dates"], [*_POOL, "overlap"], 5)


@query("v8_compare_variants", MOMENTUM + LEADERS + """,
v1 AS (SELECT horizon, avg(o / 3.0::DOUBLE) AS precision, avg(c)::DOUBLE AS leader_capture FROM ld GROUP BY horizon),
v2 AS (SELECT horizon, avg(o / 3.0::DOUBLE) AS precision, avg(c)::DOUBLE AS leader_capture FROM ld WHERE date >= DATE '1996-01-01' GROUP BY horizon),
u AS (SELECT horizon, unnest(['precision', 'leader_capture']) AS metric, unnest([v1.precision, v1.leader_capture]) AS a, unnest([v2.precision, v2.leader_capture]) AS b FROM v1 JOIN v2 USING (horizon))
SELECT horizon, metric, round(a, 6) AS a, round(b, 6) AS b, round(b - a, 6) AS delta FROM u""")  # fmt: skip
def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = momentum_panel(spark, sf_dir)
    dates = calendar.schedule(calendar.calendar(panel), PARAMS.rebalance)
    daily = evaluation.leader_dates(panel, "score", PARAMS, dates)
    mean = lambda df: df.groupBy("horizon").agg(F.avg("precision").alias("precision"), F.avg("leader_capture").alias("leader_capture"))
    return rounded(evaluation.compare(mean(daily), mean(daily.where("date >= '1996-01-01'")), ["horizon"]), ["horizon", "metric"], ["a", "b", "delta"])


@query("v9_p13_first_scored", MOMENTUM + " SELECT min(date) AS first_date FROM mp WHERE in_universe AND score IS NOT NULL")
def first_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.first_scored(momentum_panel(spark, sf_dir), "score")
