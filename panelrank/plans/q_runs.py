"""Queries of runs: several scores, spans of dates and test windows, each a portfolio of its own, in one plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.config import TEST
from panelrank.operators import calendar, evaluation, portfolio
from panelrank.plans.q_panel import WINDOWS_SQL
from panelrank.plans.q_returns import MOMENTUM, PARAMS, momentum_panel

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


#: The returns of all runs in `kp` (run, date, symbol, open, vol20, in_universe, score), then their performance, `kpf`.
RUNS = """,
kc AS MATERIALIZED (SELECT run, date, lead(date) OVER (PARTITION BY run ORDER BY date) AS nd FROM (SELECT DISTINCT run, date FROM kp)),
ksg AS MATERIALIZED (SELECT run, max(date) AS date FROM kc GROUP BY run, date_trunc('week', date) UNION SELECT run, min(date) FROM kc GROUP BY run),
kev AS MATERIALIZED (SELECT run, row_number() OVER (PARTITION BY run ORDER BY nd) - 1 AS k, date AS signal_date, nd AS effective_date, lag(nd) OVER (PARTITION BY run ORDER BY nd) AS prev_date FROM ksg JOIN kc USING (run, date) WHERE nd IS NOT NULL),
ksel AS (SELECT run, date, symbol, 1 / greatest(vol20, 0.05::DOUBLE) AS x, row_number() OVER (PARTITION BY run, date ORDER BY score DESC, symbol) AS r FROM kp WHERE in_universe AND score IS NOT NULL AND vol20 IS NOT NULL),
kwt AS MATERIALIZED (SELECT run, date, symbol, x / sum(x) OVER (PARTITION BY run, date) AS weight FROM ksel WHERE r <= 3),
ktg AS MATERIALIZED (SELECT kev.run, k, effective_date, symbol, weight FROM kev JOIN kwt ON kev.run = kwt.run AND kev.signal_date = kwt.date),
kcr AS (SELECT kev.run, kev.k, p.symbol, p.weight AS wp, p.weight * p1.open / p0.open AS gr FROM ktg p JOIN kev ON kev.run = p.run AND kev.prev_date = p.effective_date
  JOIN mp p0 ON p0.date = p.effective_date AND p0.symbol = p.symbol JOIN mp p1 ON p1.date = kev.effective_date AND p1.symbol = p.symbol),
kcb AS (SELECT run, k, symbol, gr / (1 - sum(wp) OVER (PARTITION BY run, k) + sum(gr) OVER (PARTITION BY run, k)) AS b FROM kcr),
kbo AS MATERIALIZED (SELECT run, k, symbol, coalesce(b, 0) AS b, coalesce(weight, 0) AS w FROM kcb FULL JOIN (SELECT run, k, symbol, weight FROM ktg) USING (run, k, symbol)),
kbr AS (SELECT DISTINCT run, k, CASE WHEN w > 0 THEN b / w ELSE 0 END AS t FROM kbo UNION SELECT run, k, 0 FROM kbo UNION SELECT run, k, 1 FROM kbo),
kvl AS (SELECT run, k, t, t + 0.0015::DOUBLE * sum(abs(w * t - b)) AS f FROM kbr JOIN kbo USING (run, k) WHERE t <= 1 GROUP BY run, k, t),
klo AS (SELECT run, k, max(t) AS t FROM kvl WHERE f <= 1 GROUP BY run, k),
kgs AS (SELECT run, k, klo.t, sum(CASE WHEN w > 0 AND b / w <= klo.t THEN w WHEN w > 0 THEN -w ELSE 0 END) AS slope, sum(CASE WHEN w > 0 AND b / w <= klo.t THEN -b ELSE b END) AS base FROM klo JOIN kbo USING (run, k) GROUP BY run, k, klo.t),
kfg AS (SELECT run, k, (1 - 0.0015::DOUBLE * base) / (1 + 0.0015::DOUBLE * slope) AS g FROM kgs),
kto AS (SELECT run, k, sum(abs(w * g - b)) / 2 AS turnover FROM kbo JOIN kfg USING (run, k) GROUP BY run, k),
kpl AS MATERIALIZED (SELECT kev.*, coalesce(g, 1) AS g, coalesce(turnover, 0) AS turnover FROM kev LEFT JOIN kfg USING (run, k) LEFT JOIN kto USING (run, k)),
kse AS MATERIALIZED (SELECT kc.run, kc.date, kc.nd, max(effective_date) OVER (PARTITION BY kc.run ORDER BY kc.date) AS sd FROM kc LEFT JOIN kev ON kev.run = kc.run AND kev.effective_date = kc.date),
kmv AS (SELECT kse.run, kse.date, weight, weight * q.open / p.open AS m0, CASE WHEN n.open IS NOT NULL THEN weight * n.open / p.open END AS m1 FROM kse JOIN ktg ON ktg.run = kse.run AND ktg.effective_date = sd
  JOIN mp p ON p.date = sd AND p.symbol = ktg.symbol JOIN mp q ON q.date = kse.date AND q.symbol = ktg.symbol LEFT JOIN mp n ON n.date = kse.nd AND n.symbol = ktg.symbol),
kva AS (SELECT run, date, 1 - sum(weight) + sum(m0) AS v0, 1 - sum(weight) + sum(m1) AS v1 FROM kmv GROUP BY run, date),
krt AS MATERIALIZED (SELECT kse.run, kse.date, CASE WHEN sd IS NULL THEN 0 ELSE (CASE WHEN kse.nd IS NULL THEN 1 ELSE coalesce(v1, 1) / coalesce(v0, 1) END) * coalesce(g, 1) - 1 END AS r, coalesce(turnover, 0) AS turnover
  FROM kse LEFT JOIN kva USING (run, date) LEFT JOIN kpl ON kpl.run = kse.run AND kpl.effective_date = kse.date),
kre AS (SELECT *, exp(sum(ln(1 + r)) OVER (PARTITION BY run ORDER BY date)) AS e FROM krt),
kma AS (SELECT *, e / greatest(max(e) OVER (PARTITION BY run ORDER BY date), 1) - 1 AS dd FROM kre),
kp0 AS (SELECT run, min(date) AS start_date, max(date) AS end_date, count(*) AS observations, exp(sum(ln(1 + r))) ** (365.0::DOUBLE / count(*)) - 1 AS cagr, stddev_pop(r) * sqrt(365.0::DOUBLE) AS volatility, avg(r) * 365 AS mean,
  sqrt(avg(CASE WHEN r < 0 THEN r * r ELSE 0 END)) * sqrt(365.0::DOUBLE) AS down, min(dd) AS max_drawdown, avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END) AS win_rate, avg(turnover) * 365 AS turnover FROM kma GROUP BY run),
kpf AS (SELECT *, CASE WHEN volatility > 0 THEN mean / volatility END AS sharpe, CASE WHEN down > 0 THEN mean / down END AS sortino, CASE WHEN max_drawdown < 0 THEN cagr / abs(max_drawdown) END AS calmar FROM kp0)"""

_DIGITS = {"cagr": 4, "volatility": 5, "sharpe": 4, "sortino": 4, "max_drawdown": 5, "calmar": 4, "win_rate": 6, "turnover": 4}
#: Four scores of the momentum panel, as SQL that both engines read.
SCORES = {"rule_score": "score", "linear_score": "round(-vol20, 9)", "ml_score": "CASE WHEN day(date) % 5 <> 0 THEN round(score / nullif(vol20, 0), 9) END", "final_score": "round(score - vol20, 9)"}


@query("b13_score_suite", MOMENTUM + ",\nkp AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT '{n}' AS run, * REPLACE ({e} AS score) FROM mp" for n, e in SCORES.items()) + ")" + RUNS
       + f" SELECT run AS strategy, observations, {', '.join(f'round({c}, {d}) AS {c}' for c, d in _DIGITS.items())} FROM kpf")
def score_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four scores and a name that the panel lacks, through one set of written tables."""
    panel = momentum_panel(spark, sf_dir)
    panel = panel.select("date", "symbol", "open", "vol20", "in_universe", *(F.expr(e).alias(n) for n, e in SCORES.items()))
    daily = portfolio.suite(panel, [*SCORES, "no_score"], PARAMS)
    return evaluation.performance(daily, ["strategy"]).select("strategy", "observations", *(F.round(c, d).alias(c) for c, d in _DIGITS.items()))


#: Spans that overlap, one without a first day, one without a last, one that ends before the data begin.
SPANS = {"all": (None, None), "to_1997": (None, dt.date(1997, 12, 31)), "mid": (dt.date(1997, 6, 1), dt.date(1999, 5, 31)), "late": (dt.date(1998, 1, 10), None), "before": (dt.date(1980, 1, 1), dt.date(1981, 1, 1))}


def _span_sql(start, end) -> str:
    return " AND ".join(["true", *([f"date >= DATE '{start}'"] if start else []), *([f"date <= DATE '{end}'"] if end else [])])


@query("v11_v12_slice_runs", MOMENTUM + ",\nkp AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT '{n}' AS run, * FROM mp WHERE {_span_sql(*s)}" for n, s in SPANS.items()) + ")" + RUNS
       + """ SELECT run, start_date, end_date, observations, round(coalesce(sharpe, 0), 4) AS sharpe, round(CASE WHEN max_drawdown <> 0 THEN cagr / abs(max_drawdown) END, 4) AS calmar, round(coalesce(max_drawdown, 0), 5) AS max_drawdown,
  round(coalesce(cagr, 0), 4) AS cagr, round(coalesce(volatility, 0), 5) AS volatility, round(win_rate, 6) AS win_rate FROM kpf""")
def slice_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = portfolio.runs_of(spark, [(n, "score", *span) for n, span in SPANS.items()])
    out = evaluation.slice_runs(momentum_panel(spark, sf_dir), runs, ["score"], PARAMS)
    return out.select("run", "start_date", "end_date", "observations", *(F.round(c, _DIGITS[c]).alias(c) for c in ("sharpe", "calmar", "max_drawdown", "cagr", "volatility", "win_rate")))


_H = "".join(f", count(*) FILTER (horizon = {h}) AS h{h}_dates, " + ", ".join(f"round(avg({e}) FILTER (horizon = {h}), 5) AS h{h}_{n}" for n, e in (("precision", "o / 3.0::DOUBLE"), ("recall", "o / 3.0::DOUBLE"), ("capture", "c::DOUBLE"))) for h in PARAMS.horizons)


@query("v6_window_validation", MOMENTUM + "," + WINDOWS_SQL.replace("FROM bars", "FROM mp") + """,
kp AS MATERIALIZED (SELECT window_id AS run, mp.* FROM mp JOIN wins ON date BETWEEN test_start AND test_end)""" + RUNS + """,
lg AS (SELECT run, date, symbol, score, unnest([30, 60, 90]) AS horizon, unnest([future_return_30, future_return_60, future_return_90]) AS future FROM kp JOIN ksg USING (run, date) WHERE in_universe AND score IS NOT NULL),
lr AS (SELECT *, row_number() OVER (PARTITION BY run, date, horizon ORDER BY score DESC, symbol) AS r, row_number() OVER (PARTITION BY run, date, horizon ORDER BY future DESC, symbol) AS f, count(*) OVER (PARTITION BY run, date, horizon) AS n FROM lg WHERE future IS NOT NULL),
ld AS (SELECT run, date, horizon, count(*) FILTER (r <= 3 AND f <= 3) AS o, max(CASE WHEN r <= 3 AND f = 1 THEN 1.0 ELSE 0.0 END) AS c FROM lr WHERE n >= 3 GROUP BY run, date, horizon),
lh AS (SELECT run""" + _H + """ FROM ld GROUP BY run)
SELECT run AS window_id, lh.* EXCLUDE (run), round(cagr, 4) AS window_cagr, round(sharpe, 4) AS window_sharpe, round(max_drawdown, 5) AS window_max_drawdown, round(turnover, 4) AS window_turnover FROM kpf LEFT JOIN lh USING (run)""")
def window_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = momentum_panel(spark, sf_dir)
    windows = calendar.walkforward_windows(calendar.calendar(panel), TEST)
    out = evaluation.window_validation(panel, "score", PARAMS, windows)
    digits = {c: 4 if c in ("window_cagr", "window_sharpe", "window_turnover") else 5 for c in out.columns if c != "window_id" and not c.endswith("_dates")}
    return out.select(*(F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in out.columns))
