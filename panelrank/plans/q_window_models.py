"""Queries of models trained by window, over the labelled panel with all features of the models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.config import TEST
from panelrank.functions.tables import stored
from panelrank.operators import calendar, scores, windowmodels
from panelrank.operators.features import MODEL_FEATURES
from panelrank.plans import panel as P
from panelrank.plans.q_panel import WINDOWS_SQL

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: Features of the models whose solution SQL finds by iteration.
FEW = ("roc60", "price_vs_sma20", "vol60", "liquidity_stability", "breadth_above_sma60")


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


def _rows_sql(features: tuple[str, ...], standardised: bool) -> str:
    """Training rows by window with imputed features, centred and, if asked, scaled; `st` has the centres and scales."""
    each = lambda text, sep=", ": sep.join(text.format(f=f) for f in features)
    scale = "CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END AS s_{f}" if standardised else "1.0::DOUBLE AS s_{f}"
    return P.sql("labels", "").rstrip() + "," + WINDOWS_SQL + f""",
mm AS MATERIALIZED (SELECT date, symbol, blended_target AS y, {each('{f}::DOUBLE AS {f}')} FROM lab WHERE in_universe),
le AS (SELECT date, max(greatest(end_30, end_60, end_90)) AS label_end FROM lab WHERE in_universe GROUP BY date),
tr AS MATERIALIZED (SELECT window_id, mm.* FROM mm JOIN le USING (date) JOIN wins ON date BETWEEN train_start AND effective_train_end AND label_end < test_start WHERE y IS NOT NULL),
ok AS (SELECT window_id FROM tr GROUP BY window_id HAVING count(*) >= {TEST.min_train_rows}),
md AS (SELECT window_id, {each('coalesce(median({f}), 0) AS m_{f}')} FROM tr JOIN ok USING (window_id) GROUP BY window_id),
im AS MATERIALIZED (SELECT window_id, y, {each('coalesce({f}, m_{f}) AS {f}')} FROM tr JOIN md USING (window_id)),
st AS MATERIALIZED (SELECT window_id, count(*) AS n, avg(y) AS a_y, {each('avg({f}) AS a_{f}')}, {each(scale)} FROM im GROUP BY window_id),
z AS MATERIALIZED (SELECT window_id, n, y - a_y AS y, {each('({f} - a_{f}) / s_{f} AS {f}')} FROM im JOIN st USING (window_id))"""


def _scores_sql(features: tuple[str, ...], kind: str) -> str:
    """Scores of the test rows from `so` (window_id, x: a coefficient for each centred feature), averaged over windows."""
    terms = " + ".join(f"x[{i}] * (coalesce({f}, m_{f}) - a_{f}) / s_{f}" for i, f in enumerate(features, 1))
    return f"""
pr AS (SELECT date, symbol, window_id, a_y + {terms} AS score FROM mm JOIN wins ON date BETWEEN test_start AND test_end JOIN so USING (window_id) JOIN st USING (window_id) JOIN md USING (window_id))
SELECT date, symbol, round(avg(score), 5) AS {kind}, count(DISTINCT window_id) AS prediction_window_count FROM pr GROUP BY date, symbol"""


def ridge_sql(features: tuple[str, ...], kind: str, standardised: bool) -> str:
    """The normal equations, solved by elimination: a step of the recursion clears a column."""
    d = len(features)
    upper = ", ".join(f"sum({features[i]} * {features[j]}) AS g_{i}_{j}" for i in range(d) for j in range(i, d))
    right = ", ".join(f"sum({f} * y) AS r_{i}" for i, f in enumerate(features))
    cell = lambda i, j: f"g_{min(i, j)}_{max(i, j)}" + (f" + {windowmodels.RIDGE_ALPHA}" if i == j else "")
    matrix = ", ".join("[" + ", ".join([*(cell(i, j) for j in range(d)), f"r_{i}"]) + "]" for i in range(d))
    return _rows_sql(features, standardised).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
gm AS (SELECT window_id, {upper}, {right} FROM z GROUP BY window_id),
gj(window_id, k, m) AS (SELECT window_id, 1, [{matrix}] FROM gm UNION ALL
  SELECT window_id, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN p ELSE list_transform(range(1, {d + 2}), lambda j: r[j] - r[k] * p[j]) END)
  FROM (SELECT *, list_transform(m[k], lambda v: v / m[k][k]) AS p FROM gj WHERE k <= {d})),
so AS (SELECT window_id, list_transform(m, lambda r: r[{d + 1}]) AS x FROM gj WHERE k = {d + 1}),""" + _scores_sql(features, kind)


def net_sql(features: tuple[str, ...], kind: str, sweeps: int = 400) -> str:
    """Coordinate descent: a step of the recursion is a sweep over the coefficients."""
    d = len(features)
    a1, a2 = windowmodels.NET_ALPHA * windowmodels.NET_L1, windowmodels.NET_ALPHA * (1 - windowmodels.NET_L1)
    q = ", ".join(f"avg({features[i]} * {features[j]}) AS q_{i}_{j}" for i in range(d) for j in range(i, d))
    p = ", ".join(f"avg({f} * y) AS p_{i}" for i, f in enumerate(features))
    new, body = {i: f"x[{i + 1}]" for i in range(d)}, []
    for i in range(d):
        rest = " - ".join([f"p_{i}", *(f"q_{min(i, j)}_{max(i, j)} * {new[j]}" for j in range(d) if j != i)])
        body.append(f"{rest} AS t_{i}, sign(t_{i}) * greatest(abs(t_{i}) - {a1}::DOUBLE, 0) / (q_{i}_{i} + {a2}::DOUBLE) AS b_{i}")
        new[i] = f"b_{i}"
    return _rows_sql(features, True).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
gm AS MATERIALIZED (SELECT window_id, {q}, {p} FROM z GROUP BY window_id),
cd(window_id, k, x) AS (SELECT window_id, 0, [{', '.join(['0.0::DOUBLE'] * d)}] FROM gm UNION ALL
  SELECT window_id, k + 1, [{', '.join(f'b_{i}' for i in range(d))}] FROM (SELECT window_id, k, x, {', '.join(body)} FROM cd JOIN gm USING (window_id) WHERE k < {sweeps})),
so AS (SELECT window_id, x FROM cd WHERE k = {sweeps}),""" + _scores_sql(features, kind)


def _trained(spark: SparkSession, sf_dir: str, features: tuple[str, ...], kinds: tuple[str, ...]):
    """(the labelled panel, windows, models, status of the windows)."""
    panel = P.labelled_panel(spark, sf_dir, columns=(*P.CONTEXT_INPUTS, *features))
    panel = stored(panel.select("date", "symbol", "in_universe", "blended_target", *features), "labelled")
    windows = stored(calendar.walkforward_windows(calendar.calendar(panel), TEST), "windows")
    models, status = windowmodels.train(panel, windows, scores.label_ends(panel, TEST), list(features), "blended_target", TEST.min_train_rows, kinds)
    return panel, windows, models, status


def _out_of_sample(spark: SparkSession, sf_dir: str, features: tuple[str, ...], kind: str) -> DataFrame:
    panel, windows, models, _ = _trained(spark, sf_dir, features, (kind,))
    out = windowmodels.out_of_sample(windowmodels.predict(panel, windows, models, list(features)), {kind: kind})
    return out.select("date", "symbol", F.round(kind, 5).alias(kind), "prediction_window_count")


@query("m9_m2_a5_ridge_scores", ridge_sql(MODEL_FEATURES, "ridge", True))
def ridge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-sample ridge scores of all members, with all features."""
    return _out_of_sample(spark, sf_dir, MODEL_FEATURES, "ridge")


@query("m9_m3_elastic_net_scores", net_sql(FEW, "elasticnet"))
def elastic_net_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out_of_sample(spark, sf_dir, FEW, "elasticnet")


@query("m9_m4_plain_ridge_scores", ridge_sql(FEW, "plain_ridge", False))
def plain_ridge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out_of_sample(spark, sf_dir, FEW, "plain_ridge")


@query("m9_a12_a13_window_status", P.sql("labels", "").rstrip() + "," + WINDOWS_SQL + """,
mm AS MATERIALIZED (SELECT date, blended_target AS y FROM lab WHERE in_universe), le AS (SELECT date, max(greatest(end_30, end_60, end_90)) AS label_end FROM lab WHERE in_universe GROUP BY date),
a AS (SELECT window_id, count(*) FILTER (date <= train_end AND y IS NOT NULL) AS train_rows_pre_purge, count(DISTINCT CASE WHEN date <= train_end AND y IS NOT NULL THEN date END) AS train_dates_pre_purge,
  count(*) FILTER (date <= effective_train_end AND label_end < test_start AND y IS NOT NULL) AS train_rows, count(DISTINCT CASE WHEN date <= effective_train_end AND label_end < test_start AND y IS NOT NULL THEN date END) AS train_dates,
  count(*) FILTER (date >= test_start) AS test_rows FROM mm JOIN le USING (date) JOIN wins ON date BETWEEN train_start AND test_end GROUP BY window_id),
w AS (SELECT wins.window_id, test_start, coalesce(train_rows_pre_purge, 0) AS train_rows_pre_purge, coalesce(train_rows, 0) AS train_rows, coalesce(train_dates_pre_purge, 0) AS train_dates_pre_purge, coalesce(train_dates, 0) AS train_dates, coalesce(test_rows, 0) AS test_rows FROM wins LEFT JOIN a USING (window_id))
SELECT *, train_rows_pre_purge - train_rows AS purged_train_rows, CASE WHEN train_rows >= 300 THEN 'fit' WHEN window_id < (SELECT min(window_id) FROM w WHERE train_rows >= 300) THEN 'warm_up' ELSE 'insufficient_data' END AS status FROM w""")
def window_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = _trained(spark, sf_dir, FEW, ("plain_ridge",))[3]
    return status.select("window_id", "test_start", "train_rows_pre_purge", "train_rows", "train_dates_pre_purge", "train_dates", "test_rows", "purged_train_rows", "status")
