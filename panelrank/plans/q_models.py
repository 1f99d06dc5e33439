"""Queries of walk-forward roles, linear models, release history and liveness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.config import TEST
from panelrank.functions.tables import stored
from panelrank.functions.windows import by_symbol
from panelrank.operators import calendar, features, history, models, walkforward
from panelrank.plans.q_panel import WINDOWS_SQL

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
FEATURES = ["roc20", "roc60", "price_sma"]


def add(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return register


def features_and_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with three features, the 30-row future return and the date it is of."""
    bars = features.averages(fixtures.bars(spark, sf_dir))
    w = by_symbol()
    made = bars.withColumns({"price_sma": F.round(F.col("close") / F.col("sma20") - 1, 6), "target": F.round(F.lead("close", 30).over(w) / F.col("close") - 1, 6), "label_end": F.lead("date", 30).over(w), "roc20": F.round("roc20", 6), "roc60": F.round("roc60", 6)})
    return made.select("date", "symbol", *FEATURES, "target", "label_end")


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the roles of each window."""
    made = features_and_target(spark, sf_dir)
    return walkforward.roles(made, calendar.walkforward_windows(calendar.calendar(made), TEST))


ROWS = "WITH " + fixtures.bars_sql() + "," + WINDOWS_SQL + """,
fr AS (SELECT date, symbol, round(close / lag(close, 20) OVER w - 1, 6) AS roc20, round(close / lag(close, 60) OVER w - 1, 6) AS roc60,
  round(close / CASE WHEN count(close) OVER v >= 20 THEN avg(close) OVER v END - 1, 6) AS price_sma, round(lead(close, 30) OVER w / close - 1, 6) AS target, lead(date, 30) OVER w AS label_end
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date), v AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
rl AS MATERIALIZED (SELECT fr.*, window_id, test_start, CASE WHEN date <= effective_train_end THEN 'train' WHEN date <= train_end THEN 'purged' ELSE 'test' END AS role
  FROM fr JOIN wins ON date BETWEEN train_start AND test_end)"""  # fmt: skip


@add("j15_l6_a12_a13_window_summary", ROWS + """, lb AS (SELECT *, CASE WHEN role = 'train' AND (label_end IS NULL OR label_end >= test_start) THEN 'purged' ELSE role END AS r2 FROM rl),
a AS (SELECT window_id, count(*) FILTER (r2 <> 'test') AS rows_before_purge, count(*) FILTER (r2 = 'train') AS train_rows, count(DISTINCT CASE WHEN r2 = 'train' THEN date END) AS train_dates, count(*) FILTER (r2 = 'test') AS test_rows FROM lb GROUP BY window_id)
SELECT *, CASE WHEN train_rows >= 8000 THEN 'fit' ELSE 'insufficient_data' END AS status, coalesce(window_id < (SELECT min(window_id) FROM a WHERE train_rows >= 8000), false) AS warm_up FROM a""")  # fmt: skip
def window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walkforward.window_summary(walkforward.purged_by_label(rows(spark, sf_dir)), 8_000)


@add("m1_medians", ROWS + " SELECT window_id, " + ", ".join(f"round(coalesce(median({c}), 0), 8) AS median_{c}" for c in FEATURES) + " FROM rl WHERE role = 'train' GROUP BY window_id")
def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walkforward.medians(rows(spark, sf_dir), FEATURES).select("window_id", *(F.round(f"median_{c}", 8).alias(f"median_{c}") for c in FEATURES))


@add("m4_gram_sums", ROWS + """, me AS (SELECT window_id, median(roc20) AS m1, median(roc60) AS m2, median(price_sma) AS m3 FROM rl WHERE role = 'train' GROUP BY window_id),
v AS (SELECT window_id, [1.0::DOUBLE, coalesce(roc20, m1, 0), coalesce(roc60, m2, 0), coalesce(price_sma, m3, 0), target] AS v FROM rl JOIN me USING (window_id) WHERE role = 'train' AND target IS NOT NULL),
p AS (SELECT window_id, unnest([0,0,0,0,0,1,1,1,1,2,2,2,3,3,4]) AS i, unnest([0,1,2,3,4,1,2,3,4,2,3,4,3,4,4]) AS j, v FROM v)
SELECT window_id, i, j, round(sum(v[i + 1] * v[j + 1]), 7) AS s FROM p GROUP BY window_id, i, j""")  # fmt: skip
def gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = walkforward.imputed(rows(spark, sf_dir), FEATURES)
    return walkforward.gram_sums(made, FEATURES, "target").withColumn("s", F.round("s", 7))


@add("m4_m9_a5_ridge_walkforward")
def ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-sample linear scores: the mean over the windows that test a date."""
    made = walkforward.imputed(walkforward.purged_by_label(rows(spark, sf_dir)), FEATURES)
    tested = walkforward.predict(made, walkforward.ridge(made, FEATURES, "target"), FEATURES, "linear_score_raw")
    return walkforward.aggregate_predictions(tested, ["linear_score_raw"])


@add("a5_a6_aggregated_predictions", ROWS + """ SELECT date, symbol, round(avg(roc20), 6) AS mean_score, round(arg_max(roc20 + window_id, window_id), 6) AS latest_score, max(window_id) AS prediction_source_window_id, count(DISTINCT window_id) AS prediction_window_count FROM rl WHERE role = 'test' GROUP BY date, symbol""")
def aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = rows(spark, sf_dir).where("role = 'test'").select("date", "symbol", "window_id", F.col("roc20").alias("mean_score"), (F.col("roc20") + F.col("window_id")).alias("latest_score"))
    mean = walkforward.aggregate_predictions(tested, ["mean_score"]).drop("prediction_window_count")
    out = mean.join(walkforward.aggregate_predictions(tested, ["latest_score"], "latest"), ["date", "symbol"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean_score", "latest_score")})


@add("h1_release_index", "WITH " + fixtures.bars_sql() + """, d AS (SELECT date, lead(date) OVER (ORDER BY date) AS nd FROM (SELECT DISTINCT date FROM bars)),
m AS (SELECT max(date) AS date FROM d GROUP BY date_trunc('month', date) UNION SELECT min(date) FROM d),
r AS (SELECT date, symbol, row_number() OVER (PARTITION BY date ORDER BY quote_volume DESC, symbol) AS r FROM bars),
p AS (SELECT date, list(symbol ORDER BY r) AS pool FROM r JOIN m USING (date) WHERE r <= 5 GROUP BY date HAVING count(*) = 5),
s AS (SELECT p.*, CASE WHEN lag(pool) OVER (ORDER BY date) IS NOT NULL THEN len(list_intersect(pool, lag(pool) OVER (ORDER BY date))) / 5.0::DOUBLE END AS stability FROM p)
SELECT date AS as_of_date, date::VARCHAR || '-core' AS version, coalesce(nd, date) AS activation_date, array_to_string(pool, '|') AS symbols, round(stability, 6) AS stability, round(1 - stability, 6) AS churn FROM s JOIN d USING (date)""")  # fmt: skip
def release_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    ranked = fixtures.bars(spark, sf_dir).withColumn("current_rank", F.row_number().over(Window.partitionBy("date").orderBy(F.desc("quote_volume"), "symbol")))
    index = history.release_index(ranked, 5, "core")
    return index.select("as_of_date", "version", "activation_date", "symbols", *(F.round(c, 6).alias(c) for c in ("stability", "churn")))


_EVENTS = "e AS (SELECT event_type || '-' || hour(ts) AS entity, ts, CASE WHEN value > 50 THEN 'failed' ELSE 'ok' END AS outcome FROM events)"
_SLOTS = "WITH " + _EVENTS + """, s AS (SELECT *, ts::DATE AS slot FROM e), sp AS (SELECT entity, unnest(generate_series((SELECT min(slot) FROM s)::TIMESTAMP, (SELECT max(slot) FROM s)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS slot FROM (SELECT DISTINCT entity FROM s)),
n AS (SELECT entity, slot, outcome FROM (SELECT *, row_number() OVER (PARTITION BY entity, slot ORDER BY ts DESC, outcome DESC) AS r FROM s) WHERE r = 1),
l AS (SELECT sp.entity, sp.slot, coalesce(outcome, 'missing') AS outcome FROM sp LEFT JOIN n ON n.entity = sp.entity AND n.slot = sp.slot)"""


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity is an event type at an hour of the day: on some days it has no event."""
    events = fixtures.table(spark, sf_dir, "events")
    return history.liveness(events.select(F.concat_ws("-", "event_type", F.hour("ts")).alias("entity"), "ts", F.when(F.col("value") > 50, "failed").otherwise("ok").alias("outcome")))


@add("h9_liveness", _SLOTS + " SELECT * FROM l")
def liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slots(spark, sf_dir)


@add("h10_trailing_streaks", _SLOTS + """, b AS (SELECT *, max(CASE WHEN outcome = 'failed' THEN slot END) OVER (PARTITION BY entity) AS last FROM l)
SELECT entity, count(*) FILTER (last IS NULL OR slot > last) AS streak, min(CASE WHEN last IS NULL OR slot > last THEN slot END) AS outage_start, count(*) FILTER (last IS NULL OR slot > last) >= 2 AS alarm FROM b GROUP BY entity""")  # fmt: skip
def streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.trailing_streaks(_slots(spark, sf_dir), "failed", 2)


_LIVE = ROWS.split(",\nrl AS")[0] + """,
lv AS (SELECT *, roc60 IS NOT NULL AS in_universe FROM fr), ao AS (SELECT max(date) AS d FROM lv WHERE in_universe),
lp AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS p FROM (SELECT DISTINCT date FROM lv WHERE date <= (SELECT d FROM ao))),
lt AS (SELECT lv.* FROM lv JOIN lp USING (date) WHERE in_universe AND p <= (SELECT max(p) FROM lp) - 30 AND p > (SELECT max(p) FROM lp) - 30 - 720)"""


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_and_target(spark, sf_dir).withColumn("in_universe", F.col("roc60").isNotNull())


@add("m10_m11_live_window", _LIVE + " SELECT 'train' AS part, date, symbol, roc20, target FROM lt UNION ALL SELECT 'score', date, symbol, roc20, target FROM lv WHERE in_universe AND date = (SELECT d FROM ao)")
def live_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a live run trains on and scores."""
    made = stored(_live(spark, sf_dir), "live")
    train, score = models.live_window(made, models.scoring_date(made), TEST.train_days, 30)
    part = lambda df, name: df.select(F.lit(name).alias("part"), "date", "symbol", "roc20", "target")
    return part(train, "train").unionByName(part(score, "score"))


@add("j5_merged_predictions", _LIVE + """, pd AS (SELECT date, symbol, roc20 AS linear_score_raw, CASE WHEN day(date) % 2 = 0 THEN roc60 END AS ml_score_raw, day(date) % 4 AS n FROM lv WHERE in_universe AND day(date) % 3 = 0)
SELECT date, symbol, linear_score_raw, ml_score_raw, coalesce(n, 0) AS prediction_window_count FROM lv LEFT JOIN pd USING (date, symbol)""")
def merged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with predictions for every third day: nulls and no window where there are none."""
    made = _live(spark, sf_dir)
    day = F.dayofmonth("date")
    predicted = made.where(F.col("in_universe") & (day % 3 == 0)).select("date", "symbol", F.col("roc20").alias("linear_score_raw"), F.when(day % 2 == 0, F.col("roc60")).alias("ml_score_raw"), (day % 4).cast("long").alias("prediction_window_count"))
    return models.merge_predictions(made.select("date", "symbol"), predicted)


@add("m2_m7_m10_m11_j5_live_fit")
def live_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge and a forest fitted on the window that a live run would take, and the scores of the last date."""
    made = stored(_live(spark, sf_dir), "live")
    as_of = models.scoring_date(made)
    train, score = models.live_window(made, as_of, TEST.train_days, 30)
    scored = models.fit_predict(train, score, FEATURES, "target", tree_kind="forest", numTrees=20)
    joined = models.merge_predictions(score, scored.withColumn("prediction_window_count", F.lit(1).cast("long")))
    return joined.select("date", "symbol", "linear_score_raw", "ml_score_raw", "prediction_window_count")
