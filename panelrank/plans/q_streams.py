"""Queries of streams: the driver's tables arrive in parts, out of order and with late rows; each part is one run of the stream.

What arrives when is fixed by the rows themselves, so the SQL knows it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank import fixtures
from panelrank.functions.tables import shared_dir
from panelrank.sources import published
from panelrank.streaming import streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def arrive(spark: SparkSession, rows: DataFrame, part: str, step, parts: int) -> str:
    """Lands `rows` by their column `part` (1 to `parts`), one folder of arrivals after the other, and calls `step(folder, schema)`
    after each: a restart of the stream from its checkpoint."""
    held, folder = _folder(spark, "held"), _folder(spark, "arrivals")
    rows.write.partitionBy(part).parquet(held)
    schema = ", ".join(f"{n} {t}" for n, t in rows.drop(part).dtypes)
    back = spark.read.schema(schema + f", {part} int").parquet(held)
    for i in range(1, parts + 1):
        back.where(F.col(part) == i).drop(part).write.mode("append").parquet(folder)
        step(folder, schema)
    return folder


#: Part of an event: its week of January, but every 11th comes a part later and every 89th with the last part.
_PART = "CASE WHEN event_id % 89 = 0 THEN 5 ELSE least(5, (day(ts) - 1) // 6 + 1 + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) END"


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.expr(_PART.replace("//", "div")).cast("int")
    return fixtures.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), F.col("event_id").alias("quantity"), F.col("event_id").alias("seq"), part.alias("part"))


# After part p the watermark is the latest ts so far less a day. A bar closes after the part whose watermark passes its end; it
# holds the events that came up to the part at which it closed; later ones are dropped, as is what comes behind the watermark of the parts before.
ST2_SQL = f"""
WITH e AS (SELECT event_type AS symbol, ts, value, event_id, {_PART} AS part, ts::DATE AS date FROM events),
m AS (SELECT p, (SELECT max(ts) FROM e WHERE part <= p) - INTERVAL 1 DAY AS mark FROM (SELECT unnest([1, 2, 3, 4, 5]) AS p)),
k AS (SELECT e.*, date + INTERVAL 1 DAY <= (SELECT mark FROM m WHERE p = part - 1) AS late FROM e),
g AS (SELECT *, date + INTERVAL 1 DAY <= (SELECT mark FROM m WHERE p = 5) AS closed FROM k)
SELECT symbol, date, round(arg_min(value, (ts, event_id)) FILTER (NOT coalesce(late, false)), 6) AS open, max(value) FILTER (NOT coalesce(late, false)) AS high,
  min(value) FILTER (NOT coalesce(late, false)) AS low, round(arg_max(value, (ts, event_id)) FILTER (NOT coalesce(late, false)), 6) AS close,
  (sum(event_id) FILTER (NOT coalesce(late, false)))::BIGINT AS volume, count(*) FILTER (NOT coalesce(late, false)) AS n_events, count(*) FILTER (coalesce(late, false)) AS n_late
FROM g WHERE closed GROUP BY symbol, date HAVING count(*) FILTER (NOT coalesce(late, false)) > 0"""


@query("st2_event_time_bars", ST2_SQL)
def event_time_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the stream after five arrivals, with what came too late for each."""
    rows, bars, checkpoint = _trades(spark, sf_dir), _folder(spark, "bars"), _folder(spark, "checkpoint")
    arrive(spark, rows, "part", lambda folder, schema: streams.write_bars(streams.event_bars(streams.follow(spark, folder, schema)), bars, checkpoint), 5)
    closed = spark.read.parquet(bars)
    out = closed.join(streams.late_events(rows, closed), ["symbol", "date"])
    return out.select("symbol", "date", F.round("open", 6).alias("open"), "high", "low", F.round("close", 6).alias("close"), "volume", "n_events", "n_late")


@query("st1_stream_upsert", "WITH " + fixtures.bars_sql() + """,
a AS (SELECT symbol, date, round(close, 6) AS close, 1 AS received_at FROM bars UNION ALL
  SELECT symbol, date, round(close, 6) + 1, 2 FROM bars WHERE day(date) % 7 = 0 UNION ALL SELECT symbol, date, round(close, 6) + 2, 2 FROM bars WHERE day(date) % 14 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY received_at DESC, close DESC) AS r FROM a)
SELECT symbol, date, close, received_at FROM r WHERE r = 1""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars arrive year by year; some come again with another close, before or after the first."""
    bars = fixtures.bars(spark, sf_dir).select("symbol", "date", F.round("close", 6).alias("close"))
    again = F.array(*(F.when(test, F.struct((F.col("close") + more).alias("close"), F.lit(at).alias("received_at"))) for test, more, at in ((F.lit(True), 0, 1), (F.dayofmonth("date") % 7 == 0, 1, 2), (F.dayofmonth("date") % 14 == 0, 2, 2))))
    rows = bars.select("symbol", "date", F.inline(F.filter(again, lambda x: x.isNotNull())))
    rows = rows.withColumn("part", (F.year("date") % 3 + F.col("received_at") + F.dayofmonth("date") % 2).cast("int"))  # 1 to 5
    path, checkpoint = _folder(spark, "upserted"), _folder(spark, "checkpoint")
    arrive(spark, rows, "part", lambda folder, schema: streams.upsert_stream(streams.follow(spark, folder, schema), path, checkpoint), 5)
    return published.current(spark, path).select("symbol", "date", "close", "received_at")


def _register_liveness() -> None:
    from panelrank.plans import q_models

    @query("st3_stream_liveness", q_models._SLOTS + " SELECT * FROM l")
    def stream_liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Liveness after three arrivals, the oldest events last."""
        events = fixtures.table(spark, sf_dir, "events").select(F.concat_ws("-", "event_type", F.hour("ts")).alias("entity"), "ts", F.when(F.col("value") > 50, "failed").otherwise("ok").alias("outcome"))
        rows = events.withColumn("part", (3 - F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))).cast("int"))
        span = events.agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")).first()
        spine = streams.expected_slots(events, F.lit(span["a"]), F.lit(span["b"]))
        path, checkpoint = _folder(spark, "outcomes"), _folder(spark, "checkpoint")
        arrive(spark, rows, "part", lambda folder, schema: streams.outcome_stream(streams.follow(spark, folder, schema), spine, path, checkpoint), 3)
        return streams.liveness_now(spark, spine, path)


_register_liveness()
