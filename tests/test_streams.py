"""Streams against their batch forms: shuffled micro-batches, late rows, repeated batches and restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelrank.operators import history, merge
from panelrank.sources import published
from panelrank.streaming import streams

EVENTS = "symbol string, ts timestamp, price double, quantity long, seq long"


def ticks(n, seed=1, days=6):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [(rng.choice("ab"), start + dt.timedelta(hours=rng.randint(0, days * 24 - 1)), float(rng.randint(1, 50)), 1, i) for i in range(n)]


def land(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(folder)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def bars_of(df):
    return sorted(map(tuple, df.collect()))


def test_bars_in_shuffled_batches_equal_the_table(spark, folder):
    """Within the delay no order of arrival changes a bar; each arrival is a restart from the checkpoint."""
    rows = ticks(120)
    random.Random(7).shuffle(rows)
    for i in range(0, 120, 40):
        land(spark, rows[i : i + 40], EVENTS, folder("in"))
        streams.write_bars(streams.event_bars(streams.follow(spark, folder("in"), EVENTS, 1), "10 days"), folder("out"), folder("cp"))
    land(spark, [("z", dt.datetime(2024, 2, 1), 1.0, 1, 999)], EVENTS, folder("in"))  # moves the watermark past all days
    streams.write_bars(streams.event_bars(streams.follow(spark, folder("in"), EVENTS, 1), "10 days"), folder("out"), folder("cp"))
    out = spark.read.parquet(folder("out"))
    assert bars_of(out) == bars_of(streams.event_bars(spark.createDataFrame(rows, EVENTS), None))
    assert streams.late_events(spark.createDataFrame(rows, EVENTS), out).agg(F.sum("n_late")).first()[0] == 0


def test_late_events_are_dropped_and_counted(spark, folder):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    parts = [[("a", day(1, 1), 5.0, 1, 1), ("a", day(1, 1), 6.0, 1, 2), ("a", day(4), 9.0, 1, 3)], [("a", day(1, 0), 1.0, 1, 4), ("a", day(3, 1), 7.0, 1, 5), ("a", day(9), 2.0, 1, 6)], [("a", day(20), 1.0, 1, 7), (None, day(1), 1.0, 1, 8), ("a", None, 1.0, 1, 9)]]
    for part in parts:
        land(spark, part, EVENTS, folder("in"))
        streams.write_bars(streams.event_bars(streams.follow(spark, folder("in"), EVENTS), "1 day"), folder("out"), folder("cp"))
    out = spark.read.parquet(folder("out"))
    date = lambda d: dt.date(2024, 1, d)
    assert bars_of(out) == [("a", date(1), 5.0, 6.0, 5.0, 6.0, 2, 2), ("a", date(3), 7.0, 7.0, 7.0, 7.0, 1, 1), ("a", date(4), 9.0, 9.0, 9.0, 9.0, 1, 1), ("a", date(9), 2.0, 2.0, 2.0, 2.0, 1, 1)]
    late = streams.late_events(spark.createDataFrame(sum(parts, []), EVENTS), out)
    assert {r["date"]: r["n_late"] for r in late.collect()} == {date(1): 1, date(3): 0, date(4): 0, date(9): 0}


BARS = "symbol string, date date, close double, received_at long"


def test_upsert_stream_equals_batch_upsert(spark, folder):
    rng = random.Random(3)
    days = [dt.date(2024, 1, 25) + dt.timedelta(days=i) for i in range(14)]
    rows = [(s, d, float(rng.randint(1, 9)), rng.randint(1, 4)) for s in "abc" for d in days for _ in range(rng.randint(1, 4))] + [(None, days[0], 1.0, 1), ("a", None, 1.0, 1), ("d", days[0], 2.0, None)]
    rng.shuffle(rows)
    step = len(rows) // 3 + 1
    for i in range(0, len(rows), step):
        land(spark, rows[i : i + step], BARS, folder("in"))
        streams.upsert_stream(streams.follow(spark, folder("in"), BARS, 1), folder("table"), folder("cp"))
    best = {}
    for s, d, c, r in rows:
        if s and d:
            best[s, d] = max(best.get((s, d), (float("-inf"), 0.0)), (float("-inf") if r is None else r, c))
    found = {(r["symbol"], r["date"]): r["close"] for r in published.current(spark, folder("table")).collect()}
    assert found == {k: v[1] for k, v in best.items()}


def test_upsert_of_a_repeated_batch_changes_nothing(spark, folder):
    land(spark, [("a", dt.date(2024, 1, 1), 1.0, 1), ("a", dt.date(2024, 2, 1), 2.0, 1)], BARS, folder("in"))
    run = lambda cp: streams.upsert_stream(streams.follow(spark, folder("in"), BARS), folder("table"), folder(cp))
    run("cp")
    before = published.state(spark, folder("table"))
    run("cp")  # nothing new
    run("cp-lost")  # a lost checkpoint runs batch 0 again
    assert published.state(spark, folder("table")) == before
    stored = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0, 1)], BARS)
    fetched = spark.createDataFrame([("a", dt.date(2024, 1, 1), 5.0, 2), ("b", dt.date(2024, 1, 1), 3.0, 1)], BARS)
    for version in ("x", "y"):  # the same rows as another version
        published.upsert_into(stored.unionByName(fetched).withColumn("month", F.date_format("date", "yyyy-MM")), folder("t2"), version, ["symbol", "date"], "month", [F.desc("received_at")])
    rows = lambda df: sorted(map(tuple, df.select("symbol", "date", "close", "received_at").collect()))
    assert rows(published.current(spark, folder("t2"))) == rows(merge.upsert(stored, fetched))


def test_a_batch_that_dies_leaves_the_table(spark, folder):
    """Staged rows are not read; the batch runs again as a whole after the restart."""
    land(spark, [("a", dt.date(2024, 1, 1), 1.0, 1)], BARS, folder("in"))
    streams.upsert_stream(streams.follow(spark, folder("in"), BARS), folder("table"), folder("cp"))
    land(spark, [("a", dt.date(2024, 1, 1), 9.0, 2)], BARS, folder("in"))
    keep, published.publish = published.publish, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(Exception, match="lost"):
            streams.upsert_stream(streams.follow(spark, folder("in"), BARS), folder("table"), folder("cp"))
    finally:
        published.publish = keep
    assert [r["close"] for r in published.current(spark, folder("table")).collect()] == [1.0]
    streams.upsert_stream(streams.follow(spark, folder("in"), BARS), folder("table"), folder("cp"))
    assert [r["close"] for r in published.current(spark, folder("table")).collect()] == [9.0]


def test_liveness_stream_equals_batch(spark, folder):
    rng = random.Random(5)
    rows = [(rng.choice("xyz"), dt.datetime(2024, 1, 28) + dt.timedelta(hours=rng.randint(0, 200)), rng.choice(["ok", "failed"])) for _ in range(40)]
    schema = "entity string, ts timestamp, outcome string"
    events = spark.createDataFrame(rows, schema)
    span = events.agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")).first()
    spine = streams.expected_slots(events, F.lit(span["a"]), F.lit(span["b"]))
    assert streams.liveness_now(spark, spine, folder("table")).where("outcome <> 'missing'").count() == 0
    for i in (2, 0, 1):
        land(spark, rows[i::3] + [("x", dt.datetime(2020, 1, 1), "ok")], schema, folder("in"))
        streams.outcome_stream(streams.follow(spark, folder("in"), schema), spine, folder("table"), folder("cp"))
    as_rows = lambda df: sorted(map(tuple, df.select("entity", "slot", "outcome").collect()))
    assert as_rows(streams.liveness_now(spark, spine, folder("table"))) == as_rows(history.liveness(events))
