"""Streams (ST1 to ST3): daily bars in event time, the incremental upsert and liveness, restartable and equal to their batch forms.

State is kept by key until the watermark passes it; what a stream gives goes to a file sink or, by micro-batch, to a
published table whose versions are the batches, so a batch that runs again after a failure changes nothing. A stream that
runs until its input is used up (`available_now`) goes on from its checkpoint the next time. For state beyond the executors'
memory set `spark.sql.streaming.stateStore.providerClass` to the RocksDB provider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelrank.sources import published


def follow(spark: SparkSession, folder: str, schema: str, files: int | None = None, kind: str = "parquet") -> DataFrame:
    """The files of a folder as a stream; `files` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).format(kind).load(folder)


def available_now(writer, checkpoint: str) -> StreamingQuery:
    """Runs a stream over what its input holds now and returns when that is done."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# -- ST2: bars in event time


def event_bars(events: DataFrame, delay: str | None = "1 day", unit: str = "1 day") -> DataFrame:
    """ST2: symbol, date, open, high, low, close, volume, n_events of tumbling windows. events: symbol, ts, price, quantity, seq.

    `seq` orders events of one instant. As a stream in append mode a window comes out once, when the watermark, `delay` behind
    the latest event, passes its end; later events of it are dropped. Rows without symbol or ts are left out. With `delay` None
    no watermark is set, as for a table.
    """
    known = events.where("symbol is not null and ts is not null").withColumn("ts", F.col("ts").cast("timestamp"))
    timed = known if delay is None else known.withWatermark("ts", delay)
    at = F.struct("ts", "seq")
    bars = timed.groupBy("symbol", F.window("ts", unit).alias("w")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("quantity").alias("volume"), F.count("*").alias("n_events"),
    )
    return bars.select("symbol", F.to_date("w.start").alias("date"), "open", "high", "low", "close", "volume", "n_events")


def write_bars(bars: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends closed bars to a folder of Parquet files; its log makes every micro-batch count once."""
    return available_now(bars.writeStream.outputMode("append").format("parquet").option("path", folder), checkpoint)


def late_events(events: DataFrame, bars: DataFrame) -> DataFrame:
    """symbol, date, n_late: events of closed bars that came after their bar, found by their number."""
    known = events.where("symbol is not null and ts is not null").groupBy("symbol", F.to_date("ts").alias("date")).agg(F.count("*").alias("n"))
    closed = bars.select("symbol", "date", "n_events")
    return known.join(closed, ["symbol", "date"]).select("symbol", "date", (F.col("n") - F.col("n_events")).alias("n_late"))


# -- ST1: incremental upsert


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, order: str = "received_at", tie: Column | None = None) -> StreamingQuery:
    """ST1: keeps a published table of bars (S8) up to date: of each symbol and date the row with the largest `order`, nulls last.

    The table is partitioned by month; a micro-batch reads and writes the months that it touches. Batches are versions: one that
    runs again after a failure is skipped or repeated without effect. Of equal orders the largest row stays, so the result does
    not depend on how rows fall into batches.
    """

    def write(batch: DataFrame, number: int) -> None:
        keyed = batch.where("symbol is not null and date is not null").withColumn("month", F.date_format("date", "yyyy-MM"))
        newest = [F.desc_nulls_last(order), *(F.desc_nulls_last(c) for c in sorted(set(batch.columns) - {"symbol", "date", order}))]
        if keyed.head(1):
            published.upsert_into(keyed, path, f"{number:010d}", ["symbol", "date"], "month", newest)

    return available_now(rows.writeStream.foreachBatch(write), checkpoint)


# -- ST3: liveness


def expected_slots(entities: DataFrame, first: Column, last: Column, unit: str = "day") -> DataFrame:
    """entity, slot: the spine: every slot from the first to the last for each entity."""
    return entities.select("entity").distinct().select("entity", F.explode(F.sequence(first, last, F.expr(f"interval 1 {unit}"))).alias("slot"))


def outcome_stream(events: DataFrame, spine: DataFrame, path: str, checkpoint: str, unit: str = "day") -> StreamingQuery:
    """ST3: keeps the newest outcome of each expected slot in a published table (entity, slot, outcome, ts), by month of the slot.

    The stream is joined to the static spine, so outcomes of slots that nobody expects go no further; the newest of a micro-batch
    is merged with the newest published.
    """
    slotted = events.withColumn("slot", F.to_date(F.date_trunc(unit, "ts"))).join(spine, ["entity", "slot"])

    def write(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy("entity", "slot").agg(F.max(F.struct("ts", "outcome")).alias("x")).select("entity", "slot", "x.outcome", "x.ts").withColumn("month", F.date_format("slot", "yyyy-MM"))
        if newest.head(1):
            published.upsert_into(newest, path, f"{number:010d}", ["entity", "slot"], "month", [F.desc("ts"), F.desc_nulls_last("outcome")])

    return available_now(slotted.select("entity", "slot", "ts", "outcome").writeStream.foreachBatch(write), checkpoint)


def liveness_now(spark: SparkSession, spine: DataFrame, path: str) -> DataFrame:
    """entity, slot, outcome: every expected slot with its newest outcome so far, or `missing`; the batch form is `history.liveness`."""
    seen = published.current(spark, path)
    if seen is None:
        return spine.select("entity", "slot", F.lit("missing").alias("outcome"))
    return spine.join(seen.select("entity", "slot", "outcome"), ["entity", "slot"], "left").withColumn("outcome", F.coalesce("outcome", F.lit("missing")))
