"""Release history and its tracks (H1 to H3), liveness (H9, H10) and training spans (Q16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelrank.operators.calendar import after, calendar, schedule


#: What may be said of a symbol in a pool.
META_FIELDS = ("regime", "confidence")


def release_index(ranked: DataFrame, pool_size: int, mode: str, lag: int = 1, frequency: str = "monthly", by: tuple[str, ...] = (), source_project: str = "", meta_fields: tuple[str, ...] = META_FIELDS) -> DataFrame:
    """H1: one row per schedule date (and `by`, such as a track) with a full pool.

    by, as_of_date, version, activation_date (`lag` dates on, the date itself at the end), mode, source_project, pool_size,
    expected_pool_size, symbols in rank order, regime and regime_confidence (of any row of the date that has them), stability and churn against
    the release before of the same `by`, has_selection_meta (whether a pool row has one of `meta_fields`). `ranked` has by, date, symbol and
    current_rank (null where not ranked); fields that it lacks are null.
    """
    days = calendar(ranked)
    keys = [*by, "date"]
    known = [f for f in meta_fields if f in ranked.columns]
    at = ranked.join(schedule(days, frequency).select("date"), "date")
    mine = F.col("current_rank") <= pool_size
    told = lambda c: F.max(c) if c in ranked.columns else F.lit(None)
    meta = F.max(F.when(mine, F.greatest(*(F.col(f).isNotNull() for f in known)) if len(known) > 1 else F.col(known[0]).isNotNull())) if known else F.lit(False)
    pools = at.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(mine, F.struct("current_rank", "symbol")))).alias("x"), told("regime").cast("string").alias("regime"),
        told("regime_confidence").cast("double").alias("regime_confidence"), meta.alias("has_selection_meta"),
    ).where(F.size("x") == pool_size).withColumn("pool", F.col("x.symbol"))
    before = F.lag("pool").over(Window.partitionBy(*by).orderBy("date"))
    dated = pools.join(after(days, lag), "date", "left").withColumn("stability", F.when(before.isNotNull(), F.size(F.array_intersect("pool", before)) / F.size("pool")))
    return dated.select(
        *by, F.col("date").alias("as_of_date"), F.concat_ws("-", F.col("date").cast("string"), F.lit(mode)).alias("version"), F.coalesce("later", "date").alias("activation_date"), F.lit(mode).alias("mode"),
        F.lit(source_project).alias("source_project"), F.size("pool").alias("pool_size"), F.lit(pool_size).alias("expected_pool_size"), F.concat_ws("|", "pool").alias("symbols"), "regime", "regime_confidence",
        "stability", (1 - F.col("stability")).alias("churn"), "has_selection_meta",
    )


def history_summary(index: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """H2: by, release_count, first_as_of_date, last_as_of_date, mean_pool_size, mean_pool_stability, mean_pool_churn, selection_meta_coverage.

    Without `by` an empty history has one row with the count 0.
    """
    return index.groupBy(*by).agg(
        F.count("*").alias("release_count"), F.min("as_of_date").alias("first_as_of_date"), F.max("as_of_date").alias("last_as_of_date"), F.avg("pool_size").alias("mean_pool_size"),
        F.avg("stability").alias("mean_pool_stability"), F.avg("churn").alias("mean_pool_churn"), F.avg(F.col("has_selection_meta").cast("double")).alias("selection_meta_coverage"),
    )


def candidate_tracks(index: DataFrame, tracks: DataFrame) -> DataFrame:
    """H3: the rows of `tracks` (track_id and what else describes one) with release_count, first_as_of_date, last_as_of_date; 0 and
    nulls for a track without releases. `index`: the releases of all tracks, by track_id."""
    told = history_summary(index, ("track_id",)).select("track_id", "release_count", "first_as_of_date", "last_as_of_date")
    return tracks.join(told, "track_id", "left").withColumn("release_count", F.coalesce("release_count", F.lit(0)))


def liveness(events: DataFrame, unit: str = "day") -> DataFrame:
    """H9: entity, slot, outcome: the newest outcome of each expected slot, or 'missing'. events: entity, ts, outcome."""
    slotted = events.withColumn("slot", F.to_date(F.date_trunc(unit, "ts")))
    span = slotted.agg(F.min("slot").alias("a"), F.max("slot").alias("b"))
    step = F.expr(f"interval 1 {unit}")
    spine = slotted.select("entity").distinct().join(span).select("entity", F.explode(F.sequence("a", "b", step)).alias("slot"))
    newest = slotted.groupBy("entity", "slot").agg(F.max_by("outcome", F.struct("ts", "outcome")).alias("outcome"))
    return spine.join(newest, ["entity", "slot"], "left").withColumn("outcome", F.coalesce("outcome", F.lit("missing")))


def trailing_streaks(slots: DataFrame, healthy: str, threshold: int) -> DataFrame:
    """Per entity the slots since the last healthy one, when that began, and whether it reaches the threshold."""
    last = F.max(F.when(F.col("outcome") == healthy, F.col("slot"))).over(Window.partitionBy("entity"))
    open_ = slots.withColumn("last", last).withColumn("bad", F.col("last").isNull() | (F.col("slot") > F.col("last")))
    agg = open_.groupBy("entity").agg(F.count_if("bad").alias("streak"), F.min(F.when(F.col("bad"), F.col("slot"))).alias("outage_start"))
    return agg.withColumn("alarm", F.col("streak") >= threshold)


def training_window(rows: DataFrame, by: list[str]) -> DataFrame:
    """Q16: first and last date and rows of each group."""
    return rows.groupBy(*by).agg(F.min("date").alias("start"), F.max("date").alias("end"), F.count("*").alias("n_rows"))
