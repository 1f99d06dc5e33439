"""Calendars and schedules (C1 to C5, J13). A calendar is the distinct dates: small, so its windows need no partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelrank.config import Params

def by_date() -> Window:
    return Window.orderBy("date")


def calendar(df: DataFrame) -> DataFrame:
    """date, pos (from 0)."""
    return df.select("date").distinct().where("date is not null").withColumn("pos", F.row_number().over(by_date()) - 1)


def schedule(days: DataFrame, frequency: str) -> DataFrame:
    """Date, next_date. The last day of each week (Monday to Sunday) or month, and always the first day."""
    if frequency == "daily":
        chosen = days.select("date")
    else:
        unit = {"weekly": "week", "monthly": "month"}.get(frequency)
        if unit is None:
            raise ValueError(f"unknown frequency: {frequency}")
        last = days.groupBy(F.date_trunc(unit, "date").alias("u")).agg(F.max("date").alias("date")).select("date")
        chosen = last.unionByName(days.agg(F.min("date").alias("date"))).where("date is not null").distinct()
    return chosen.withColumn("next_date", F.lead("date").over(by_date()))


def refresh_schedule(days: DataFrame, frequency: str = "monthly") -> DataFrame:
    """The schedule without its last but one date, if the last two are adjacent days of different months."""
    dates = schedule(days, frequency).select("date")
    if frequency != "monthly":
        return dates.withColumn("next_date", F.lead("date").over(by_date()))
    down = dates.withColumns({"r": F.row_number().over(Window.orderBy(F.desc("date"))), "after": F.lead("date").over(by_date())})
    twin = (F.col("r") == 2) & (F.datediff("after", "date") == 1) & (F.month("after") != F.month("date"))
    kept = down.where(~F.coalesce(twin, F.lit(False))).select("date")
    return kept.withColumn("next_date", F.lead("date").over(by_date()))


def after(days: DataFrame, lag: int) -> DataFrame:
    """Date, later: the trading date `lag` places on, null past the end."""
    return days.select("date", F.lead("date", lag).over(by_date()).alias("later"))


def continuity(df: DataFrame) -> DataFrame:
    """C4: one row: first and last date, number of dates, days missing between, and whether none is."""
    return df.agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.countDistinct("date").alias("n_dates")
    ).select("*", (F.datediff("last_date", "first_date") + 1 - F.col("n_dates")).cast("long").alias("missing")).withColumn("continuous", F.col("missing") == 0)


def walkforward_windows(days: DataFrame, params: Params, purge: int | None = None) -> DataFrame:
    """window_id, train_start, train_end, effective_train_end, test_start, test_end, purge_days.

    Test windows start every `step_days` once `train_days` dates have passed; the first that reaches the end is the last.
    """
    purge = max(params.horizons) if purge is None else purge
    if purge >= params.train_days:
        raise ValueError("the purge must leave a training date")
    n = days.agg((F.max("pos") + 1).alias("n")).where(F.col("n") > params.train_days)
    cursors = n.select("n", F.explode(F.sequence(F.lit(params.train_days), F.col("n") - 1, F.lit(params.step_days))).alias("cursor"))
    placed = cursors.select(
        ((F.col("cursor") - params.train_days) / params.step_days).cast("int").alias("window_id"),
        (F.col("cursor") - params.train_days).alias("p1"),
        (F.col("cursor") - 1).alias("p2"),
        (F.col("cursor") - 1 - purge).alias("p3"),
        F.col("cursor").alias("p4"),
        F.least(F.col("n") - 1, F.col("cursor") + params.test_days - 1).alias("p5"),
        (F.col("cursor") + params.test_days - params.step_days - 1 >= F.col("n") - 1).alias("over"),  # the one before reached the end
    ).where((F.col("window_id") == 0) | ~F.col("over"))
    out = placed
    for i, name in enumerate(("train_start", "train_end", "effective_train_end", "test_start", "test_end"), 1):
        out = out.join(days.select(F.col("pos").alias(f"p{i}"), F.col("date").alias(name)), f"p{i}")
    return out.select("window_id", "train_start", "train_end", "effective_train_end", "test_start", "test_end", F.lit(purge).alias("purge_days"))
