"""Portfolio selection and returns (B1 to B13, V11, V12) without a day-by-day simulation.

Everything is keyed by `run`: a score column and, if given, a span of dates; all runs share each scan, join and written table. A
run of a span is a portfolio of its own: its calendar, signals and equity begin with the span. Names are chosen once per score
and signal date, whatever the number of runs that hold them.

Weights just before a rebalance follow from the last target weights and two price vectors, and the share of equity
left after costs does not depend on the scale. So returns are joins and sums: between two events equity moves with the
drifted weights of the last one. Events without holdings are all cash and keep their place in the event table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelrank.config import Params
from panelrank.functions.nulls import true
from panelrank.functions.tables import stored
from panelrank.operators.calendar import calendar

#: Halvings of the interval that holds the share of equity after costs.
STEPS = 64


def runs_of(spark: SparkSession, runs: list[tuple[str, str, dt.date | None, dt.date | None]]) -> DataFrame:
    """run, score, start, end: names of runs, their score columns and spans (None: without bound)."""
    return spark.createDataFrame(runs, "run string, score string, start date, end date")


def select_weights(panel: DataFrame, score: str, params: Params, by: tuple[str, ...] = ()) -> DataFrame:
    """By, date, symbol, weight: the top names of each date (and `by`); zeros are left out."""
    inverse = params.weighting == "inverse_vol"
    able = F.col("in_universe") & F.col(score).isNotNull()
    if inverse:
        able = able & F.col("vol20").isNotNull() & ~F.isnan("vol20") & (F.abs("vol20") < float("inf"))
    w = Window.partitionBy(*by, "date")
    top = panel.where(able).withColumn("_r", F.row_number().over(w.orderBy(F.desc(score), "symbol"))).where(F.col("_r") <= params.top_n)
    x = 1 / F.greatest(F.col("vol20"), F.lit(0.05)) if inverse else F.lit(1.0)
    return top.select(*by, "date", "symbol", x.alias("x")).withColumn("weight", F.col("x") / F.sum("x").over(w)).drop("x")


def _long(panel: DataFrame, scores: list[str]) -> DataFrame:
    """The panel with a row for each score: score, value."""
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("score"), F.col(s).cast("double").alias("value")) for s in scores)))
    return panel.select("date", "symbol", "in_universe", *(c for c in ("vol20",) if c in panel.columns), each.alias("x")).select("*", "x.score", "x.value").drop("x")


def run_days(panel: DataFrame, runs: DataFrame, params: Params) -> DataFrame:
    """run, score, date, next_date, later, is_signal: each run's calendar.

    Signals are the last day of each week or month and the first day of the run (C1); they take effect `lag` days of it later.
    """
    days = calendar(panel).select("date")
    ends = days.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    first, last = F.greatest(F.coalesce("start", "a"), "a"), F.least(F.coalesce("end", "b"), "b")
    spans = runs.join(ends).withColumns({"a": first, "b": last}).where("a <= b").select("run", "score", F.explode(F.sequence("a", "b")).alias("date"))
    mine = spans.join(days, "date")
    w = Window.partitionBy("run").orderBy("date")
    unit = {"weekly": "week", "monthly": "month", "daily": "day"}.get(params.rebalance)
    if unit is None:
        raise ValueError(f"unknown frequency: {params.rebalance}")
    placed = mine.withColumns({"next_date": F.lead("date").over(w), "later": F.lead("date", params.lag).over(w) if params.lag else F.col("date"), "first": F.lag("date").over(w).isNull()})
    last = F.col("next_date").isNull() | (F.date_trunc(unit, "date") != F.date_trunc(unit, "next_date"))
    return placed.withColumn("is_signal", last | F.col("first")).drop("first")


def plans(panel: DataFrame, days: DataFrame, scores: list[str]) -> DataFrame:
    """Run, score, k (from 0), signal_date, effective_date, prev_date. Dates before the first scored signal are warm-up.

    Where prediction windows are counted, signals without any are skipped up to the first scored one of the run.
    """
    placed = days.where("is_signal and later is not null").select("run", "score", F.col("date").alias("signal_date"), F.col("later").alias("effective_date"))
    if "prediction_window_count" in panel.columns:
        seen = _long(panel, scores).where("in_universe and value is not null").select("score", F.col("date").alias("signal_date")).distinct()
        first = placed.join(seen, ["score", "signal_date"]).groupBy("run").agg(F.min("signal_date").alias("first_signal"))
        placed = placed.join(first, "run").where(F.col("signal_date") >= F.col("first_signal")).drop("first_signal")
    w = Window.partitionBy("run").orderBy("effective_date", "signal_date")
    return placed.withColumns({"k": F.row_number().over(w) - 1, "prev_date": F.lag("effective_date").over(w)})


def events(panel: DataFrame, score: str, params: Params) -> DataFrame:
    """B4 of one score: k, signal_date, effective_date, prev_date."""
    runs = runs_of(panel.sparkSession, [(score, score, None, None)])
    return plans(panel, stored(run_days(panel, runs, params), "days"), [score]).drop("run", "score")


def _fee_factor(cost: float) -> Column:
    """G with g + cost * sum|w g - b| = 1, by bisection over the arrays `w` and `b` of one event."""
    moved = lambda g: F.aggregate(F.zip_with("w", "b", lambda w, b: F.abs(w * g - b)), F.lit(0.0), lambda a, x: a + x)
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def halve(s, _):
        mid = (s["lo"] + s["hi"]) / 2
        high = mid + cost * moved(mid) > 1
        return F.struct(F.when(high, s["lo"]).otherwise(mid).alias("lo"), F.when(high, mid).otherwise(s["hi"]).alias("hi"))

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halve, lambda s: s["lo"])
    return F.when((F.lit(cost) > 0) & (moved(F.lit(1.0)) > 0), solved).otherwise(1.0)


def _at(df: DataFrame, prices: DataFrame, day: str, name: str, how: str = "inner") -> DataFrame:
    """Adds the open of `symbol` on the date in `day` as `name`."""
    side = prices.select(F.col("p_date").alias("_d"), F.col("p_symbol").alias("_s"), F.col("open").alias(name))
    return df.join(side, (F.col(day) == F.col("_d")) & (F.col("symbol") == F.col("_s")), how).drop("_d", "_s")


def _prices(panel: DataFrame) -> DataFrame:
    return panel.select(F.col("date").alias("p_date"), F.col("symbol").alias("p_symbol"), "open")


def keyed_rebalances(panel: DataFrame, runs: DataFrame, scores: list[str], params: Params) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(events with g and turnover; weights by event; drift by event and symbol: before, target, after; days), all by run: B4 to B6, B9, B10."""
    days = stored(run_days(panel, runs, params), "days")
    plan = stored(plans(panel, days, scores), "plan")
    signals = plan.select("score", F.col("signal_date").alias("date")).distinct()
    long = _long(panel.join(signals.select("date").distinct(), "date", "left_semi"), scores)
    chosen = select_weights(long.join(signals, ["score", "date"], "left_semi"), "value", params, ("score",)).withColumnRenamed("date", "signal_date")
    target = stored(plan.join(chosen, ["score", "signal_date"]).select("run", "k", "effective_date", "symbol", "weight"), "target")
    prices = _prices(panel)
    held = target.select("run", F.col("effective_date").alias("prev_date"), "symbol", F.col("weight").alias("w_prev"))
    carried = held.join(plan.select("run", "k", "prev_date", "effective_date"), ["run", "prev_date"])
    carried = _at(_at(carried, prices, "prev_date", "p0"), prices, "effective_date", "p1").withColumn("grown", F.col("w_prev") * F.col("p1") / F.col("p0"))
    w = Window.partitionBy("run", "k")
    carried = carried.withColumn("before", F.col("grown") / (1 - F.sum("w_prev").over(w) + F.sum("grown").over(w))).select("run", "k", "symbol", "before")
    both = carried.join(target.select("run", "k", "symbol", "weight"), ["run", "k", "symbol"], "full").select("run", "k", "symbol", F.coalesce("before", F.lit(0.0)).alias("before"), F.coalesce("weight", F.lit(0.0)).alias("target"))
    both = stored(both, "both")
    arrays = both.groupBy("run", "k").agg(F.sort_array(F.collect_list(F.struct("symbol", "target", "before"))).alias("x")).select("run", "k", F.col("x.target").alias("w"), F.col("x.before").alias("b"))
    solved = arrays.withColumn("g", _fee_factor(params.cost))
    turnover = F.aggregate(F.zip_with("w", "b", lambda a, b: F.abs(a * F.col("g") - b)), F.lit(0.0), lambda a, x: a + x) / 2
    done = plan.join(solved.select("run", "k", "g", turnover.alias("turnover")), ["run", "k"], "left").withColumns({"g": F.coalesce("g", F.lit(1.0)), "turnover": F.coalesce("turnover", F.lit(0.0))})
    done = stored(done, "events")
    drift = both.join(done.select("run", "k", "g", "signal_date", "effective_date"), ["run", "k"]).withColumn("after", F.col("target") * F.col("g"))
    return done, target, drift, days


def rebalances(panel: DataFrame, score: str, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events with g and turnover; weights by event; drift by event and symbol) of one score over all dates."""
    done, target, drift, _ = keyed_rebalances(panel, runs_of(panel.sparkSession, [(score, score, None, None)]), [score], params)
    return done.drop("run", "score"), target.drop("run"), drift.drop("run")


def _segments(days: DataFrame, plan: DataFrame) -> DataFrame:
    """run, date, next_date, seg_date: the event whose weights hold on each day; null before the first."""
    marked = days.select("run", "date", "next_date").join(plan.select("run", F.col("effective_date").alias("date"), F.col("effective_date").alias("e")), ["run", "date"], "left")
    return marked.withColumn("seg_date", F.last("e", ignorenulls=True).over(Window.partitionBy("run").orderBy("date"))).drop("e")


def _moves(panel: DataFrame, days: DataFrame, target: DataFrame) -> DataFrame:
    """run, date, symbol, weight, m0, m1: each held weight times its price change from the event to the date and to the next one.

    Without a price at the event or the day, a move is null.
    """
    prices = _prices(panel)
    based = _at(target.select("run", F.col("effective_date").alias("seg_date"), "symbol", "weight"), prices, "seg_date", "base", "left")
    held = days.where("seg_date is not null").join(based, ["run", "seg_date"])
    priced = _at(_at(held, prices, "date", "p0", "left"), prices, "next_date", "p1", "left")
    return priced.select("run", "date", "symbol", "weight", *((F.col("weight") * F.col(p) / F.col("base")).alias(m) for p, m in (("p0", "m0"), ("p1", "m1"))))


def _slim(panel: DataFrame, *scores: str) -> DataFrame:
    """What returns need of the panel, written once."""
    wanted = ["date", "symbol", "open", "in_universe", "vol20", *scores, "prediction_window_count"]
    return stored(panel.select(*(c for c in dict.fromkeys(wanted) if c in panel.columns)), "slim")


def keyed_returns(panel: DataFrame, runs: DataFrame, scores: list[str], params: Params) -> DataFrame:
    """Run, date, net_return, equity, turnover of all runs; the number of scans does not depend on how many there are.

    Days before a run's first event return 0; its last day keeps its costs.
    """
    panel = _slim(panel, *scores)
    plan, target, _, all_days = keyed_rebalances(panel, runs, scores, params)
    days = stored(_segments(all_days, plan), "segments")
    moves = _moves(panel, days, target).groupBy("run", "date").agg(*(x for m in ("m0", "m1") for x in (F.sum(m).alias(m), F.sum(F.when(F.col(m).isNotNull(), F.col("weight"))).alias(f"w_{m}"))))
    out = days.join(moves, ["run", "date"], "left")
    v = lambda m: 1 - F.coalesce(f"w_{m}", F.lit(0.0)) + F.coalesce(m, F.lit(0.0))
    grow = F.when(F.col("next_date").isNull(), 1.0).otherwise(v("m1") / v("m0"))
    out = out.join(plan.select("run", F.col("effective_date").alias("date"), "g", "turnover"), ["run", "date"], "left")
    rate = F.when(F.col("seg_date").isNull(), 0.0).otherwise(grow * F.coalesce("g", F.lit(1.0)) - 1)
    out = out.select("run", "date", rate.alias("net_return"), F.coalesce("turnover", F.lit(0.0)).alias("turnover"))
    return out.withColumn("equity", F.exp(F.sum(F.ln(1 + F.col("net_return"))).over(Window.partitionBy("run").orderBy("date"))))


def daily_returns(panel: DataFrame, score: str, params: Params) -> DataFrame:
    """Date, net_return, equity, turnover of one score over all dates."""
    return keyed_returns(panel, runs_of(panel.sparkSession, [(score, score, None, None)]), [score], params).drop("run")


def trades(panel: DataFrame, score: str, params: Params) -> DataFrame:
    """Every change of weight that is not 0 at 12 decimals."""
    _, _, drift = rebalances(_slim(panel, score), score, params)
    change = F.col("after") - F.col("before")
    return drift.where(F.round(change, 12) != 0).select("effective_date", "signal_date", "symbol", F.col("before").alias("weight_before"), F.col("after").alias("weight_after"), change.alias("weight_change"), F.lit(score).alias("score_source"))


def holdings(panel: DataFrame, score: str, params: Params) -> DataFrame:
    """Date, symbol, weight of equity, drifting between events."""
    panel = _slim(panel, score)
    plan, target, _, days = keyed_rebalances(panel, runs_of(panel.sparkSession, [(score, score, None, None)]), [score], params)
    moved = _moves(panel, _segments(days, plan), target).where("m0 is not null")
    w = Window.partitionBy("date")
    return moved.withColumn("weight", F.col("m0") / (1 - F.sum("weight").over(w) + F.sum("m0").over(w))).where("weight <> 0").select("date", "symbol", "weight")


def guards(panel: DataFrame, score: str, params: Params) -> DataFrame:
    """Check, violations: what makes returns untrustworthy, counted."""
    not_finite = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    panel = _slim(panel, score)
    _, target, _ = rebalances(panel, score, params)
    rows = panel.agg(
        F.count_if(F.col("in_universe").isNull()).alias("membership_missing"),
        F.count_if(F.col("in_universe") & true(not_finite(score))).alias("score_not_finite"),
        (F.datediff(F.max("date"), F.min("date")) + 1 - F.countDistinct("date")).cast("long").alias("days_missing"),
    )
    traded = target.join(panel.select(F.col("date").alias("effective_date"), "symbol", "open"), ["effective_date", "symbol"], "left")
    prices = traded.agg(F.count_if(~true(F.col("open") > 0)).alias("price_not_positive"))
    sums = target.groupBy("k").agg(F.sum("weight").alias("s"), F.min("weight").alias("m")).agg(F.count_if((F.col("s") > 1 + 1e-12) | (F.col("m") < 0)).alias("weights_not_long_only"))
    one = rows.crossJoin(prices).crossJoin(sums).withColumn("cost_out_of_range", F.lit(0 if 0 <= params.cost < 1 else 1).cast("long"))
    return one.unpivot([], one.columns, "check", "violations")


def suite(panel: DataFrame, scores: list[str], params: Params) -> DataFrame:
    """Daily returns of those of the score columns that the panel has, tagged with `strategy`, in one plan."""
    known = [s for s in scores if s in panel.columns]
    return keyed_returns(panel, runs_of(panel.sparkSession, [(s, s, None, None) for s in known]), known, params).withColumnRenamed("run", "strategy")
