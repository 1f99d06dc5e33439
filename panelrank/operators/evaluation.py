"""Performance and leader-selection metrics (V1 to V9), runs over spans of dates (V6, V11, V12) and profiles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelrank.config import DAYS_PER_YEAR, Params
from panelrank.functions.tables import stored
from panelrank.functions.windows import mean_rank
from panelrank.operators import portfolio
from panelrank.operators.calendar import calendar, schedule

METRICS = ("cagr", "volatility", "sharpe", "sortino", "max_drawdown", "calmar", "win_rate", "turnover")
LEADER = ("precision", "recall", "hit_rate", "leader_capture", "avg_rank", "overlap")


def return_faults(returns: DataFrame, by: list[str]) -> DataFrame:
    """V1: per group: rows, leading gap, and what forbids compounding: repeated dates, inner gaps, values not finite or at -1 or less."""
    w = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.max(F.col("net_return").isNotNull()).over(w)
    r = F.col("net_return")
    return returns.withColumn("seen", seen).groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("seen")).alias("leading_gap"),
        (F.count("*") - F.countDistinct("date")).alias("repeated_dates"),
        F.count_if(F.col("seen") & r.isNull()).alias("inner_gaps"),
        F.count_if(F.isnan(r) | (F.abs(r) == float("inf"))).alias("not_finite"),
        F.count_if(r <= -1).alias("at_most_minus_one"),
    )


def performance(returns: DataFrame, by: list[str]) -> DataFrame:
    """V2, V7: the metrics of daily net_return and turnover in each group; the leading gap is left out."""
    w = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    seen = returns.withColumn("_seen", F.max(F.col("net_return").isNotNull()).over(w)).where("_seen")
    grown = seen.withColumn("_e", F.exp(F.sum(F.ln(1 + F.col("net_return"))).over(w)))
    drawn = grown.withColumn("_d", F.col("_e") / F.greatest(F.max("_e").over(w), F.lit(1.0)) - 1)
    r, year = F.col("net_return"), float(DAYS_PER_YEAR)
    down = F.when(r < 0, r).otherwise(0.0)
    agg = drawn.groupBy(*by).agg(
        F.count("*").alias("observations"),
        (F.pow(F.exp(F.sum(F.ln(1 + r))), year / F.count("*")) - 1).alias("cagr"),
        (F.stddev_pop(r) * year**0.5).alias("volatility"),
        (F.avg(r) * year).alias("_mean"),
        (F.sqrt(F.avg(down * down)) * year**0.5).alias("_down"),
        F.min("_d").alias("max_drawdown"),
        F.avg(F.when(r > 0, 1.0).otherwise(0.0)).alias("win_rate"),
        (F.avg("turnover") * year).alias("turnover"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return agg.select(*by, "observations", "cagr", "volatility", ratio("_mean", "volatility").alias("sharpe"), ratio("_mean", "_down").alias("sortino"), "max_drawdown",
                      F.when(F.col("max_drawdown") < 0, F.col("cagr") / F.abs("max_drawdown")).alias("calmar"), "win_rate", "turnover")


def _by_horizon(panel: DataFrame, score: str, params: Params, keep: list[str]) -> DataFrame:
    """One row per horizon for each scored member: horizon, future (its return, may be null), score."""
    each = F.explode(F.array(*(F.struct(F.lit(h).alias("horizon"), F.col(f"future_return_{h}").alias("future")) for h in params.horizons)))
    able = F.col("in_universe") & F.col(score).isNotNull()
    return panel.where(able).select(*keep, F.col(score).alias("score"), each.alias("x")).select(*keep, "score", "x.*")


def leader_dates(panel: DataFrame, score: str, params: Params, dates: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per group, date and horizon: how the top names by score met the future leaders; dates with too few names are skipped."""
    keys = [*(by or []), "date", "horizon"]
    rows = _by_horizon(panel.join(dates.select("date"), "date"), score, params, [*(by or []), "date", "symbol"]).where("future is not null")
    w = Window.partitionBy(*keys)
    placed = rows.withColumns({"r": F.row_number().over(w.orderBy(F.desc("score"), "symbol")), "f": F.row_number().over(w.orderBy(F.desc("future"), "symbol")), "n": F.count("*").over(w)})
    mine, leads = F.col("r") <= params.top_n, F.col("f") <= params.future_top_k
    agg = placed.where(F.col("n") >= max(params.top_n, params.future_top_k)).groupBy(*keys).agg(
        F.count_if(mine & leads).alias("overlap"), F.max((mine & (F.col("f") == 1)).cast("double")).alias("leader_capture"), F.avg(F.when(leads, F.col("r"))).alias("avg_rank")
    )
    o = F.col("overlap")
    return agg.select(*keys, (o / params.top_n).alias("precision"), (o / params.future_top_k).alias("recall"), (o > 0).cast("double").alias("hit_rate"), "leader_capture", "avg_rank", "overlap")


def leader_selection(panel: DataFrame, score: str, params: Params, by: list[str] | None = None) -> DataFrame:
    """V3: per horizon the means over the rebalance dates."""
    dates = schedule(calendar(panel), params.rebalance)
    keys = [*(by or []), "horizon"]
    return leader_dates(panel, score, params, dates, by).groupBy(*keys).agg(F.count("*").alias("dates"), *(F.avg(c).alias(c) for c in LEADER))


def pool_validation(panel: DataFrame, score: str, params: Params, frequency: str = "monthly") -> DataFrame:
    """V4: per date with a full pool, and horizon: the pool, its stability and churn, and how it met the future leaders."""
    k = params.pool_size
    dates = schedule(calendar(panel), frequency)
    members = panel.join(dates.select("date"), "date").where(F.col("in_universe") & F.col(score).isNotNull())
    w = Window.partitionBy("date")
    ranked = members.withColumns({"r": F.row_number().over(w.orderBy(F.desc(score), "symbol")), "n": F.count("*").over(w)}).where(F.col("n") >= k)
    pools = ranked.where(F.col("r") <= k).groupBy("date").agg(F.sort_array(F.collect_list(F.struct("r", "symbol"))).alias("x")).select("date", F.col("x.symbol").alias("pool"))
    before = F.lag("pool").over(Window.orderBy("date"))
    pools = pools.withColumn("stability", F.when(before.isNotNull(), F.size(F.array_intersect("pool", before)) / k))
    rows = _by_horizon(ranked, score, params, ["date", "symbol", "r"]).where("future is not null")
    per = Window.partitionBy("date", "horizon")
    placed = rows.withColumns({"f": F.row_number().over(per.orderBy(F.desc("future"), "symbol")), "m": F.count("*").over(per), "fr": mean_rank("future", "date", "horizon")})
    mine, leads = F.col("r") <= k, F.col("f") <= params.future_top_k
    met = placed.where(F.col("m") >= max(k, params.future_top_k)).groupBy("date", "horizon").agg(
        F.count_if(mine).alias("seen"), F.count_if(mine & leads).alias("overlap"), F.max((mine & (F.col("f") == 1)).cast("double")).alias("leader_capture"),
        F.avg(F.when(mine, F.col("fr"))).alias("avg_future_rank"), F.avg(F.when(mine, F.col("future"))).alias("mean_future_return"),
    ).where("seen > 0")
    every = pools.withColumn("horizon", F.explode(F.array(*map(F.lit, params.horizons))))
    return every.join(met, ["date", "horizon"], "left").select(
        "date", "horizon", F.concat_ws(",", "pool").alias("pool_symbols"), "stability", (1 - F.col("stability")).alias("churn"), "overlap",
        (F.col("overlap") / k).alias("precision"), (F.col("overlap") / params.future_top_k).alias("recall"), "leader_capture", "avg_future_rank", "mean_future_return",
    )


def summary(table: DataFrame, by: list[str] | None = None, count: str = "evaluation_dates") -> DataFrame:
    """The mean of every numeric column and the number of rows."""
    numeric = [c for c, kind in table.dtypes if kind in ("double", "float", "int", "bigint", "smallint") and c not in (by or [])]
    return table.groupBy(*(by or [])).agg(F.count("*").alias(count), *(F.avg(c).alias(c) for c in numeric))


def window_validation(panel: DataFrame, score: str, params: Params, windows: DataFrame) -> DataFrame:
    """V6: window_id, then for each horizon h<n>_dates, _precision, _recall, _capture, then window_cagr, _sharpe, _max_drawdown, _turnover.

    A window is a portfolio of its own over its test dates (`portfolio.keyed_returns`). How the names of a date met its leaders
    is the same in every window that holds the date, so it is found once for each date and averaged over the windows' signal dates.
    """
    runs = windows.select(F.col("window_id").cast("string").alias("run"), F.lit(score).alias("score"), F.col("test_start").alias("start"), F.col("test_end").alias("end"))
    signals = stored(portfolio.run_days(panel, runs, params).where("is_signal").select("run", "date"), "signals")
    met = leader_dates(panel, score, params, signals.select("date").distinct())
    each = signals.join(met, "date")
    named = {"precision": "precision", "recall": "recall", "leader_capture": "capture"}
    at = lambda h, c: F.avg(F.when(F.col("horizon") == h, F.col(c)))
    leaders = each.groupBy("run").agg(*(x for h in params.horizons for x in (F.count_if(F.col("horizon") == h).alias(f"h{h}_dates"), *(at(h, c).alias(f"h{h}_{n}") for c, n in named.items()))))
    made = performance(portfolio.keyed_returns(panel, runs, [score], params), ["run"]).select("run", *(F.col(c).alias(f"window_{c}") for c in ("cagr", "sharpe", "max_drawdown", "turnover")))
    out = made.join(leaders, "run", "left")
    return out.select(F.col("run").cast("int").alias("window_id"), *(c for c in leaders.columns if c != "run"), *(c for c in made.columns if c != "run"))


#: What a run of a span may change, by the parameter's name here.
EXECUTION = {"rebalance": "rebalance", "rebalance_frequency": "rebalance", "top_n": "top_n", "weighting": "weighting", "fee_bps": "fee_bps", "slippage_bps": "slippage_bps"}


def execution_params(params: Params, changes: dict) -> Params:
    """`params` with the changes a run may make; an error names those that it may not."""
    unknown = sorted(str(k) for k in changes if k not in EXECUTION)
    if unknown:
        raise ValueError(f"unsupported parameters: {', '.join(unknown)}; supported: {', '.join(sorted(EXECUTION))}")
    return replace(params, **{EXECUTION[k]: v for k, v in changes.items()})


def slice_runs(panel: DataFrame, runs: DataFrame, scores: list[str], params: Params) -> DataFrame:
    """Run, start_date, end_date, observations, sharpe, calmar, max_drawdown, cagr, volatility, win_rate of each span.

    All spans are backtests of their own in one plan. Figures that are undefined are 0, but for calmar, which is null. A span
    without returns has no row.
    """
    returns = stored(portfolio.keyed_returns(panel, runs, scores, params), "slices")
    bounds = returns.where("net_return is not null").groupBy("run").agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    calmar = F.when(F.coalesce("max_drawdown", F.lit(0.0)) != 0, F.coalesce("cagr", F.lit(0.0)) / F.abs("max_drawdown"))
    return performance(returns, ["run"]).join(bounds, "run").select("run", "start_date", "end_date", "observations", zero("sharpe"), calmar.alias("calmar"), *(zero(c) for c in ("max_drawdown", "cagr", "volatility", "win_rate")))


def compare(one: DataFrame, two: DataFrame, keys: list[str], names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """V8: keys, metric, a, b, delta of two metric tables."""
    long = lambda df, name: df.unpivot(keys, [c for c in df.columns if c not in keys], "metric", name)
    cast = lambda df: df.select(*keys, *(F.col(c).cast("double").alias(c) for c in df.columns if c not in keys))
    both = long(cast(one), names[0]).join(long(cast(two), names[1]), [*keys, "metric"], "full")
    return both.withColumn("delta", F.col(names[1]) - F.col(names[0]))


def first_scored(panel: DataFrame, score: str, by: list[str] | None = None) -> DataFrame:
    """The first date with a scored member."""
    return panel.where(F.col("in_universe") & F.col(score).isNotNull()).groupBy(*(by or [])).agg(F.min("date").alias("first_date"))
