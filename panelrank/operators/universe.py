"""Dynamic universe: eligibility (U1 to U5), confirmation hysteresis (U6), membership by day (U7, U8), candidate lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelrank.config import Params, UniverseMode
from panelrank.functions.nulls import true
from panelrank.functions.tables import stored
from panelrank.functions.windows import global_rank
from panelrank.operators.calendar import calendar, refresh_schedule
from panelrank.operators.features import liquid_days


def metadata_filter(meta: DataFrame, params: Params) -> DataFrame:
    """P5: symbol, metadata_eligible, is_benchmark. A keyword excludes wherever it stands in the base asset."""
    base = F.upper("base_asset")
    noisy = reduce(lambda a, b: a | b, [base.contains(k) for k in params.excluded_keywords], F.lit(False))
    fine = (
        (F.upper("status") == "TRADING")
        & F.upper("quote_asset").isin(*params.quotes)
        & F.col("is_spot_trading_allowed")
        & ~base.isin(*params.excluded_bases, "")
        & ~F.upper("symbol").isin(*params.excluded_symbols, "")
        & ~noisy
    )
    mine = F.col("symbol") == params.benchmark
    return meta.select("symbol", (true(fine) | mine).alias("metadata_eligible"), mine.alias("is_benchmark"))


def market_cap_screen(caps: DataFrame, least_usd: float | None = None, worst_rank: float | None = None, order: str | None = None) -> DataFrame:
    """Symbol, market_cap_eligible; of repeated symbols the last row by `order` counts, by default that of the largest rank."""
    last = F.struct(F.col(order or "market_cap_rank").isNotNull(), F.col(order or "market_cap_rank"), "market_cap_usd")
    one = caps.groupBy(F.upper("symbol").alias("symbol")).agg(F.max_by(F.struct(F.col("market_cap_usd").alias("usd"), F.col("market_cap_rank").alias("rank")), last).alias("x")).select("symbol", "x.*")
    fine = F.lit(True)
    if least_usd is not None:
        fine = fine & (F.coalesce(F.col("usd").try_cast("double"), F.lit(0.0)) >= least_usd)
    if worst_rank is not None:
        fine = fine & (F.coalesce(F.col("rank").try_cast("double"), F.lit(float("inf"))) <= worst_rank)
    return one.select("symbol", fine.alias("market_cap_eligible"))


def eligibility(panel: DataFrame, meta: DataFrame, params: Params, caps: DataFrame | None = None) -> DataFrame:
    """A column for each test, and candidate_eligible."""
    mode = params.mode
    out = liquid_days(panel, mode).join(metadata_filter(meta, params), "symbol", "left")
    if caps is not None:
        out = out.join(caps, "symbol", "left").withColumn("market_cap_eligible", F.coalesce("market_cap_eligible", F.lit(False)))
    else:
        out = out.withColumn("market_cap_eligible", F.lit(True))
    at_least = lambda c, x: true(F.col(c) >= x)
    days = lambda n, least: (F.coalesce(f"liquid_days_{n}", F.lit(0)) >= least) if least > 0 else F.lit(True)
    out = out.withColumns(
        {
            "metadata_eligible": F.coalesce("metadata_eligible", F.lit(False)),
            "is_benchmark": F.coalesce("is_benchmark", F.lit(False)),
            "history_eligible": at_least("age_days", mode.min_history),
            "liquidity_eligible": reduce(lambda a, b: a & b, [at_least(f"avg_quote_vol_{n}", v) for n, v in zip((30, 90, 180), mode.min_volume)]) & at_least("liquidity_stability", mode.min_stability),
            "tradable_eligible": at_least("tradable_ratio_180", mode.min_tradable),
            "continuous_eligible": days(90, mode.min_days[0]) & days(180, mode.min_days[1]),
        }
    )
    tests = ("metadata", "history", "liquidity", "tradable", "continuous", "market_cap")
    return out.withColumn("candidate_eligible", reduce(lambda a, b: a & b, [F.col(f"{t}_eligible") for t in tests]) & ~F.col("is_benchmark"))


def memberships(candidates: DataFrame, refreshes: DataFrame, mode: UniverseMode, symbols: DataFrame | None = None) -> DataFrame:
    """snapshot_date, symbol, member. `candidates` has date, symbol, candidate_eligible; `symbols` by default those in it.

    A symbol enters after `enter_after` refreshes in a row at which it is eligible and leaves after `leave_after` at which
    it is not; a symbol without a row at a refresh is not eligible. A run of equal answers is an island; the first row
    of it that is long enough sets or resets the latch, and the last such event holds.
    """
    w = Window.partitionBy("symbol").orderBy("snapshot_date")
    dates = refreshes.agg(F.sort_array(F.collect_set("date")).alias("dates"))  # one row: a date a month
    every = (candidates.select("symbol").distinct() if symbols is None else symbols).join(dates).select("symbol", F.explode("dates").alias("snapshot_date"))
    known = candidates.select("symbol", F.col("date").alias("snapshot_date"), F.col("candidate_eligible").alias("ok"))
    asked = every.join(known, ["symbol", "snapshot_date"], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    islands = asked.withColumn("new", F.when(F.col("ok") == F.lag("ok").over(w), 0).otherwise(1)).withColumn("island", F.sum("new").over(w))
    streak = F.row_number().over(Window.partitionBy("symbol", "island").orderBy("snapshot_date"))
    event = F.when(F.col("ok") & (F.col("streak") >= mode.enter_after), True).when(~F.col("ok") & (F.col("streak") >= mode.leave_after), False)
    latched = islands.withColumn("streak", streak).withColumn("event", event)
    return latched.select("snapshot_date", "symbol", F.coalesce(F.last("event", ignorenulls=True).over(w), F.lit(False)).alias("member"))


def spread(panel: DataFrame, members: DataFrame, refreshes: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """universe_snapshot_date and in_universe for every row: the last refresh up to its date decides."""
    days = (calendar(panel) if days is None else days).select("date").join(refreshes.select("date", F.col("date").alias("snap")), "date", "left")
    days = days.withColumn("universe_snapshot_date", F.last("snap", ignorenulls=True).over(Window.orderBy("date"))).drop("snap")
    joined = panel.join(days, "date").join(members.withColumnRenamed("snapshot_date", "universe_snapshot_date"), ["universe_snapshot_date", "symbol"], "left")
    return joined.withColumn("in_universe", F.coalesce("member", F.lit(False)) & ~F.col("is_benchmark")).drop("member")


def dynamic_universe(panel: DataFrame, meta: DataFrame, params: Params, caps: DataFrame | None = None) -> DataFrame:
    """U8: the panel with eligibility, snapshot date and membership.

    Calendar, refreshes and memberships, a few rows a date or symbol, are written, so the panel is read for each once.
    """
    tested = eligibility(panel, meta, params, caps)
    days = stored(calendar(panel), "days")
    refreshes = stored(refresh_schedule(days), "refreshes")
    at = tested.select("date", "symbol", "candidate_eligible").join(refreshes.select("date"), "date", "left_semi")
    every = panel.select("symbol").distinct()
    members = stored(memberships(at, refreshes, params.mode, every), "members")
    return spread(tested, members, refreshes, days)


def _last(n: int, agg, x: Column) -> Column:
    return agg(F.when(F.col("back") <= n, x))


def recent_stats(history: DataFrame, floor: float) -> DataFrame:
    """Per symbol: rows, mean volumes of the last 30, 90 and 180 rows, stability, tradable share, liquid days; one pass."""
    back = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("date")))
    v = F.col("quote_volume")
    tradable = F.when(true((v > 0) & F.col("close").isNotNull()), 1.0).otherwise(0.0)
    liquid = F.when(true(v >= floor), 1).otherwise(0)
    out = history.withColumn("back", back).groupBy("symbol").agg(
        F.count("*").alias("history_days"),
        F.max("date").alias("last_date"),
        *(_last(n, F.avg, v).alias(f"avg_quote_vol_{n}") for n in (30, 90, 180)),
        _last(180, F.avg, tradable).alias("tradable_ratio_180"),
        *(_last(n, F.sum, liquid).alias(f"liquid_days_{n}") for n in (90, 180)),
    )
    means = [f"avg_quote_vol_{n}" for n in (30, 90, 180)]
    return out.withColumn("liquidity_stability", F.try_divide(F.least(*means), F.greatest(*means)))


#: How much of each threshold a live candidate must reach.
RELAXED = {"history": 0.90, "volume": 0.80, "stability": 0.90, "tradable": 0.98, "days": 0.90}


def live_candidates(stats: DataFrame, params: Params, previous: DataFrame, least: int = 15, most: int = 24, meta: DataFrame | None = None) -> DataFrame:
    """Symbol, source, place: the benchmark first, then the chosen by eight keys, then those of the previous pool only.

    All symbols that pass the relaxed tests are chosen, and the best others up to `least`; `most` bounds the places that are
    filled, not the passing. Thresholds on days are cut to whole ones. `meta` limits the ranking to eligible symbols.
    """
    m = params.mode
    ok = (
        (F.col("history_days") >= int(m.min_history * RELAXED["history"]))
        & reduce(lambda a, b: a & b, [F.coalesce(f"avg_quote_vol_{n}", F.lit(0.0)) >= v * RELAXED["volume"] for n, v in zip((30, 90, 180), m.min_volume)])
        & (F.coalesce("liquidity_stability", F.lit(0.0)) >= m.min_stability * RELAXED["stability"])
        & (F.coalesce("tradable_ratio_180", F.lit(0.0)) >= m.min_tradable * RELAXED["tradable"])
        & reduce(lambda a, b: a & b, [F.col(f"liquid_days_{n}") >= int(d * RELAXED["days"]) for n, d in zip((90, 180), m.min_days)])
    )
    able = stats if meta is None else stats.join(metadata_filter(meta, params).where("metadata_eligible").select("symbol"), "symbol", "left_semi")
    keys = [F.desc("ok"), *(F.desc_nulls_last(c) for c in ("avg_quote_vol_180", "avg_quote_vol_90", "avg_quote_vol_30", "liquidity_stability", "tradable_ratio_180", "history_days")), F.col("symbol")]
    ranked = global_rank(able.select("*", true(ok).alias("ok")), keys, "r").select("symbol", "ok", "r")
    ranked = ranked.join(ranked.agg(F.count_if("ok").alias("n_ok")))  # one row
    target = F.least(F.greatest(F.col("n_ok"), F.lit(least), F.lit(1)), F.lit(most))
    old = previous.select(F.col("symbol").alias("old")).distinct()
    met = ranked.join(old, F.col("symbol") == F.col("old"), "full")
    first = F.lit(params.benchmark)
    rows = met.where(F.coalesce("ok", F.lit(False)) | F.coalesce(F.col("r") <= target, F.lit(False)) | F.col("old").isNotNull()).select(F.coalesce("symbol", "old").alias("symbol"), "r", F.when(true(F.col("ok") | (F.col("r") <= target)), "ranked").otherwise("previous").alias("source"))
    every = rows.where(F.col("symbol") != first).unionByName(stats.sparkSession.range(1).select(first.alias("symbol"), F.lit(0).cast("long").alias("r"), F.lit("benchmark").alias("source")))
    return global_rank(every, [F.asc_nulls_last("r"), F.col("symbol")], "place").select("symbol", "source", F.col("place").cast("int").alias("place"))


def download_candidates(meta: DataFrame, stats: DataFrame, tickers: DataFrame, params: Params, extra_bases: tuple[str, ...] = (), top: int | None = None) -> DataFrame:
    """Ranked candidates with the benchmark first; tickers: symbol, ticker_volume, trades."""
    base = F.upper("base_asset")
    wide = meta.where(~base.isin(*extra_bases, "") & ~base.contains("USD"))
    filtered = metadata_filter(wide, params).where("metadata_eligible")
    joined = filtered.join(stats, "symbol", "left").join(tickers, "symbol", "left")
    numbers = ["avg_quote_vol_180", "avg_quote_vol_90", "avg_quote_vol_30", "liquidity_stability", "tradable_ratio_180", "history_days", "ticker_volume", "trades"]
    filled = joined.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers})
    keys = [F.desc("has_history"), *(F.desc(c) for c in numbers), "symbol"]
    ranked = global_rank(filled.withColumn("has_history", F.col("history_days") > 0), [k if isinstance(k, Column) else F.col(k) for k in keys], "download_rank")
    head = ranked.agg(F.max(F.when(F.col("is_benchmark"), F.col("download_rank"))).alias("first"))  # one row: the benchmark's rank, null without it
    moved = F.when(F.col("is_benchmark"), 1).otherwise(F.col("download_rank") + F.coalesce((F.col("download_rank") < F.col("first")).cast("int"), F.lit(0)))
    placed = ranked.join(head).withColumn("place", moved)
    cut = placed if top is None else placed.where(F.col("place") <= top)
    return cut.select("symbol", *(F.col(c).cast("int").alias(c) for c in ("download_rank", "place")), *numbers)
