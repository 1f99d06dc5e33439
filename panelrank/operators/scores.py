"""Context per date (A1 to A4), labels (L1 to L6), rule scores, regime, ensemble and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelrank.config import REGIME_WEIGHTS, RULE_SCHEMES, Params
from panelrank.functions.nulls import true
from panelrank.functions.windows import by_symbol, first_rank, rank_pct

CONTEXT = ("breadth_above_sma60", "breadth_above_sma200", "momentum_dispersion", "rs_dispersion", "single_leader_burst")


def date_context(panel: DataFrame, params: Params) -> DataFrame:
    """A1 to A3: per date over its members: breadth, dispersion, and the leader's lead over the median; null with few members."""
    above = lambda c: F.avg(F.when(true(F.col(c) > 0), 1.0).otherwise(0.0))
    agg = panel.where("in_universe").groupBy("date").agg(
        F.count("*").alias("n_members"),
        above("price_vs_sma60").alias("breadth_above_sma60"),
        above("price_vs_sma200").alias("breadth_above_sma200"),
        F.stddev_samp("momentum_combo").alias("momentum_dispersion"),
        F.stddev_samp("rs_combo").alias("rs_dispersion"),
        (F.max("momentum_combo") - F.median("momentum_combo")).alias("single_leader_burst"),
    )
    return agg.select("date", "n_members", *(F.when(F.col("n_members") >= params.breadth_min_names, F.col(c)).alias(c) for c in CONTEXT))


def date_facts(panel: DataFrame, params: Params) -> DataFrame:
    """A1 to A3 and the benchmark's state, one row per date of the panel, by one aggregation; n_members is null without members."""
    mine = lambda c: F.when(F.col("in_universe"), c)
    above = lambda c: F.avg(mine(F.when(true(F.col(c) > 0), 1.0).otherwise(0.0)))
    known = [F.max(c).alias(c) for c in ("benchmark_above_sma200", "benchmark_z120") if c in panel.columns]
    out = panel.groupBy("date").agg(
        F.nullif(F.count(mine(F.lit(1))), F.lit(0)).alias("n_members"),
        above("price_vs_sma60").alias("breadth_above_sma60"),
        above("price_vs_sma200").alias("breadth_above_sma200"),
        F.stddev_samp(mine(F.col("momentum_combo"))).alias("momentum_dispersion"),
        F.stddev_samp(mine(F.col("rs_combo"))).alias("rs_dispersion"),
        (F.max(mine(F.col("momentum_combo"))) - F.median(mine(F.col("momentum_combo")))).alias("single_leader_burst"),
        *known,
    )
    return out.withColumns({c: F.when(F.col("n_members") >= params.breadth_min_names, F.col(c)) for c in CONTEXT})


def with_context(panel: DataFrame, params: Params) -> DataFrame:
    """The context in every row of its date: a row per date, joined by date; the panel's rows are not moved for it."""
    return panel.join(date_facts(panel, params).select("date", "n_members", *CONTEXT), "date", "left")


def labels(panel: DataFrame, params: Params) -> DataFrame:
    """L1 to L4: future return by rows ahead, its rank and top-k flag among members, and the blended target."""
    out = panel
    for h in params.horizons:
        out = out.withColumn(f"future_return_{h}", F.try_divide(F.lead("close", h).over(by_symbol()), F.col("close")) - 1)
    for h in params.horizons:
        seen = F.when(F.col("in_universe"), F.col(f"future_return_{h}"))
        out = out.withColumns({f"future_rank_pct_{h}": rank_pct(seen, "date"), f"future_topk_label_{h}": (first_rank(seen, "date") <= params.future_top_k).cast("double")})
    ranks = [f"future_rank_pct_{h}" for h in params.horizons]
    total = sum(params.blend)
    blend = sum((F.coalesce(r, F.lit(0.0)) * w for r, w in zip(ranks, params.blend)), F.lit(0.0)) / total
    return out.withColumn("blended_target", F.when(F.coalesce(*ranks).isNotNull(), blend))


def target(name: str, params: Params) -> Column:
    """The column to train on."""
    if name == "blended_rank_pct":
        return F.col("blended_target")
    if any(name == f"{kind}_{h}" for kind in ("future_rank_pct", "future_return", "future_topk_label") for h in params.horizons):
        return F.col(name)
    raise ValueError(f"unknown target: {name}")


def label_ends(panel: DataFrame, params: Params) -> DataFrame:
    """Per date the last date that its members' labels look at; null where a label is not complete."""
    ends = [F.lead("date", h).over(by_symbol()) for h in params.horizons]
    known = panel.select("date", "in_universe", F.greatest(*ends).alias("end"))
    return known.groupBy("date").agg(F.max(F.when(F.col("in_universe"), F.col("end"))).alias("label_end"))


def rule_scores(panel: DataFrame, params: Params) -> DataFrame:
    """The features' ranks among members, once each, combined by scheme; rule_score is the active scheme's."""
    used = sorted({f for scheme in RULE_SCHEMES.values() for f in scheme})
    ranked = panel.withColumns({f"_r_{f}": rank_pct(F.when(F.col("in_universe"), F.col(f)), "date") for f in used})
    score = lambda scheme: F.when(F.col("in_universe"), sum((F.coalesce(f"_r_{f}", F.lit(0.0)) * w for f, w in scheme.items()), F.lit(0.0)))
    scored = ranked.withColumns({f"rule_score_{name}": score(scheme) for name, scheme in RULE_SCHEMES.items()})
    return scored.withColumn("rule_score", F.col(f"rule_score_{params.scheme}")).drop(*(f"_r_{f}" for f in used))


def regimes(context: DataFrame) -> DataFrame:
    """Adds regime and regime_confidence; `context` has the date's context, benchmark_above_sma200 and benchmark_z120."""
    b60, b200, z = F.col("breadth_above_sma60"), F.col("breadth_above_sma200"), F.col("benchmark_z120")
    above, burst = true(F.col("benchmark_above_sma200") > 0), F.col("single_leader_burst")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    clip = lambda c: F.least(F.lit(1.0), c)
    off = (~above & true(b200 < 0.35)) | true(b60 < 0.25)
    leader = above & true(b60 < 0.35) & true(z > 0)
    broad = above & true(b60 > 0.55) & true(b200 > 0.40) & (burst.isNull() | true(burst < F.greatest("momentum_dispersion", F.lit(0.0))))
    name = F.when(off, "risk_off").when(leader, "btc_dominant").when(broad, "broad_alt_strength").otherwise("late_momentum")
    confidence = (
        F.when(off, clip(F.greatest(F.lit(0.0), 0.35 - zero(b200)) * 2.5))
        .when(leader, clip(F.greatest(F.lit(0.0), 0.35 - b60) * 2.5 + F.least(F.lit(0.5), z / 3)))
        .when(broad, clip(2 * F.greatest(F.lit(0.0), b60 - 0.55) + 2 * F.greatest(F.lit(0.0), b200 - 0.40)))
        .otherwise(clip(F.greatest(F.lit(0.0), zero(burst)) + F.greatest(F.lit(0.0), zero(F.col("rs_dispersion")))))
    )
    return context.withColumns({"regime": name, "regime_confidence": confidence})


def with_regime(panel: DataFrame) -> DataFrame:
    """Regime and confidence in every row, by a join with the dates: context is equal on a date, the benchmark's columns are
    taken from any row of it."""
    dates = regimes(panel.groupBy("date").agg(*(F.max(c).alias(c) for c in (*CONTEXT, "benchmark_above_sma200", "benchmark_z120"))))
    return panel.join(dates.select("date", "regime", "regime_confidence"), "date", "left")


def final_scores(panel: DataFrame, params: Params) -> DataFrame:
    """Normalised components, their weighted mean by regime, confidence, rank and selection.

    Uses rule_score, and linear_score_raw and ml_score_raw where there are such columns.
    """
    names = ("rule_score", "linear_score", "ml_score")
    raw = {"rule_score": "rule_score", "linear_score": "linear_score_raw", "ml_score": "ml_score_raw"}
    member = F.col("in_universe") & F.col("rule_score").isNotNull()
    out = panel.withColumns({n: rank_pct(F.when(member, F.col(raw[n])), "date") if raw[n] in panel.columns else F.lit(None).cast("double") for n in names})

    def weight(i: int) -> Column:
        cases = F.lit(REGIME_WEIGHTS[None][i])
        for regime, weights in REGIME_WEIGHTS.items():
            if regime:
                cases = F.when(F.col("regime") == regime, weights[i]).otherwise(cases)
        return cases

    total = sum((F.coalesce(n, F.lit(0.0)) * weight(i) for i, n in enumerate(names)), F.lit(0.0))
    used = sum((F.when(F.col(n).isNotNull(), weight(i)).otherwise(0.0) for i, n in enumerate(names)), F.lit(0.0))
    known = F.filter(F.array(*names), lambda x: x.isNotNull())
    k = F.size(known)
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / k
    spread = F.when(k >= 2, F.sqrt(F.aggregate(known, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / (k - 1)))
    agreement = 1 - F.least(F.greatest(F.coalesce(spread, F.lit(0.5)), F.lit(0.0)), F.lit(0.5)) * 2
    out = out.withColumn("final_score", F.try_divide(total, used))
    edge = F.abs(F.col("final_score") - 0.5) * 2
    out = out.withColumn("confidence", F.when(F.col("final_score").isNotNull(), F.least(F.greatest(0.6 * agreement + 0.4 * edge, F.lit(0.0)), F.lit(1.0))))
    return ranked(out, params)


def ranking_order() -> list[Column]:
    """Score, confidence, stability and volume down, nulls last, then the symbol in upper case.

    Scores are compared to 12 digits, so that the order of additions decides no tie.
    """
    scores = [F.round(c, 12).desc_nulls_last() for c in ("final_score", "confidence")]
    return [*scores, *(F.desc_nulls_last(c) for c in ("liquidity_stability", "avg_quote_vol_180")), F.upper("symbol"), F.col("symbol")]


def ranked(panel: DataFrame, params: Params) -> DataFrame:
    """current_rank and selected_flag on each date. Where prediction windows are counted, rows without one lose score,
    confidence, rank and flag; the others keep the place that they have among all."""
    able = F.col("in_universe") & F.col("final_score").isNotNull()
    place = F.row_number().over(Window.partitionBy("date", able).orderBy(*ranking_order()))
    out = panel.withColumn("current_rank", F.when(able, place))
    if "prediction_window_count" in panel.columns:
        seen = F.coalesce("prediction_window_count", F.lit(0)) > 0
        out = out.withColumns({c: F.when(seen, F.col(c)) for c in ("final_score", "confidence", "current_rank")})
    return out.withColumn("selected_flag", F.coalesce(F.col("current_rank") <= params.pool_size, F.lit(False)))


def snapshot(panel: DataFrame, as_of=None) -> DataFrame:
    """The rows of the last date up to `as_of` (or of all), in ranking order."""
    days = panel if as_of is None else panel.where(F.col("date") <= as_of)
    last = days.agg(F.max("date").alias("date"))
    return panel.join(last, "date").orderBy(*ranking_order())
