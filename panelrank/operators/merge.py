"""Merge of several price sources by priority behind a quality gate (S10, S11, S15 to S17, A7 to A11, Q1 to Q9),
and the same under many profiles at once (V10).

All symbols go through one plan: statistics grouped by symbol, one decision row each, and a union of what is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelrank.functions.nulls import finite, true
from panelrank.functions.windows import by_symbol

#: What the gate says of a symbol, by its name here.
SAYS = {"primary_only": "binance_only", "short": "insufficient_pre_binance_extension", "no_check": "unavailable", "unused_check": "informational"}

CORE = ("date", "symbol", "open", "high", "low", "close", "volume", "quote_volume")


@dataclass(frozen=True)
class Gate:
    """Limits of the quality gate. The published defaults."""

    enabled: bool = True
    min_rows_added: int = 30
    max_duplicates: int = 0
    max_gaps: int = 5
    max_gap_days: int = 7
    max_missing_core: int = 0
    jump: float = 3.0
    max_jumps: int = 10
    min_overlap_days: int = 180
    min_overlap_corr: float = 0.97
    max_overlap_diff: float = 0.03
    max_overlap_cv: float = 0.05
    min_check_days: int = 365
    check_corr: tuple[float, float] = (0.92, 0.80)  # warn, reject
    check_cv: tuple[float, float] = (0.08, 0.18)
    check_diff: tuple[float, float] = (0.03, 0.08)
    check_gaps: tuple[int, int] = (15, 60)
    check_rejects: bool = True


def normalize(df: DataFrame, source: str, provider: str, external: bool, as_of=None) -> DataFrame:
    """Canonical columns with source tags; quote volume from close * volume where absent; the last row of a date wins.

    Rows of one date are ordered by `ingested` where there is such a column.
    """
    rows = df if "quote_volume" in df.columns else df.withColumn("quote_volume", F.lit(None).cast("double"))
    rows = rows.where(F.col("date").isNotNull())
    rows = rows if as_of is None else rows.where(F.col("date") <= as_of)
    order = [F.desc("ingested")] if "ingested" in df.columns else [F.desc_nulls_last("close")]
    last = rows.withColumn("_r", F.row_number().over(Window.partitionBy("symbol", "date").orderBy(*order))).where("_r = 1")
    number = lambda c: finite(F.col(c).try_cast("double")).alias(c)
    out = last.select(F.to_date("date").alias("date"), F.upper("symbol").alias("symbol"), *(number(c) for c in CORE[2:]))
    return out.withColumn("quote_volume", F.coalesce("quote_volume", F.col("close") * F.col("volume"))).select(
        *CORE, F.lit(source).alias("data_source"), F.lit(provider).alias("data_provider"), F.lit(external).alias("is_external_source")
    )


def upsert(stored: DataFrame, fetched: DataFrame, order: str = "received_at") -> DataFrame:
    """The union with the newest row of each symbol and date; of equal ones the fetched."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(fetched.withColumn("_new", F.lit(1)))
    w = Window.partitionBy("symbol", "date").orderBy(F.desc_nulls_last(order), F.desc("_new"))
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_new")


def freshness(cached: DataFrame, as_of: Column, refresh_days: int) -> DataFrame:
    """Symbol, latest, fresh: reaches the date or came within `refresh_days` of it; always fresh if that is 0 or less."""
    latest = cached.groupBy("symbol").agg(F.max("date").alias("latest"))
    fresh = F.lit(True) if refresh_days <= 0 else true((F.col("latest") >= as_of) | (F.datediff(as_of, "latest") <= refresh_days))
    return latest.withColumn("fresh", fresh)


def density(df: DataFrame, least: float, least_rows: int = 30) -> DataFrame:
    """Symbol, n_rows, density (share of steps of one day at most), dense."""
    step = F.datediff("date", F.lag("date").over(by_symbol()))
    agg = df.withColumn("step", step).groupBy("symbol").agg(F.count("*").alias("n_rows"), F.avg(F.when(F.col("step").isNotNull(), (F.col("step") <= 1).cast("double"))).alias("density"))
    return agg.withColumn("dense", true((F.col("n_rows") >= least_rows) & (F.col("density") >= least)))


def priority(column: str, sources: list[str]) -> Column:
    """Q1: place of a source in the list; unknown ones come last."""
    out = F.lit(len(sources) + 100)
    for i, source in reversed(list(enumerate(sources))):
        out = F.when(F.col(column) == source, i).otherwise(out)
    return out


def combine(rows: DataFrame, sources: list[str]) -> DataFrame:
    """Q2, Q3: one row per symbol and date: the best source, then the provider's name."""
    w = Window.partitionBy("symbol", "date").orderBy(priority("data_source", sources), "data_provider")
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def gaps(df: DataFrame) -> DataFrame:
    """Symbol, gap_count (steps over a day), max_gap_days (1 for a single row)."""
    step = F.coalesce(F.datediff("date", F.lag("date").over(by_symbol())), F.lit(1))
    return df.withColumn("step", step).groupBy("symbol").agg(F.count_if(F.col("step") > 1).alias("gap_count"), F.max("step").alias("max_gap_days"))


def overlap(reference: DataFrame, candidate: DataFrame, prefix: str) -> DataFrame:
    """Per symbol over common dates: days, correlation and median difference of returns, variation of the price ratio."""
    a, b = reference.select("symbol", "date", F.col("close").alias("a")), candidate.select("symbol", "date", F.col("close").alias("b"))
    ret = lambda c: finite(F.try_divide(F.col(c), F.lag(c).over(by_symbol())) - 1)
    rows = a.join(b, ["symbol", "date"]).withColumns({"ra": ret("a"), "rb": ret("b"), "ratio": finite(F.try_divide("a", "b"))})
    both = F.col("ra").isNotNull() & F.col("rb").isNotNull()
    agg = rows.groupBy("symbol").agg(
        F.count("*").alias("days"), F.count_if(both).alias("pairs"), F.corr("ra", "rb").alias("corr"), F.median(F.abs(F.col("ra") - F.col("rb"))).alias("diff"),
        F.stddev_pop("ratio").alias("s"), F.avg("ratio").alias("m"),
    )
    enough, pairs = F.col("days") >= 2, F.col("pairs") >= 2
    return agg.select(
        "symbol", F.col("days").alias(f"{prefix}_days"), F.when(enough & pairs, finite("corr")).alias(f"{prefix}_corr"), F.when(enough & pairs, F.col("diff")).alias(f"{prefix}_diff"),
        F.when(enough & (F.abs("m") > 0), F.col("s") / F.abs("m")).alias(f"{prefix}_cv"),
    )


def gate_statistics(primary: DataFrame, external: DataFrame, check: DataFrame, best: DataFrame, jump: float = 3.0) -> DataFrame:
    """What the gate asks of each symbol of `primary`; `best` is the external history with one row per date, and a return
    beyond `jump` is a jump."""
    first = primary.groupBy("symbol").agg(F.min("date").alias("primary_start"))
    w = by_symbol()
    jumps = best.join(first, "symbol").withColumn("r", F.abs(finite(F.try_divide(F.col("close"), F.lag("close").over(w)) - 1)))
    missing = F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull()
    stats = jumps.groupBy("symbol").agg(
        F.count("*").alias("external_rows"), F.count_if(F.col("date") < F.col("primary_start")).alias("rows_added"), F.count_if(missing).alias("missing_core"),
        F.count_if(F.col("r") > jump).alias("jumps"), F.max("r").alias("max_abs_return"),
        F.concat_ws(",", F.array_sort(F.collect_set("data_source"))).alias("sources_used"), F.concat_ws(",", F.array_sort(F.collect_set("data_provider"))).alias("providers_used"),
    )
    repeats = external.groupBy("symbol").agg((F.count("*") - F.countDistinct("date")).alias("duplicate_dates"))
    checked = gaps(check).select("symbol", F.col("gap_count").alias("check_gaps"))
    out = first
    for part in (stats, repeats, gaps(best), overlap(primary, best, "overlap"), overlap(best, check, "check"), checked):
        out = out.join(part, "symbol", "left")
    return out


def decide(out: DataFrame, gate: Gate, merge_cautious: bool | Column = True) -> DataFrame:
    """Q4 to Q8: the decision on each row of statistics with `tier` and `caution`. The gate's limits may be columns of the row."""
    zero = ["external_rows", "rows_added", "missing_core", "jumps", "duplicate_dates", "gap_count", "max_gap_days", "overlap_days", "check_days", "check_gaps"]
    has_check = F.col("check_gaps").isNotNull()
    out = out.withColumn("_has_check", has_check).withColumns({c: F.coalesce(c, F.lit(0)) for c in zero}).withColumn("tier", F.coalesce("tier", F.lit("none")))

    long_check = F.col("_has_check") & (F.col("check_days") >= gate.min_check_days)
    over = lambda c, pair, i: true(F.col(c) > pair[i])
    tests = [
        (true(F.col("check_corr") < gate.check_corr[1]), true(F.col("check_corr") < gate.check_corr[0]), "crosscheck_return_corr"),
        (over("check_cv", gate.check_cv, 1), over("check_cv", gate.check_cv, 0), "crosscheck_price_ratio"),
        (over("check_diff", gate.check_diff, 1), over("check_diff", gate.check_diff, 0), "crosscheck_return_diff"),
        (over("check_gaps", gate.check_gaps, 1), over("check_gaps", gate.check_gaps, 0), "crosscheck_gap_count"),
    ]
    notes, severe, warned = [F.when(F.col("_has_check") & ~long_check, "limited_crosscheck_history")], F.lit(False), F.lit(False)
    for reject, warn, name in tests:
        notes.append(F.when(long_check & reject, f"{name}_reject").when(long_check & warn, f"{name}_warn"))
        severe, warned = severe | (long_check & reject), warned | (long_check & ~reject & warn)
    unused = F.when(F.col("_has_check"), SAYS["unused_check"]).otherwise(SAYS["no_check"])
    status = F.when(~F.col("_has_check"), SAYS["no_check"]).when(~long_check, "limited").when(warned, "warn").otherwise("pass")

    enough = F.col("overlap_days") >= gate.min_overlap_days
    fails = [
        (F.col("duplicate_dates") > gate.max_duplicates, "duplicate_dates_external"),
        (F.col("gap_count") > gate.max_gaps, "excessive_gap_count"),
        (F.col("max_gap_days") > gate.max_gap_days, "excessive_max_gap"),
        (F.col("missing_core") > gate.max_missing_core, "missing_core_fields"),
        (F.col("jumps") > gate.max_jumps, "suspicious_jump_count"),
        (~enough, "insufficient_overlap_days"),
        (enough & true(F.col("overlap_corr") < gate.min_overlap_corr), "low_overlap_return_corr"),
        (enough & true(F.col("overlap_diff") > gate.max_overlap_diff), "high_overlap_return_diff"),
        (enough & true(F.col("overlap_cv") > gate.max_overlap_cv), "unstable_overlap_price_ratio"),
        (severe & F.lit(gate.check_rejects), "crosscheck_severe_anomaly"),
    ]
    reasons = F.concat_ws(",", *(F.when(c, name) for c, name in fails))
    cautious = F.col("tier") == "cautious"
    approved = F.when(cautious, "approved_cautious").otherwise("approved_core")
    caution = F.coalesce("caution", F.lit(""))
    all_notes = F.concat_ws(",", F.nullif(caution, F.lit("")), *notes)
    # the first that holds decides: condition, status, reasons, decision, and what is said of the check and as notes
    chain = [
        (F.col("tier") == "none", "not_whitelisted", "symbol_not_in_backfill_whitelist", SAYS["primary_only"], unused, ""),
        (cautious & ~F.lit(merge_cautious), "cautious_holdout", "cautious_tier_not_enabled_for_merge", "cautious_holdout", unused, caution),
        (F.col("external_rows") == 0, "no_external_rows", "no_external_rows_available", "rejected", unused, ""),
        (~F.lit(gate.enabled), "merged", "", approved, F.lit(SAYS["unused_check"]), caution),
        (F.col("rows_added") < gate.min_rows_added, "insufficient_extension", SAYS["short"], "rejected", unused, ""),
        (reasons != "", "rejected_quality_gate", reasons, "rejected", status, all_notes),
    ]
    names = ("quality_status", "quality_reasons", "final_decision", "check_status", "notes")
    says = [F.lit("merged"), F.lit(""), approved, status, all_notes]
    for condition, *row in reversed(chain):
        says = [F.when(condition, x if isinstance(x, Column) else F.lit(x)).otherwise(y) for x, y in zip(row, says)]
    out = out.withColumns(dict(zip(names, says)))
    return out.withColumn("merge_applied", F.col("quality_status") == "merged").drop("_has_check", "caution")


def quality(primary: DataFrame, external: DataFrame, check: DataFrame, tiers: DataFrame, sources: list[str], gate: Gate, merge_cautious: bool = True) -> DataFrame:
    """One decision row per symbol of `primary`.

    `tiers`: symbol, tier ('core' or 'cautious'), caution (text or null).
    """
    stats = gate_statistics(primary, external, check, combine(external, sources), gate.jump)
    return decide(stats.join(tiers, "symbol", "left"), gate, merge_cautious)


#: Between a set of sources, or a profile, and a symbol in a key; no symbol has it.
MARK = "\x1f"


def profile_table(spark: SparkSession, profiles: dict[str, dict]) -> DataFrame:
    """Profiles as rows: profile, sources (best first), merge_cautious, and a column for each limit of the gate.

    Each profile gives `sources` and what differs from the published limits.
    """
    rows = []
    for name, given in profiles.items():
        unknown = set(given) - {"sources", "merge_cautious", *(f.name for f in fields(Gate))}
        if unknown:
            raise ValueError(f"unknown settings of profile {name}: {', '.join(sorted(unknown))}")
        gate = Gate(**{k: v for k, v in given.items() if k not in ("sources", "merge_cautious")})
        rows.append((name, list(given["sources"]), bool(given.get("merge_cautious", True)), *(list(v) if isinstance(v, tuple) else v for v in (getattr(gate, f.name) for f in fields(gate)))))
    kinds = {bool: "boolean", int: "long", float: "double"}
    kind = lambda v: f"array<{kinds[type(v[0])]}>" if isinstance(v, tuple) else kinds[type(v)]
    limits = ", ".join(f"{f.name} {kind(f.default)}" for f in fields(Gate))
    return spark.createDataFrame(rows, f"profile string, sources array<string>, merge_cautious boolean, {limits}")


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows once for each key, which goes before the symbol."""
    return df.withColumn("_k", F.explode(F.array(*map(F.lit, keys)))).withColumn("symbol", F.concat_ws(MARK, "_k", "symbol")).drop("_k")


def _best_of(keyed: DataFrame) -> DataFrame:
    """One row per key, symbol and date: the source that stands first in the key's list, then the provider's name."""
    place = F.array_position(F.split(F.element_at(F.split("symbol", MARK), 1), ">"), F.col("data_source"))
    w = Window.partitionBy("symbol", "date").orderBy(F.when(place > 0, place).otherwise(2**31), "data_provider")
    return keyed.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def sweep(primary: DataFrame, external: DataFrame, check: DataFrame, profiles: DataFrame, tiers: DataFrame) -> DataFrame:
    """A decision for each profile and symbol in one plan. tiers: profile, symbol, tier, caution.

    Statistics are found once for each list of sources, however many profiles share it; the limits of the gate are columns. Profiles
    whose `jump` differs count as other lists. Profiles are parameters: only their lists pass through the driver.
    """
    sets = profiles.select(F.array_join("sources", ">").alias("k"), "jump").distinct().collect()
    stats = None
    for jump in sorted({r["jump"] for r in sets}):
        keys = sorted(r["k"] for r in sets if r["jump"] == jump)
        far = _keyed(external, keys)
        one = gate_statistics(_keyed(primary, keys), far, _keyed(check, keys), _best_of(far), jump).withColumn("_jump", F.lit(jump))
        stats = one if stats is None else stats.unionByName(one)
    parts = F.split("symbol", MARK)
    stats = stats.withColumns({"_set": parts[0], "symbol": parts[1]})
    limit = {f.name: f"limit_{f.name}" for f in fields(Gate)}
    named = profiles.select("profile", F.array_join("sources", ">").alias("_of"), "merge_cautious", *(F.col(a).alias(b) for a, b in limit.items()))
    rows = stats.join(named, (F.col("_set") == F.col("_of")) & (F.col("_jump") == F.col("limit_jump"))).join(tiers, ["profile", "symbol"], "left")
    decided = decide(rows, Gate(**{a: F.col(b) for a, b in limit.items()}), F.col("merge_cautious"))
    return decided.drop("_set", "_of", "_jump", "merge_cautious", *limit.values())


def sweep_summary(decisions: DataFrame) -> DataFrame:
    """By profile: symbols asked of, approved_core, approved_cautious, rejected, cautious_holdout, merged, rows_added of the merged."""
    is_ = lambda d: F.count_if(F.col("final_decision") == d).alias(d)
    return decisions.groupBy("profile").agg(
        F.count("*").alias("symbols"), *(is_(d) for d in ("approved_core", "approved_cautious", "rejected", "cautious_holdout")),
        F.count_if("merge_applied").alias("merged"), F.coalesce(F.sum(F.when(F.col("merge_applied"), F.col("rows_added"))), F.lit(0)).alias("merged_rows_added"),
    )


def sweep_histories(primary: DataFrame, external: DataFrame, decisions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile, date, symbol and prices: each profile's merged history; symbols that it does not merge have the primary rows."""
    named = {r["profile"]: r["sources"] for r in profiles.select("profile", "sources").collect()}
    order = F.create_map(*(x for p, sources in named.items() for x in (F.lit(p), F.array(*map(F.lit, sources)))))
    each = F.explode(F.array(*map(F.lit, named)))
    allowed = external.join(decisions.where("merge_applied").select("profile", "symbol"), "symbol")
    both = primary.withColumn("profile", each).unionByName(allowed)
    place = F.array_position(order[F.col("profile")], F.col("data_source"))
    w = Window.partitionBy("profile", "symbol", "date").orderBy(F.when(place > 0, place).otherwise(2**31), "data_provider")
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def merge_histories(primary: DataFrame, external: DataFrame, check: DataFrame, tiers: DataFrame, sources: list[str], gate: Gate, merge_cautious: bool = True) -> tuple[DataFrame, DataFrame]:
    """Q9: the merged history of all symbols, and the decision table."""
    decisions = quality(primary, external, check, tiers, sources, gate, merge_cautious)
    allowed = external.join(decisions.where("merge_applied").select("symbol"), "symbol", "left_semi")
    return combine(primary.unionByName(allowed), sources), decisions


def coverage(primary: DataFrame, merged: DataFrame) -> DataFrame:
    """Per symbol: first dates before and after, rows before and after, and rows by source as JSON."""
    before = primary.groupBy("symbol").agg(F.min("date").alias("primary_start"), F.count("*").alias("primary_rows"))
    by_source = merged.groupBy("symbol", "data_source").agg(F.count("*").alias("n"), F.min("date").alias("first"))
    after = by_source.groupBy("symbol").agg(
        F.min("first").alias("merged_start"), F.sum("n").alias("merged_rows"), F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("data_source", "n"))))).alias("rows_by_source")
    )
    return before.join(after, "symbol").withColumn("days_gained", F.datediff("primary_start", "merged_start"))
