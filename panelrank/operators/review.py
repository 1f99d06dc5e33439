"""Review tables (A15 to A17, H4 to H7, J14, J17, Q14, Q15): what a monthly review reads from rankings, tracks and panels."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelrank.functions.nulls import finite, true


def track_metrics(index: DataFrame, metrics: dict[str, list[str]], order: str, magnitudes: tuple[str, ...] = ("max_dd",), by: str = "track") -> DataFrame:
    """Track, metric, current (of the last row, null if that has none) and baseline (mean of all rows).

    `metrics`: the names that a metric goes by, the first that has a value counts. Of `magnitudes` the absolute value counts.
    """
    of = lambda m: F.coalesce(*(finite(F.col(c).try_cast("double")) for c in metrics[m]))
    size = lambda m: F.abs(of(m)) if m in magnitudes else of(m)
    agg = index.groupBy(by).agg(*(F.struct(F.max_by(size(m), order).alias("current"), F.avg(size(m)).alias("baseline")).alias(m) for m in metrics))
    rows = agg.select(by, F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(f"{m}.current").alias("current"), F.col(f"{m}.baseline").alias("baseline")) for m in metrics))))
    return rows.where("current is not null or baseline is not null")


def strategy_metrics(index: DataFrame, tracks: DataFrame, metrics: dict[str, list[str]], repo: str, order: str = "as_of_date") -> DataFrame:
    """H4: track_id, strategy_profile, repo, current_metrics, baseline_metrics: a row for each track, with empty maps where it has
    no releases. `index`: releases by track_id; `tracks`: track_id, profile_name."""
    rows = track_metrics(index, metrics, order, by="track_id")
    entries = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("metric", c))))).alias(f"{c}_metrics")
    maps = rows.groupBy("track_id").agg(entries("current"), entries("baseline"))
    none = F.create_map().cast("map<string,double>")
    out = tracks.join(maps, "track_id", "left")
    return out.select("track_id", F.col("profile_name").alias("strategy_profile"), F.lit(repo).alias("repo"), *(F.coalesce(f"{c}_metrics", none).alias(f"{c}_metrics") for c in ("current", "baseline")))


def monthly_reviews(official: DataFrame, index: DataFrame, boundary: DataFrame, manifest: DataFrame, tracks: tuple[str, ...] = ("official_baseline", "challenger_topk_60")) -> DataFrame:
    """H7: as_of_date, status, warnings, payload: the review of every official release in one plan.

    official: as_of_date, version, mode, pool_size, symbols (list). index: the releases of the tracks (track_id, as_of_date, version, symbols as a
    list); a review knows those up to its date. boundary: H5 by date. manifest: as_of_date, manifest_date, manifest_version,
    manifest_mode. The payload is one struct as JSON; fields without a value are left out.
    """
    each = official.select("as_of_date", F.explode(F.array(*map(F.lit, tracks))).alias("track_id"), F.lit(1).alias("asked"))
    release = F.struct(F.col("as_of_date").alias("release_date"), "version", "symbols")
    met = each.select("track_id", "as_of_date", "asked", F.lit(None).cast(index.select(release.alias("r")).schema["r"].dataType).alias("r")).unionByName(
        index.where(F.col("track_id").isin(*tracks)).select("track_id", "as_of_date", F.lit(0).alias("asked"), release.alias("r")))
    w = Window.partitionBy("track_id").orderBy("as_of_date", "asked").rowsBetween(Window.unboundedPreceding, 0)
    known = met.select("track_id", "as_of_date", "asked", F.count("r").over(w).alias("n"), F.min("r.release_date").over(w).alias("first"), F.last("r", ignorenulls=True).over(w).alias("last")).where("asked = 1")
    own = official.select("as_of_date", F.col("symbols").alias("pool"))
    rows = known.join(own, "as_of_date").select(
        "as_of_date", "track_id", (F.col("n") > 0).alias("available"), F.col("n").alias("release_count"), F.col("first").alias("first_as_of_date"), F.col("last.release_date").alias("last_as_of_date"),
        F.col("last.version").alias("version"), F.col("last.symbols").alias("symbols"), F.size(F.array_intersect("last.symbols", "pool")).alias("overlap"),
        F.array_except("last.symbols", "pool").alias("only_in_track"), F.array_except("pool", "last.symbols").alias("only_in_official"),
    )
    said = F.struct("available", "release_count", "first_as_of_date", "last_as_of_date")
    shown = F.struct("available", "version", F.coalesce("symbols", F.array().cast("array<string>")).alias("symbols"), *(F.when(F.col("available"), F.col(c)).alias(c) for c in ("overlap", "only_in_track", "only_in_official")))
    by_date = rows.groupBy("as_of_date").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("track_id", said.alias("said"))))).alias("tracks"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("track_id", shown.alias("shown"))))).alias("previews"), F.max("available").alias("any_track"),
    )
    edge = boundary.select(F.col("date").alias("as_of_date"), F.struct(*(c for c in boundary.columns if c != "date")).alias("selection_boundary"))
    out = official.join(by_date, "as_of_date", "left").join(edge, "as_of_date", "left").join(manifest, "as_of_date", "left")
    differs = lambda a, b: ~F.coalesce(F.col(a), F.lit("")).eqNullSafe(F.coalesce(F.col(b).cast("string"), F.lit("")))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    track = lambda t, c: F.element_at("tracks", F.lit(t))[c]
    tests = [
        (empty("version"), "missing version"), (empty("mode"), "missing mode"),
        (differs("manifest_date", "as_of_date"), "manifest date differs"), (differs("manifest_version", "version"), "manifest version differs"), (differs("manifest_mode", "mode"), "manifest mode differs"),
        *(x for t in tracks for x in (
            (F.col("any_track") & ~track(t, "available"), f"no release of {t}"),
            (track(t, "available") & (track(t, "last_as_of_date") != F.col("as_of_date")), f"last release of {t} is of another date"))),
        (F.size("symbols") == 0, "empty pool"), (F.col("pool_size") != F.size("symbols"), "pool size differs"),
    ]
    warnings = F.filter(F.array(*(F.when(F.coalesce(test, F.lit(False)), text) for test, text in tests)), lambda x: x.isNotNull())
    out = out.withColumn("warnings", warnings).withColumn("status", F.when(F.size("warnings") > 0, "warning").otherwise("ok"))
    body = F.struct("as_of_date", "status", F.struct("version", "mode", "pool_size", "symbols").alias("official_baseline"), "tracks", F.col("previews").alias("track_release_previews"), "selection_boundary", F.col("any_track").alias("shadow_analysis_available"), "warnings")
    return out.select("as_of_date", "status", "warnings", F.to_json(body).alias("payload"))


def tidy(wide: DataFrame, ids: list[str]) -> DataFrame:
    """Ids, metric, value: a row for each other column."""
    return wide.unpivot(ids, [c for c in wide.columns if c not in ids], "metric", "value")


def wide_field(panel: DataFrame, column: str, symbols: list[str] | None = None) -> DataFrame:
    """Date and a column per symbol, for reports; give `symbols` to spare a pass that finds them."""
    return panel.groupBy("date").pivot("symbol", symbols).agg(F.first(column))


def selection_boundary(ranking: DataFrame, pool_size: int) -> DataFrame:
    """H5: by date the last row inside the cut, the next outside, and the gap of their scores.

    Ranked rows come first by rank, then the others in score order; the cut is the larger of the pool and of the selected.
    """
    rank = F.col("current_rank").try_cast("double")
    ranked = true(rank > 0)
    score = lambda c: F.when(ranked, 0.0).otherwise(-F.coalesce(F.nullif(F.col(c), F.lit(0.0)), F.lit(float("-inf"))))
    order = [F.when(ranked, 0).otherwise(1), F.when(ranked, rank), *(score(c) for c in ("final_score", "confidence", "liquidity_stability", "avg_quote_vol_180")), F.upper("symbol")]
    w = Window.partitionBy("date")
    placed = ranking.withColumns({"place": F.row_number().over(w.orderBy(*order)), "cut": F.greatest(F.count_if(F.coalesce("selected_flag", F.lit(False))).over(w), F.lit(pool_size)), "n": F.count("*").over(w)})
    at = lambda place, c: F.max(F.when(F.col("place") == place, F.col(c)))
    inside, outside = F.least("cut", "n"), F.least("cut", "n") + 1
    out = placed.groupBy("date").agg(at(inside, "symbol").alias("cutoff_symbol"), at(inside, "final_score").alias("cutoff_score"), at(outside, "symbol").alias("next_symbol"), at(outside, "final_score").alias("next_score"))
    return out.withColumn("score_gap_to_next", F.col("cutoff_score") - F.col("next_score"))


def track_release(releases: DataFrame, as_of: Column) -> DataFrame:
    """Of each track the last release of a date, or its last release at all. releases: track, pos, as_of_date, version, symbols."""
    first = F.row_number().over(Window.partitionBy("track").orderBy(F.desc(F.coalesce(F.col("as_of_date") == as_of, F.lit(False))), F.desc("pos")))
    return releases.withColumn("_r", first).where("_r = 1").drop("_r")


def track_previews(releases: DataFrame, official: DataFrame, as_of: Column) -> DataFrame:
    """H6: each track's release beside the official pool (one row with the list `official`): overlap and what only one has."""
    rows = track_release(releases, as_of).join(official.select(F.col("symbols").alias("official")))
    return rows.select(
        "track", "as_of_date", "version", "symbols", F.size(F.array_intersect("symbols", "official")).alias("overlap"),
        F.array_except("symbols", "official").alias("only_in_track"), F.array_except("official", "symbols").alias("only_in_official"),
    )


def lifecycle_report(panel: DataFrame, today: Column, references: tuple[str, ...], min_dates: int = 730, min_members: int = 2, min_reference: int = 900, min_coverage: float = 0.99, fresh_days: int = 3) -> DataFrame:
    """Check, value, ok: whether a panel may go to the lifecycle: scored dates, members, references, coverage and freshness.

    The first of `references` gives the dates that the others must cover, from its first to its last.
    """
    rows = panel.where(F.col("date").isNotNull() & (F.col("date") < today)).withColumn("symbol", F.upper(F.trim("symbol")))
    scored = rows.where("final_score is not null").groupBy("date").agg(F.countDistinct(F.when(F.col("in_universe"), F.col("symbol"))).alias("n"))
    head = scored.agg(F.count("*").alias("scored_dates"), F.coalesce(F.min("n"), F.lit(0)).alias("least_members"), F.datediff(today, F.max("date")).alias("panel_age"))
    market = rows.where(F.col("symbol").isin(*references) & F.col("close").isNotNull()).groupBy("date").agg(*(F.max((F.col("symbol") == s).cast("int")).alias(s) for s in references))
    base = F.col(f"`{references[0]}`") == 1
    sums = [F.count_if(base).alias("n0"), F.datediff(today, F.max(F.when(base, F.col("date")))).alias("market_age")]
    for i, s in enumerate(references):
        has = F.col(f"`{s}`") == 1
        dated = F.when(has, F.col("date"))
        ref = F.when(base, F.col("date"))
        sums += [(F.count_if(has & base) / F.nullif(F.count_if(base), F.lit(0))).alias(f"c{i}"), (true(F.min(dated) <= F.min(ref)) & true(F.max(dated) >= F.max(ref))).alias(f"s{i}"), F.count_if(has).alias(f"n_{i}")]
    one = head.join(market.agg(*sums))
    checks = [
        ("scored_dates", F.col("scored_dates"), F.col("scored_dates") >= min_dates), ("least_members", F.col("least_members"), F.col("least_members") >= min_members),
        ("reference_dates", F.col("n0"), F.col("n0") >= min_reference), ("panel_age", F.col("panel_age"), true(F.col("panel_age") <= fresh_days)), ("market_age", F.col("market_age"), true(F.col("market_age") <= fresh_days)),
    ]
    for i, s in enumerate(references):
        checks += [(f"rows_{s}", F.col(f"n_{i}"), F.col(f"n_{i}") > 0), (f"coverage_{s}", F.col(f"c{i}"), true(F.col(f"c{i}") >= min_coverage) & F.col(f"s{i}"))]
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), v.cast("double").alias("value"), ok.alias("ok")) for n, v, ok in checks))))


def fingerprint(table: DataFrame, columns: list[str]) -> DataFrame:
    """Q15: one row that tells a table's content whatever its order: rows, and sum and exclusive-or of row hashes of the columns as JSON.

    The sum is exact, then taken modulo 2^64 as a signed number: the hashes of some 65,000 rows pass 63 bits.
    """
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    number = F.conv(F.substring(row, 1, 12), 16, 10).cast("long")
    whole = F.lit(Decimal(1 << 64))
    rest = F.sum(number.cast("decimal(15,0)")) % whole
    signed = F.when(rest < F.lit(Decimal(1 << 63)), rest).otherwise(rest - whole).cast("long")
    return table.agg(F.count("*").alias("n_rows"), F.coalesce(signed, F.lit(0)).alias("sum_hash"), F.coalesce(F.bit_xor(number), F.lit(0)).alias("xor_hash"))
