"""Release contract (P10, J12, Q10 to Q12): a whole history of releases checked in one job, grouped by release.

A release is one row: the universe, the pool in its two forms, and what each says of itself. Each broken rule gives a row
(release, check, severity, detail); no row means that all is well. A release's lists are a few dozen symbols, so rules over
them are expressions inside its row; the ranking meets it after one aggregation by release.

Columns of `releases`: release, universe_as_of_date, universe_symbols; as_of_date, version, mode, pool_size, source_project,
symbols (list), symbol_map (symbol to base asset); and legacy_ with each of these, whose symbols are a map too. Fields are text
as they were landed; null stands for a missing field. `ranking`: release, as_of_date, symbol, current_rank, selected_flag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.functions.nulls import true

#: The fields that both forms of a pool must have, and what counts as selected.
FIELDS = ("as_of_date", "mode", "pool_size", "source_project", "symbol_map", "symbols", "version")
TRUE_WORDS = ("1", "true", "yes", "y", "on")


def stripped(raw: Column | str) -> Column:
    """A text without white space of any kind around it."""
    return F.regexp_replace(raw, r"(?U)^\s+|\s+$", "")


def symbol(raw: Column, quote: str) -> Column:
    """P10: a symbol in upper case without spaces around; null if it is empty or lacks the quote asset."""
    clean = F.upper(stripped(raw))
    return F.when(clean.endswith(quote), clean)


def symbol_list(raw: Column, quote: str) -> Column:
    """The valid symbols of a list, each at its first place."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(raw, F.array().cast("array<string>")), lambda x: symbol(x, quote)), lambda x: x.isNotNull()))


def symbol_map(raw: Column, quote: str) -> Column:
    """Sorted (symbol, base asset) of the valid entries of a map."""
    entries = F.transform(F.coalesce(F.map_entries(raw), F.array().cast("array<struct<key:string,value:string>>")), lambda x: F.struct(symbol(x["key"], quote).alias("key"), F.upper(stripped(x["value"])).alias("value")))
    return F.array_sort(F.filter(entries, lambda x: x["key"].isNotNull() & (F.coalesce(x["value"], F.lit("")) != "")))


def iso_date(raw: Column) -> Column:
    """The date of a text's first ten characters; null if it is none."""
    return F.try_to_date(F.substring(stripped(raw), 1, 10))


def subset(inner: Column, outer: Column) -> Column:
    """Whether every symbol of a list is in the other."""
    return F.size(F.array_except(inner, outer)) == 0


def selected_by_rank(ranking: DataFrame, quote: str = "USDT") -> DataFrame:
    """Q11 and what Q10 asks of a ranking, by release.

    release, n_rows, dates, ranked (symbols), bad_ranked, twice_ranked; n_selected, selected (set), by_rank (in order; empty where a rank is no number), no_number and
    equal_ranks (counts of selected rows).
    """
    text = F.lower(stripped(F.col("selected_flag").cast("string")))
    rows = ranking.select(
        "release", stripped("as_of_date").alias("day"), F.upper(stripped("symbol")).alias("name"), symbol(F.col("symbol"), quote).alias("symbol"), F.col("current_rank").try_cast("double").alias("rank"), F.coalesce(text.isin(*TRUE_WORDS), F.lit(False)).alias("on")
    )
    mine = lambda c: F.when(F.col("on"), c)
    agg = rows.groupBy("release").agg(
        F.count("*").alias("n_rows"),
        F.collect_set("day").alias("dates"),
        F.collect_set("symbol").alias("ranked"),
        F.count_if(F.col("symbol").isNull()).alias("bad_ranked"),
        (F.count("symbol") - F.countDistinct("symbol")).alias("twice_ranked"),
        F.count_if("on").alias("n_selected"),
        F.collect_set(mine(F.col("symbol"))).alias("selected"),
        F.count_if(F.col("on") & F.col("rank").isNull()).alias("no_number"),
        (F.count(mine(F.col("rank"))) - F.countDistinct(mine(F.col("rank")))).alias("equal_ranks"),
        F.array_sort(F.collect_list(mine(F.struct("rank", "name")))).alias("placed"),
    )
    return agg.withColumn("by_rank", F.when(F.col("no_number") > 0, F.array().cast("array<string>")).otherwise(F.col("placed.name"))).drop("placed")


def _declared(name: str, raw: Column, n: Column, known: Column) -> list[tuple[str, Column]]:
    size = raw.try_cast("long")
    return [(f"{name}pool_size_no_integer", size.isNull()), (f"{name}pool_size_not_positive", true(size <= 0)), (f"{name}pool_size_differs", known & true((size > 0) & (size != n)))]


def validate(releases: DataFrame, ranking: DataFrame, reference_date, max_age_days: int | None = None, fresh: bool = False, expected: dict | None = None, summary: DataFrame | None = None, quote: str = "USDT") -> DataFrame:
    """Q10a to Q10k: release, check, severity ('error' or 'warning').

    `expected`: mode, source_project and pool_size that every release must have. `summary`: release and the published fields
    symbols, symbol_map, version, mode, as_of_date, pool_size, source_project; releases without one are not held against it.
    """
    col, text = F.col, lambda c: stripped(F.coalesce(c, F.lit("")))
    some = lambda c: F.size(c) > 0
    rows = releases.join(selected_by_rank(ranking, quote), "release", "left")
    rows = rows.withColumns(
        {
            "u": symbol_list(col("universe_symbols"), quote), "p": symbol_list(col("symbols"), quote), "pm": symbol_map(col("symbol_map"), quote),
            "lm": symbol_map(col("legacy_symbols"), quote), "lsm": symbol_map(col("legacy_symbol_map"), quote),
            "d": iso_date(col("as_of_date")), "ld": iso_date(col("legacy_as_of_date")), "ud": iso_date(col("universe_as_of_date")),
        }
    )
    if summary is not None:
        rows = rows.join(summary.select("release", F.lit(True).alias("told"), *(col(c).alias(f"s_{c}") for c in FIELDS)), "release", "left")
    p, pm, lm = col("p"), col("pm"), col("lm")
    keys = lambda m: F.array_sort(m["key"])
    checks: list[tuple[str, Column]] = []
    for form in ("", "legacy_"):
        checks += [(f"missing_{form}{f}", col(form + f).isNull()) for f in FIELDS]  # Q10a
        checks += [(f"empty_{form}{f}", text(col(form + f)) == "") for f in ("mode", "version", "source_project")]
    for name, raw, clean in (("universe_symbols", "universe_symbols", "u"), ("symbols", "symbols", "p")):  # Q10b
        valid = F.filter(F.transform(col(raw), lambda x: symbol(x, quote)), lambda x: x.isNotNull())
        checks += [(f"empty_{name}", F.coalesce(F.size(raw) <= 0, F.lit(True))), (f"invalid_in_{name}", true(F.size(raw) > F.size(valid))), (f"duplicate_in_{name}", true(F.size(valid) > F.size(clean)))]
    for raw, clean in (("symbol_map", "pm"), ("legacy_symbols", "lm"), ("legacy_symbol_map", "lsm")):
        checks += [(f"empty_map_{raw}", F.coalesce(F.size(raw) <= 0, F.lit(True))), (f"invalid_in_{raw}", true(F.size(raw) > F.size(clean)))]
    checks += [  # Q10c
        ("symbols_differ_from_symbol_map", some(p) & some(pm) & (F.array_sort(p) != keys(pm))),
        ("legacy_maps_differ", some(lm) & some(col("lsm")) & (lm != col("lsm"))),
        ("legacy_symbols_differ", some(p) & some(lm) & (F.array_sort(p) != keys(lm))),
    ]
    checks += _declared("", col("pool_size"), F.size(p), some(p)) + _declared("legacy_", col("legacy_pool_size"), F.size(lm), some(lm))  # Q10d
    checks += [("pool_not_in_universe", some(col("u")) & some(p) & ~subset(p, col("u")))]  # Q10h, J12
    for form, day in (("", "d"), ("legacy_", "ld")):  # Q10e
        checks.append((f"{form}version_not_date_and_mode", true((text(col(form + "version")) != "") & (text(col(form + "mode")) != "") & (text(col(form + "version")) != F.concat_ws("-", col(day).cast("string"), text(col(form + "mode"))))) & col(day).isNotNull()))
    day_text = [col(c).cast("string") for c in ("d", "ld", "ud")] + ([iso_date(col("s_as_of_date")).cast("string")] if summary is not None else [])
    days = F.array_distinct(F.concat(F.filter(F.array(*day_text), lambda x: x.isNotNull()), F.coalesce("dates", F.array().cast("array<string>"))))
    checks += [(f"invalid_{n}", col(c).isNull()) for n, c in (("as_of_date", "d"), ("legacy_as_of_date", "ld"), ("universe_as_of_date", "ud"))]  # Q10f
    checks += [("as_of_dates_differ", F.size(days) > 1), ("ranking_not_of_one_date", true((col("n_rows") > 0) & (F.size("dates") != 1)))]
    for f in ("mode", "version", "source_project"):  # Q10g
        mine, theirs = text(col(f)), text(col(f"legacy_{f}"))
        checks.append((f"legacy_{f}_differs", (mine != "") & (theirs != "") & (mine != theirs)))
    for f, value in (expected or {}).items():
        mine = text(col(f))
        checks.append((f"unexpected_{f}", (mine != "") & (mine != F.lit(str(value))) if f != "pool_size" else true(col(f).try_cast("long") != int(value))))
    n = F.coalesce("n_rows", F.lit(0))
    ranked = n > 0
    checks += [  # Q10b, Q10h, Q10i, Q11
        ("no_ranking", ~ranked), ("invalid_in_ranking", ranked & (col("bad_ranked") > 0)), ("duplicate_in_ranking", ranked & (col("twice_ranked") > 0)),
        ("none_selected", ranked & (F.size("selected") == 0)), ("rank_no_number", ranked & (col("no_number") > 0)), ("equal_ranks", ranked & (col("no_number") == 0) & (col("equal_ranks") > 0)),
        ("pool_not_ranked", ranked & some(p) & ~subset(p, col("ranked"))), ("pool_not_selected", ranked & some(p) & ~subset(p, col("selected"))),
        ("selected_count_differs", ranked & some(p) & (col("n_selected") != F.size(p))),
        ("pool_not_in_rank_order", ranked & some(p) & some(col("by_rank")) & (p != F.slice("by_rank", 1, F.greatest(F.size(p), F.lit(1))))),
    ]
    if summary is not None:  # Q10j
        told = F.coalesce("told", F.lit(False))
        checks += [("summary_symbols_differ", told & ~col("s_symbols").eqNullSafe(p)), ("summary_symbol_map_differs", told & (symbol_map(col("s_symbol_map"), quote) != col("lsm")))]
        checks += [(f"summary_{f}_differs", told & (text(col(f"s_{f}")) != text(col(f)))) for f in ("version", "mode", "source_project")]
        checks += [("summary_as_of_date_differs", told & ~iso_date(col("s_as_of_date")).eqNullSafe(col("d"))), ("summary_pool_size_differs", told & (F.coalesce(col("s_pool_size").try_cast("long"), F.lit(-1)) != F.size(p)))]
    age = F.datediff(reference_date, "d")  # Q10k
    checks.append(("as_of_date_in_future", true(age < 0)))
    found = [F.when(c, F.struct(F.lit(name).alias("check"), F.lit("error").alias("severity"))) for name, c in checks]
    if max_age_days is not None:
        found.append(F.when(true(age > max_age_days), F.struct(F.lit("stale").alias("check"), F.lit("error" if fresh else "warning").alias("severity"))))
    return rows.select("release", F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


def status(releases: DataFrame, ranking: DataFrame, report: DataFrame, preview: int = 5, quote: str = "USDT") -> DataFrame:
    """Q12: release, n_symbols, n_ranked, n_selected, errors, warnings, status ('error', 'warning' or 'ok'), preview (by rank, nulls last)."""
    counts = report.groupBy("release").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    rank = F.col("current_rank").try_cast("double")
    first = ranking.groupBy("release").agg(F.slice(F.array_sort(F.collect_list(F.struct(rank.isNull().alias("none"), rank.alias("rank"), F.upper(stripped("symbol")).alias("symbol")))), 1, preview)["symbol"].alias("top"))
    out = releases.select("release", F.size(symbol_list(F.col("symbols"), quote)).alias("n_symbols")).join(selected_by_rank(ranking, quote).select("release", "n_rows", "n_selected"), "release", "left").join(first, "release", "left").join(counts, "release", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    named = F.when(zero("errors") > 0, "error").when(zero("warnings") > 0, "warning").otherwise("ok")
    return out.select("release", "n_symbols", zero("n_rows").alias("n_ranked"), zero("n_selected").alias("n_selected"), zero("errors").alias("errors"), zero("warnings").alias("warnings"), named.alias("status"), F.concat_ws("|", "top").alias("preview"))


def consistency(tables: dict[str, DataFrame], max_lag_days: int, pool_size: int | None = None) -> DataFrame:
    """Q13: release, warning: dates, versions and pool sizes that differ between outputs, and outputs that lag behind the newest.

    Each table: release, as_of_date (date), version, pool_size; the key names the output. Each warning comes once.
    """
    every = reduce(DataFrame.unionByName, [t.select("release", "as_of_date", "version", F.col("pool_size").try_cast("long").alias("pool_size"), F.lit(name).alias("output")) for name, t in tables.items()])
    agg = every.groupBy("release").agg(
        F.countDistinct("as_of_date").alias("dates"), F.countDistinct("version").alias("versions"), F.countDistinct("pool_size").alias("sizes"), F.max("as_of_date").alias("newest"), F.min("as_of_date").alias("oldest"),
        F.count("*").alias("n"), F.max("pool_size").alias("size"),
    )
    tests = {
        "output_missing": F.col("n") < len(tables), "as_of_dates_differ": F.col("dates") > 1, "versions_differ": F.col("versions") > 1, "pool_sizes_differ": F.col("sizes") > 1,
        "output_lags": true(F.datediff("newest", "oldest") > max_lag_days), "pool_size_unexpected": F.lit(False) if pool_size is None else true(F.col("size") != pool_size),
    }
    return agg.select("release", F.explode(F.filter(F.array(*(F.when(c, name) for name, c in tests.items())), lambda x: x.isNotNull())).alias("warning"))
