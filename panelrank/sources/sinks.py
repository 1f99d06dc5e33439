"""Sinks (K1 to K8): the payloads of a release as tables, and where they are written. Lists are sorted before they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.operators import review
from panelrank.operators.scores import ranking_order
from panelrank.sources import published

#: The columns of the ranking file.
RANKING = ("as_of_date", "symbol", "rule_score", "linear_score", "ml_score", "final_score", "regime", "confidence", "selected_flag", "current_rank")


def universe_payload(panel: DataFrame, as_of: Column) -> DataFrame:
    """K1: as_of_date, symbols: one row with the members of a date, sorted."""
    rows = panel.where(F.col("date") == as_of)
    return rows.agg(F.date_format(F.max("date"), "yyyy-MM-dd").alias("as_of_date"), F.sort_array(F.collect_list(F.when(F.col("in_universe"), F.col("symbol")))).alias("symbols"))


def ranking_table(panel: DataFrame, as_of: Column) -> DataFrame:
    """K2: members and selected symbols of a date with whole ranks, in ranking order."""
    rows = panel.where((F.col("date") == as_of) & (F.col("in_universe") | F.col("selected_flag")))
    rows = rows.withColumns({"as_of_date": F.date_format("date", "yyyy-MM-dd"), "current_rank": F.col("current_rank").cast("int")})
    return rows.orderBy(*ranking_order()).select(*RANKING)


def pool_payload(panel: DataFrame, metadata: DataFrame, pool_size: int, mode: str, source_project: str, meta_fields: tuple[str, ...] = ()) -> DataFrame:
    """K3: a row per date: as_of_date, version, mode, pool_size, symbols in ranking order, symbol_map, source_project, and
    selection_meta: by symbol the fields that have a value. The legacy form has `symbol_map` as its symbols."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("date").orderBy(*ranking_order()))
    top = panel.where(F.col("in_universe") & F.col("final_score").isNotNull()).withColumn("place", place).where(F.col("place") <= pool_size)
    named = top.join(metadata.select("symbol", "base_asset"), "symbol", "left")
    fields = [f for f in meta_fields if f in panel.columns]
    meta = F.to_json(F.struct(*fields)) if fields else F.lit("{}")  # nulls are left out
    rows = named.groupBy("date").agg(F.array_sort(F.collect_list(F.struct("place", "symbol", "base_asset", meta.alias("meta")))).alias("x"))
    entries = lambda value, test: F.map_from_entries(F.transform(F.filter("x", test), lambda e: F.struct(e["symbol"], value(e))))
    day = F.date_format("date", "yyyy-MM-dd")
    return rows.select(
        day.alias("as_of_date"), F.concat_ws("-", day, F.lit(mode)).alias("version"), F.lit(mode).alias("mode"), F.size("x").alias("pool_size"), F.col("x.symbol").alias("symbols"),
        entries(lambda e: e["base_asset"], lambda e: e["base_asset"].isNotNull()).alias("symbol_map"), F.lit(source_project).alias("source_project"), entries(lambda e: e["meta"], lambda e: e["meta"] != "{}").alias("selection_meta"),
    )


def legacy_payload(payload: DataFrame) -> DataFrame:
    """K3: the legacy form of a pool: its symbols are the map from symbol to base asset; what else it says is the same."""
    return payload.withColumn("symbols", F.col("symbol_map"))


def payload_pairs(payload: DataFrame) -> DataFrame:
    """K3: version, as_of_date, form ('list' or 'legacy'), payload: both forms of each pool as JSON, without null fields."""
    fields = ("as_of_date", "version", "mode", "pool_size", "symbols", "symbol_map", "source_project")
    form = lambda df, name, *more: df.select("version", "as_of_date", F.lit(name).alias("form"), F.to_json(F.struct(*fields, *more)).alias("payload"))
    meta = F.when(F.size("selection_meta") > 0, F.col("selection_meta")).alias("selection_meta")
    return form(payload, "list", meta).unionByName(form(legacy_payload(payload), "legacy"))


def pair_checks(pairs: DataFrame) -> DataFrame:
    """check, ok: whether each version has one payload of either form, of one date, and both hold as many symbols as they say."""
    said = F.get_json_object("payload", "$.pool_size").cast("int")
    listed = F.from_json(F.get_json_object("payload", "$.symbols"), "array<string>")
    mapped = F.from_json(F.get_json_object("payload", "$.symbol_map"), "map<string,string>")
    size = F.when(F.col("form") == "list", F.size(listed)).otherwise(F.size(mapped))
    per = pairs.groupBy("version").agg(F.count("*").alias("n"), F.countDistinct("form").alias("forms"), F.countDistinct("as_of_date").alias("dates"), F.min(F.coalesce(size == said, F.lit(False))).alias("sized"))
    tests = {"both_forms": (F.col("n") == 2) & (F.col("forms") == 2), "one_date": F.col("dates") == 1, "sizes": F.col("sized")}
    return per.agg(*(F.coalesce(F.min(t), F.lit(True)).alias(n) for n, t in tests.items())).select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("ok")) for n in tests))))


def publish_pools(payload: DataFrame, path: str, version: str) -> DataFrame:
    """K3, K4: the pairs of all pools as one published version, by year; a version that fails its checks is not published."""
    pairs = payload_pairs(payload).withColumn("year", F.substring("as_of_date", 1, 4))
    return published.release(pairs, path, version, "year", pair_checks)


def publish_lifecycle(panel: DataFrame, path: str, version: str, today: Column, references: tuple[str, ...], **limits) -> DataFrame:
    """K6: the panel for the lifecycle, by year, published only if what was written passes the readiness checks (Q14). Gives the checks."""
    rows = lifecycle_panel(panel, today).withColumn("year", F.year("date"))
    return published.release(rows, path, version, "year", lambda back: review.lifecycle_report(back, today, references, **limits))


def lifecycle_panel(panel: DataFrame, today: Column, columns: tuple[str, ...] = ("date", "symbol", "in_universe", "final_score", "close")) -> DataFrame:
    """The columns that the lifecycle wants, up to yesterday."""
    return panel.where(F.col("date").isNotNull() & (F.col("date") < today)).select(*columns)


def write_json(payload: DataFrame, path: str) -> None:
    """K1, K3, K7: a payload of a row as one JSON file in a folder."""
    payload.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_csv(table: DataFrame, path: str, compressed: bool = False, single: bool = True) -> None:
    """K2, K5, K6, K8: a table with its header, gzipped on request; reports are one file, large tables keep their partitions."""
    out = (table.coalesce(1) if single else table).write.mode("overwrite").option("header", True)
    (out.option("compression", "gzip") if compressed else out).csv(path)


def write_releases(payloads: DataFrame, path: str) -> None:
    """K4: a release history, a folder per version, and the index of all versions beside it."""
    payloads.repartition("version").write.mode("overwrite").partitionBy("version").json(f"{path}/releases")
    index = payloads.select("as_of_date", "version", "mode", "pool_size", F.concat_ws("|", "symbols").alias("symbols"))
    write_csv(index.orderBy("as_of_date"), f"{path}/index")


def debug_snapshot(panel: DataFrame, as_of: Column, path: str) -> None:
    """K8: every column of one date."""
    write_csv(panel.where(F.col("date") == as_of), path)
