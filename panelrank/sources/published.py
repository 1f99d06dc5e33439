"""Tables that are published in versions: what readers see changes only by one rename, after all rows are written.

A version stages the partitions that it replaces (`data/v=<version>/<by>=...`). Publishing it adds a log entry that names, for each
partition, the version that holds it; entries are written aside and renamed. Readers take the files that the newest
entry names, so a job that dies leaves the published table as it was, and a version that is published twice changes nothing.
The log holds a name for each partition and passes through the driver; rows never do.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrank.functions.tables import names, path_of
from panelrank.operators.review import fingerprint


def _entry(spark: SparkSession, path: str, name: str) -> dict:
    return json.loads("".join(r["value"] for r in spark.read.text(f"{path}/log/{name}").collect()))


def _log(spark: SparkSession, path: str) -> list[str]:
    return [n for n in names(spark, f"{path}/log") if n.endswith(".json")]


def state(spark: SparkSession, path: str) -> dict:
    """The newest log entry: seq, version, versions (all that were published), parts, schema and fingerprint; empty at first."""
    log = _log(spark, path)
    return _entry(spark, path, log[-1]) if log else {"seq": -1, "version": None, "versions": [], "parts": {}, "schema": None, "fingerprint": None}


def stage(df: DataFrame, path: str, version: str, by: str) -> DataFrame:
    """Writes the partitions that `df` has as a version nobody reads yet, and reads them back. Staging again replaces it."""
    where = f"{path}/data/v={version}"
    df.repartition(by).write.mode("overwrite").partitionBy(by).parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where).select(*df.columns)


def publish(spark: SparkSession, path: str, version: str, by: str, schema: str, whole: bool = False, content: dict | None = None) -> bool:
    """Makes a staged version's partitions the published ones; with `whole` no other partition stays. False if it was published before."""
    now = state(spark, path)
    if version in now["versions"]:
        return False
    mine = {n: version for n in names(spark, f"{path}/data/v={version}") if n.startswith(f"{by}=")}
    parts = mine if whole else {**now["parts"], **mine}
    entry = {"seq": now["seq"] + 1, "version": version, "versions": [*now["versions"], version], "parts": parts, "schema": schema, "fingerprint": content}
    name = f"{entry['seq']:010d}.json"
    aside, fs = path_of(spark, f"{path}/log/_{name}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if not fs.rename(aside, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log/{name}")):
        raise RuntimeError(f"another writer published {name} first")
    return True


def current(spark: SparkSession, path: str, parts: list[str] | None = None) -> DataFrame | None:
    """The published table, or those of its partitions that `parts` names; None before the first version."""
    now = state(spark, path)
    if now["schema"] is None:
        return None
    chosen = [f"{path}/data/v={v}/{p}" for p, v in sorted(now["parts"].items()) if parts is None or p in parts]
    if not chosen:
        return spark.createDataFrame([], now["schema"])
    found = spark.read.option("basePath", f"{path}/data").schema(now["schema"] + ", v string").parquet(*chosen)
    return found.drop("v")


def release(df: DataFrame, path: str, version: str, by: str, checks: Callable[[DataFrame], DataFrame] | None = None, whole: bool = True) -> DataFrame:
    """K3, K4, K6: stages a version, checks what was written and publishes it only if no check fails. Gives the checks.

    `checks` takes the table read back and gives rows with `check` and `ok`; no row, or none that is false, passes. The
    fingerprint of the version's rows (Q15) stands in the log.
    """
    spark = df.sparkSession
    back = stage(df, path, version, by)
    found = checks(back) if checks else spark.createDataFrame([], "check string, ok boolean")
    rows = found.collect()  # a row a check
    if all(r["ok"] for r in rows):
        content = fingerprint(back, back.columns).first().asDict()
        publish(spark, path, version, by, _ddl(back), whole, content)
    return spark.createDataFrame(rows, found.schema)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def upsert_into(rows: DataFrame, path: str, version: str, keys: list[str], by: str, newest: list) -> bool:
    """S8 into a published table: of each key the first row by `newest`, among those published and `rows`; only the partitions
    that `rows` touches are read and written. The same version again does nothing, the same rows in another change nothing.
    """
    from pyspark.sql import Window

    spark = rows.sparkSession
    if version in state(spark, path)["versions"]:
        return False
    touched = [r[0] for r in rows.select(F.col(by).cast("string")).distinct().collect()]  # names of partitions
    before = current(spark, path, [f"{by}={t}" for t in touched])
    both = rows if before is None else before.select(*rows.columns).unionByName(rows)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    kept = both.withColumn("_r", place).where("_r = 1").drop("_r")
    stage(kept, path, version, by)
    return publish(spark, path, version, by, _ddl(kept))
