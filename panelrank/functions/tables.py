"""Tables written between steps: they cut the plan, so that later steps read a result instead of deriving it again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. Where it is unset, a local session gets a new one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not where:
        where = getattr(spark, "_panelrank_scratch", None) or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark._panelrank_scratch = where
    return where.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._panelrank_path = path
    return back


def path_of(spark: SparkSession, path: str):
    """Hadoop's path and the file system that it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; one call, no file is opened."""
    where, fs = path_of(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a table that `stored` made, once nothing reads it any more."""
    known = getattr(df, "_panelrank_path", None)
    for name in [known] if known else {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path, fs = path_of(spark, name)
        fs.delete(path, True)
