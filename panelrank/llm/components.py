"""Connected components of a table of links, by Spark joins: no link or component reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.llm.common import stored


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """id, label: the least id reachable from each id that has a link.

    Every round gives each id the least label of its neighbours and itself, then the label of its label; both
    are written, so lost executors cost one round. The rounds are about the logarithm of the longest path.
    """
    pairs = links.select(F.col(left).alias("x"), F.col(right).alias("y"))
    edges = stored(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = stored(edges.groupBy("x").agg(F.least("x", F.min("y")).alias("label")).withColumnRenamed("x", "id"), "labels")
    while True:
        near = edges.join(labels, F.col("y") == F.col("id")).groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("id") == F.col("x")).select("id", "label", F.least("label", "near").alias("low"))
        step = stored(step, "step")
        up = step.select(F.col("id").alias("up"), F.col("low").alias("top"))
        jumped = step.join(up, F.col("low") == F.col("up"), "left").select("id", F.col("label").alias("was"), F.least("low", "top").alias("label"))
        jumped = stored(jumped, "labels")
        labels = jumped.select("id", "label")
        if not jumped.where("was <> label").head(1):
            return labels
