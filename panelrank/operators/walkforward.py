"""Walk-forward roles and summaries (J15, A5, A6, A12, A13) and linear models by window (M1, M4).

All windows are handled in one plan with `window_id` as a key. A window stands for its dates, so that rows meet it by date.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.functions.nulls import finite


def roles(panel: DataFrame, windows: DataFrame) -> DataFrame:
    """A row of the panel for each window it trains or tests, with window_id and role ('train', 'purged' or 'test')."""
    w = windows.select("window_id", "train_end", "effective_train_end", "test_start", F.explode(F.sequence("train_start", "test_end")).alias("date"))
    joined = panel.join(w, "date")
    role = F.when(F.col("date") <= F.col("effective_train_end"), "train").when(F.col("date") <= F.col("train_end"), "purged").otherwise("test")
    return joined.withColumn("role", role).drop("train_end", "effective_train_end")


def purged_by_label(rows: DataFrame) -> DataFrame:
    """Training rows whose label looks into the test window become 'purged'; needs label_end and test_start."""
    late = (F.col("role") == "train") & (F.col("label_end").isNull() | (F.col("label_end") >= F.col("test_start")))
    return rows.withColumn("role", F.when(late, "purged").otherwise(F.col("role")))


def window_summary(rows: DataFrame, min_train_rows: int) -> DataFrame:
    """Rows and dates by window, its status, and whether it belongs to the warm-up before the first fit window."""
    is_ = lambda r: F.col("role") == r
    agg = rows.groupBy("window_id").agg(
        F.count_if(is_("train") | is_("purged")).alias("rows_before_purge"), F.count_if(is_("train")).alias("train_rows"),
        F.countDistinct(F.when(is_("train"), F.col("date"))).alias("train_dates"), F.count_if(is_("test")).alias("test_rows"),
    ).withColumn("status", F.when(F.col("train_rows") >= min_train_rows, "fit").otherwise("insufficient_data"))
    first = agg.agg(F.min(F.when(F.col("status") == "fit", F.col("window_id"))).alias("first"))
    return agg.join(first).withColumn("warm_up", F.coalesce(F.col("window_id") < F.col("first"), F.lit(False))).drop("first")


def aggregate_predictions(predictions: DataFrame, columns: list[str], mode: str = "mean") -> DataFrame:
    """One row per date and symbol: the mean over windows, or the latest window's values and its id; and the number of windows."""
    n = F.countDistinct("window_id").alias("prediction_window_count")
    grouped = predictions.groupBy("date", "symbol")
    if mode == "mean":
        return grouped.agg(*(F.avg(c).alias(c) for c in columns), n)
    if mode == "latest":
        latest = F.max_by(F.struct("window_id", *columns), "window_id").alias("x")
        return grouped.agg(latest, n).select("date", "symbol", *(F.col(f"x.{c}").alias(c) for c in columns), F.col("x.window_id").alias("prediction_source_window_id"), "prediction_window_count")
    raise ValueError(f"unknown mode: {mode}")


def medians(rows: DataFrame, columns: list[str]) -> DataFrame:
    """M1: exact medians of the training rows by window; 0 where a column has no value."""
    return rows.where("role = 'train'").groupBy("window_id").agg(*(F.coalesce(F.median(finite(c)), F.lit(0.0)).alias(f"median_{c}") for c in columns))


def imputed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """M1: missing features take their window's training median."""
    filled = rows.join(medians(rows, columns), "window_id")
    return filled.withColumns({c: F.coalesce(finite(c), F.col(f"median_{c}")) for c in columns}).drop(*(f"median_{c}" for c in columns))


def gram_sums(rows: DataFrame, columns: list[str], target: str) -> DataFrame:
    """M4: window_id, i, j, s: sums of products of (1, features, target) over the training rows; position 0 is the constant."""
    terms = [F.lit(1.0), *(F.col(c).cast("double") for c in columns), F.col(target).cast("double")]
    at = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    train = rows.where((F.col("role") == "train") & F.col(target).isNotNull())
    wide = train.groupBy("window_id").agg(*(F.sum(terms[i] * terms[j]).alias(f"s_{i}_{j}") for i, j in at))
    each = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s_{i}_{j}").alias("s")) for i, j in at))
    return wide.select("window_id", F.inline(each))


def ridge(rows: DataFrame, columns: list[str], target: str, alpha: float = 2.0) -> DataFrame:
    """M4: window_id, term ('bias' or a feature), coefficient; the bias is not penalised. Only the sums reach the driver."""
    d = len(columns) + 2
    sums: dict[int, np.ndarray] = {}
    for r in gram_sums(rows, columns, target).collect():
        m = sums.setdefault(r["window_id"], np.zeros((d, d)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    penalty = alpha * np.eye(d - 1)
    penalty[0, 0] = 0
    out = [(w, name, float(x)) for w, m in sorted(sums.items()) for name, x in zip(["bias", *columns], np.linalg.solve(m[:-1, :-1] + penalty, m[:-1, -1]))]
    return rows.sparkSession.createDataFrame(out, "window_id int, term string, coefficient double")


def predict(rows: DataFrame, coefficients: DataFrame, columns: list[str], out: str) -> DataFrame:
    """Test rows with the window's linear score; windows without coefficients give null."""
    wide = coefficients.groupBy("window_id").pivot("term", ["bias", *columns]).agg(F.first("coefficient"))
    wide = wide.select("window_id", *(F.col(c).alias(f"_b_{c}") for c in ["bias", *columns]))
    joined = rows.where("role = 'test'").join(wide, "window_id", "left")
    return joined.withColumn(out, sum((F.col(c) * F.col(f"_b_{c}") for c in columns), F.col("_b_bias"))).drop(*(f"_b_{c}" for c in ["bias", *columns]))
