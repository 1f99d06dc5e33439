"""Walk-forward training of linear models for all windows in one job (M9 with M1 to M4, A5, A12, A13).

Training sets are sets of dates: a date trains a window if it lies in its purged span and no label of it looks into the test
(L6). Dates that train the same windows form a class; each row is summed once, into the sums of its class, and a window's sums
are those of its classes added up, so overlapping windows share the work. A task adds its rows to a matrix a class without moving
them; a window's model follows from one matrix of some 90 by 90 numbers, by a solve or by coordinate descent.

Missing features take the window's training median. The sums hold values with 0 for what is missing and, beside them, which are
missing, so the imputed sums follow from any medians without another pass. Values are shifted by their overall mean first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.functions.nulls import finite
from panelrank.functions.tables import stored

#: Penalties of ridge (standardised or not) and elastic net.
RIDGE_ALPHA, NET_ALPHA, NET_L1 = 2.0, 0.0005, 0.2
KINDS = ("ridge", "plain_ridge", "elasticnet")


def training_dates(dates: DataFrame, windows: DataFrame) -> DataFrame:
    """window_id, date, role, n, members: a row for each date of each window. dates: date, label_end, n (rows with a target), members.

    role: 'train', 'purged' (before the test, but not to train on) or 'test'.
    """
    spans = windows.select("window_id", "train_end", "effective_train_end", "test_start", F.explode(F.sequence("train_start", "test_end")).alias("date"))
    late = (F.col("date") > F.col("effective_train_end")) | ~F.coalesce(F.col("label_end") < F.col("test_start"), F.lit(False))
    role = F.when(F.col("date") > F.col("train_end"), "test").when(late, "purged").otherwise("train")
    return spans.join(dates, "date").select("window_id", "date", role.alias("role"), "n", "members")


def window_status(trained: DataFrame, windows: DataFrame, min_train_rows: int) -> DataFrame:
    """The windows with their rows and dates and a status: `warm_up` before the first window with enough rows,
    `insufficient_data` after it, else `fit`. If no window has enough, none is warm-up."""
    before, train = F.col("role") != "test", F.col("role") == "train"
    some = F.col("n") > 0
    sums = trained.groupBy("window_id").agg(
        *(F.coalesce(F.sum(F.when(test, F.col(c))), F.lit(0)).cast("long").alias(name) for test, c, name in ((before, "n", "train_rows_pre_purge"), (train, "n", "train_rows"), (~before, "members", "test_rows"))),
        F.count_if(before & some).alias("train_dates_pre_purge"), F.count_if(train & some).alias("train_dates"),
    )
    every = windows.join(sums, "window_id", "left").fillna(0, sums.columns[1:])
    first = every.agg(F.min(F.when(F.col("train_rows") >= min_train_rows, F.col("window_id"))).alias("first"))
    status = F.when(F.col("train_rows") >= min_train_rows, "fit").when(F.col("window_id") < F.col("first"), "warm_up").otherwise("insufficient_data")
    return every.join(first).withColumns({"purged_train_rows": F.col("train_rows_pre_purge") - F.col("train_rows"), "status": status}).drop("first")


def _names(columns: list[str]) -> list[Column]:
    return [finite(F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)]


def class_sums(rows: DataFrame, classes: DataFrame, columns: list[str], target: str, shift: list[float]) -> DataFrame:
    """cls, sums (the matrix of (1, values, missing, target), by rows) of each class. classes: date, cls.

    Each task gives one matrix a class it met; those of a class are added up as they stream into one task.
    """
    names = [f"x{i}" for i in range(len(columns))]
    given = rows.join(classes, "date").select("cls", F.col(target).cast("double").alias("y"), *_names(columns))
    mean = np.array(shift)

    def gram(batches):
        sums: dict = {}
        for batch in batches:
            x = batch[names].to_numpy(float)
            lost = np.isnan(x)
            z = np.hstack([np.ones((len(x), 1)), np.where(lost, 0.0, x - mean), lost.astype(float), batch[["y"]].to_numpy(float)])
            for cls, at in batch.groupby("cls").indices.items():
                sums[cls] = sums.get(cls, 0) + z[at].T @ z[at]
        if sums:
            yield pd.DataFrame({"cls": list(sums), "sums": [s.ravel() for s in sums.values()]})

    return _added(given.mapInPandas(gram, "cls string, sums array<double>"), "cls", "string")


def _added(parts: DataFrame, key: str, kind: str) -> DataFrame:
    """The sums of each key; a task holds one matrix for each key it has."""

    def add(batches):
        sums: dict = {}
        for batch in batches:
            for k, s in zip(batch[key], batch["sums"]):
                sums[k] = sums.get(k, 0) + np.asarray(s)
        if sums:
            yield pd.DataFrame({key: list(sums), "sums": list(sums.values())})

    return parts.select(key, "sums").repartition(key).mapInPandas(add, f"{key} {kind}, sums array<double>")


def imputed(sums: np.ndarray, medians: np.ndarray) -> np.ndarray:
    """Sums of products of (1, features, target) with the missing at their medians, from those with both apart."""
    d = len(medians)
    s = np.asarray(sums, float).reshape(2 * d + 2, 2 * d + 2)
    t = np.zeros((2 * d + 2, d + 2))
    t[0, 0] = t[-1, -1] = 1
    t[1 : d + 1, 1 : d + 1] = np.eye(d)
    t[d + 1 : 2 * d + 1, 1 : d + 1] = np.diag(medians)
    return t.T @ s @ t


def solve(g: np.ndarray, kind: str, alpha: float | None = None, l1_ratio: float = NET_L1, sweeps: int = 20_000, tolerance: float = 1e-12) -> np.ndarray:
    """(constant, coefficients) from sums of (1, features, target). `ridge` and `elasticnet` standardise the features; a constant
    feature has coefficient 0. `plain_ridge` does not. The constant is never penalised."""
    n, d = g[0, 0], len(g) - 2
    mean, y = g[0, 1:-1] / n, g[0, -1] / n
    c, r = g[1:-1, 1:-1] - n * np.outer(mean, mean), g[1:-1, -1] - n * mean * y
    var = np.diag(c) / n
    flat = var <= 1e-14 * (np.diag(g)[1:-1] / n + 1e-300)
    if kind == "plain_ridge":
        b = np.linalg.solve(c + (RIDGE_ALPHA if alpha is None else alpha) * np.eye(d), r)
    else:
        s = np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, var)))
        c, r = np.where(flat[:, None] | flat[None, :], 0.0, c / np.outer(s, s)), np.where(flat, 0.0, r / s)
        if kind == "ridge":
            b = np.linalg.solve(c + (RIDGE_ALPHA if alpha is None else alpha) * np.eye(d), r) / s
        elif kind == "elasticnet":
            a = NET_ALPHA if alpha is None else alpha
            q, p, b = c / n, r / n, np.zeros(d)
            for _ in range(sweeps):
                moved = 0.0
                for k in range(d):
                    x = p[k] - q[k] @ b + q[k, k] * b[k]
                    new = np.sign(x) * max(abs(x) - a * l1_ratio, 0.0) / (q[k, k] + a * (1 - l1_ratio)) if q[k, k] or a else 0.0
                    moved, b[k] = max(moved, abs(new - b[k])), new
                if moved <= tolerance:
                    break
            b = b / s
        else:
            raise ValueError(f"unknown linear model: {kind}")
    return np.concatenate([[y - mean @ b], b])


def train(panel: DataFrame, windows: DataFrame, label_ends: DataFrame, columns: list[str], target: str, min_train_rows: int = 300, kinds: tuple[str, ...] = ("ridge",), **options) -> tuple[DataFrame, DataFrame]:
    """M9: (window_id, kind, train_rows, bias, coefficients, medians by feature; the windows with status). Only windows that are
    `fit` have models. panel: date, in_universe, the target and the features; label_ends: date, label_end (L6)."""
    members = panel.where("in_universe")
    able = F.col(target).isNotNull()
    counted = members.groupBy("date").agg(F.count_if(able).cast("long").alias("n"), F.count("*").alias("members"))
    dates = stored(counted.join(label_ends, "date", "left"), "window_dates")
    trained = stored(training_dates(dates, windows), "training_dates")
    status = stored(window_status(trained, windows, min_train_rows), "window_status")
    used = trained.where("role = 'train' and n > 0").join(status.where("status = 'fit'").select("window_id"), "window_id")
    classes = stored(used.groupBy("date").agg(F.sort_array(F.collect_set("window_id")).alias("ids")).select("date", "ids", F.concat_ws(",", F.transform("ids", lambda i: i.cast("string"))).alias("cls")), "classes")
    rows = members.where(able)
    facts = rows.join(classes.select("date"), "date").select(*_names(columns)).agg(*(F.coalesce(F.avg(f"x{i}"), F.lit(0.0)).alias(f"m{i}") for i in range(len(columns))), *(F.count_if(F.col(f"x{i}").isNull()).alias(f"n{i}") for i in range(len(columns)))).first()
    shift = [facts[f"m{i}"] for i in range(len(columns))]
    sums = class_sums(rows, classes.select("date", "cls"), columns, target, shift)
    each = sums.join(classes.select("cls", "ids").distinct(), "cls").select(F.explode("ids").alias("window_id"), "sums")
    medians = _medians(members, status, rows, classes, columns)
    met = _added(each, "window_id", "int").join(medians, "window_id", "left")
    mean, spec = np.array(shift), dict(options)

    def fit(batches):
        for batch in batches:
            out = []
            for window, total, known in zip(batch["window_id"], batch["sums"], batch["medians"]):
                middle = np.array([np.nan if v is None else v for v in known], float) if known is not None else np.full(len(mean), np.nan)
                middle = np.where(np.isnan(middle), 0.0, middle)  # a feature without missing values does not use it
                g = imputed(total, middle - mean)
                for kind in kinds:
                    b = solve(g, kind, **spec)
                    out.append((window, kind, int(round(g[0, 0])), b[0] - float(mean @ b[1:]), b[1:].tolist(), middle.tolist()))
            yield pd.DataFrame(out, columns=["window_id", "kind", "train_rows", "bias", "coefficients", "medians"])

    made = met.mapInPandas(fit, "window_id int, kind string, train_rows long, bias double, coefficients array<double>, medians array<double>")
    return stored(made, "window_models"), status


def _medians(members: DataFrame, status: DataFrame, rows: DataFrame, classes: DataFrame, columns: list[str]) -> DataFrame:
    """M1: window_id, medians: exact medians of the training rows for features that any member lacks, null for the others.

    Only those features meet all windows of their date; a feature without a value in a window has 0.
    """
    lacks = members.select(*_names(columns)).agg(*(F.max(F.col(f"x{i}").isNull()).alias(f"x{i}") for i in range(len(columns)))).first()
    asked = [i for i in range(len(columns)) if lacks[f"x{i}"]]
    ids = status.where("status = 'fit'").select("window_id")
    if not asked:
        return ids.withColumn("medians", F.lit(None).cast("array<double>"))
    all_names = _names(columns)
    tagged = rows.join(classes.select("date", "ids"), "date").select(F.explode("ids").alias("window_id"), *(all_names[i] for i in asked))
    found = tagged.groupBy("window_id").agg(*(F.coalesce(F.median(f"x{i}"), F.lit(0.0)).alias(f"x{i}") for i in asked))
    listed = F.array(*(F.col(f"x{i}") if i in asked else F.lit(None).cast("double") for i in range(len(columns))))
    return ids.join(found, "window_id").select("window_id", listed.alias("medians"))


def predict(panel: DataFrame, windows: DataFrame, models: DataFrame, columns: list[str]) -> DataFrame:
    """date, symbol, window_id, kind, score: members of the test dates scored by each window that tests them."""
    tests = windows.select("window_id", F.explode(F.sequence("test_start", "test_end")).alias("date")).join(models.select("window_id", "kind", "bias", "coefficients", "medians"), "window_id")
    values = F.array(*(finite(F.col(c).cast("double")) for c in columns))
    asked = panel.where("in_universe").select("date", "symbol", values.alias("x")).join(tests, "date")
    filled = F.zip_with("x", "medians", lambda x, m: F.coalesce(x, m))
    score = F.aggregate(F.zip_with(filled, "coefficients", lambda x, b: x * b), F.col("bias"), lambda a, v: a + v)
    return asked.select("date", "symbol", "window_id", "kind", score.alias("score"))


def out_of_sample(predictions: DataFrame, kinds: dict[str, str], mode: str = "mean") -> DataFrame:
    """Date, symbol, a score column for each kind (`kinds`: kind to column), prediction_window_count.

    The mean over a row's windows or, with `latest`, the score of the last of them.
    """
    picked = lambda kind: F.when(F.col("kind") == kind, F.col("score"))
    if mode == "mean":
        made = [F.avg(picked(kind)).alias(name) for kind, name in kinds.items()]
    elif mode == "latest":
        made = [F.max_by(picked(kind), F.when(F.col("kind") == kind, F.col("window_id"))).alias(name) for kind, name in kinds.items()]
    else:
        raise ValueError(f"unknown mode: {mode}")
    return predictions.groupBy("date", "symbol").agg(*made, F.countDistinct("window_id").alias("prediction_window_count"))
