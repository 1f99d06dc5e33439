"""Models (M2, M3, M5 to M7, M10, M11) on MLlib, and the join of their predictions.

A model is fitted on the training rows of one window; Spark trains on the executors and scores by a join-free transform.
Features are imputed by the training rows' exact medians (M1). Standardisation happens inside the linear fits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.functions.nulls import finite
from panelrank.functions.tables import stored
from panelrank.operators.calendar import calendar

#: Penalties of the linear models, and the shape of the trees.
ALPHA, L1_RATIO = {"ridge": 2.0, "elasticnet": 0.0005}, 0.2
BOOSTED = {"maxIter": 300, "stepSize": 0.05, "subsamplingRate": 0.85, "featureSubsetStrategy": "0.75", "minInstancesPerNode": 30, "maxDepth": 5, "seed": 42}
FOREST = {"numTrees": 300, "maxDepth": 6, "minInstancesPerNode": 10, "seed": 42}


def _vectors(rows: DataFrame, medians: dict[str, float], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    names = [f"in_{c}" for c in medians]
    filled = rows.withColumns({f"in_{c}": F.coalesce(finite(F.col(c).cast("double")), F.lit(m)) for c, m in medians.items()})
    return VectorAssembler(inputCols=names, outputCol=out).transform(filled).drop(*names)


def train_medians(train: DataFrame, columns: list[str]) -> dict[str, float]:
    """M1: exact medians of one training set; 0 for a column without a value."""
    row = train.agg(*(F.coalesce(F.median(finite(F.col(c).cast("double"))), F.lit(0.0)).alias(c) for c in columns)).first()
    return row.asDict()


def linear(vectors: DataFrame, target: str, kind: str = "ridge", alpha: float | None = None, l1_ratio: float = L1_RATIO):
    """M2, M3: a fitted linear model on standardised features. `alpha` weighs the penalty as in the usual per-sum (ridge) and
    per-mean (elastic net) forms; MLlib's own parameters follow from it, the number of rows and the target's spread."""
    from pyspark.ml.regression import LinearRegression

    alpha = ALPHA[kind] if alpha is None else alpha
    n, spread = vectors.agg(F.count(target), F.stddev_pop(target)).first()
    spread = spread or 1.0
    if kind == "ridge":
        options = {"solver": "normal", "elasticNetParam": 0.0, "regParam": alpha / n * spread}
    elif kind == "elasticnet":
        penalty = alpha * (l1_ratio + (1 - l1_ratio) * spread)
        options = {"elasticNetParam": alpha * l1_ratio / penalty if penalty else 0.0, "regParam": penalty, "maxIter": 500, "tol": 1e-10}
    else:
        raise ValueError(f"unknown linear model: {kind}")
    return LinearRegression(featuresCol="features", labelCol=target, predictionCol="prediction", standardization=True, **options).fit(vectors)


def trees(vectors: DataFrame, target: str, kind: str = "boosted", **options):
    """M5, M6: boosted trees or a random forest; the same capability as other libraries', not equal to the bit."""
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    if kind not in ("boosted", "forest"):
        raise ValueError(f"unknown tree model: {kind}")
    maker, defaults = (GBTRegressor, BOOSTED) if kind == "boosted" else (RandomForestRegressor, FOREST)
    return maker(featuresCol="features", labelCol=target, predictionCol="prediction", **{**defaults, **options}).fit(vectors)


def fit_predict(train: DataFrame, score: DataFrame, columns: list[str], target: str, linear_kind: str = "ridge", tree_kind: str | None = "boosted", min_rows: int = 300, production: bool = False, **tree_options) -> DataFrame:
    """M7: the rows of `score` with linear_score_raw and ml_score_raw. With fewer than `min_rows` usable rows production raises an
    error and research gets nulls. Without a tree model its score is null."""
    usable = train.where(finite(F.col(target).cast("double")).isNotNull())
    n = usable.count()
    empty = F.lit(None).cast("double")
    if n < max(min_rows, 1):
        if production:
            raise ValueError(f"{n} training rows, {min_rows} are needed")
        return score.withColumns({"linear_score_raw": empty, "ml_score_raw": empty})
    medians = train_medians(usable, columns)
    known, asked = _vectors(stored(usable, "training"), medians), _vectors(score, medians)
    out = linear(known, target, linear_kind).transform(asked).withColumnRenamed("prediction", "linear_score_raw")
    if tree_kind is None:
        out = out.withColumn("ml_score_raw", empty)
    else:
        out = trees(known, target, tree_kind, **tree_options).transform(out).withColumnRenamed("prediction", "ml_score_raw")
    return out.drop("features")


def scoring_date(panel: DataFrame):
    """The last date with members; an error if there is none."""
    last = panel.where("in_universe").agg(F.max("date")).first()[0]
    if last is None:
        raise ValueError("no admitted rows to score")
    return last


def live_window(panel: DataFrame, as_of, train_days: int = 720, max_horizon: int = 90) -> tuple[DataFrame, DataFrame]:
    """(training rows: the members of `train_days` dates that end `max_horizon` dates before `as_of`; members of `as_of`)."""
    days = calendar(panel.where(F.col("date") <= as_of))
    last = days.agg((F.max("pos") - max_horizon).alias("last"))
    wanted = days.join(last).where((F.col("pos") <= F.col("last")) & (F.col("pos") > F.col("last") - train_days)).select("date")
    members = panel.where("in_universe")
    return members.join(wanted, "date", "left_semi"), members.where(F.col("date") == as_of)


def merge_predictions(panel: DataFrame, predictions: DataFrame | None) -> DataFrame:
    """The panel with linear_score_raw, ml_score_raw and prediction_window_count; nulls and 0 where nothing was predicted."""
    names = ["linear_score_raw", "ml_score_raw"]
    if predictions is None:
        return panel.withColumns({**{n: F.lit(None).cast("double") for n in names}, "prediction_window_count": F.lit(0).cast("long")})
    made = predictions.select("date", "symbol", *names, "prediction_window_count")
    return panel.join(made, ["date", "symbol"], "left").withColumn("prediction_window_count", F.coalesce("prediction_window_count", F.lit(0)))
