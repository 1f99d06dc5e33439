"""Linear models against closed forms, trees and the training window on small tables."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelrank.operators import models

D = date(2024, 1, 1)
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 3, 1]
    y = x @ [0.5, -0.1, 2.0] + 0.3 * rng.normal(size=400) + 1
    rows = [(D + timedelta(i // 4), f"S{i % 4}", True, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "date date, symbol string, in_universe boolean, a double, b double, c double, y double"), x, y


def closed_form(x, y, alpha):
    z = (x - x.mean(0)) / x.std(0)
    return np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean())) / x.std(0)


def test_ridge_is_the_closed_form(sample):
    df, x, y = sample
    fitted = models.linear(models._vectors(df, models.train_medians(df, NAMES)), "y", "ridge", 2.0)
    want = closed_form(x, y, 2.0)
    assert np.allclose(fitted.coefficients.toArray(), want, rtol=2e-2, atol=1e-3) and abs(fitted.intercept - (y.mean() - x.mean(0) @ want)) < 0.05


def test_elastic_net_by_coordinate_descent(sample):
    df, x, y = sample
    alpha, l1 = 0.2, 0.5
    z, t, w = (x - x.mean(0)) / x.std(0), y - y.mean(), np.zeros(3)
    for _ in range(500):
        for j in range(3):
            r = z[:, j] @ (t - z @ w + z[:, j] * w[j]) / len(t)
            w[j] = np.sign(r) * max(abs(r) - alpha * l1, 0) / (1 + alpha * (1 - l1))
    fitted = models.linear(models._vectors(df, models.train_medians(df, NAMES)), "y", "elasticnet", alpha, l1)
    assert np.allclose(fitted.coefficients.toArray() * x.std(0), w, atol=5e-3)


def test_fit_predict_and_too_few_rows(sample):
    df, x, y = sample
    with_gaps = df.withColumn("b", F.when(F.col("symbol") == "S1", F.lit(float("nan"))).otherwise(F.col("b")))
    small = {"maxIter": 5, "minInstancesPerNode": 5}
    out = models.fit_predict(with_gaps, with_gaps, NAMES, "y", **small)
    rows = out.select("y", "linear_score_raw", "ml_score_raw").toPandas()
    assert rows["linear_score_raw"].corr(rows["y"]) > 0.8 and rows["ml_score_raw"].corr(rows["y"]) > 0.7
    none = models.fit_predict(df.limit(10), df, NAMES, "y")
    assert none.where("linear_score_raw is not null or ml_score_raw is not null").count() == 0
    with pytest.raises(ValueError):
        models.fit_predict(df.limit(10), df, NAMES, "y", production=True)


def test_live_window_and_join(spark, sample):
    df, _, _ = sample
    as_of = models.scoring_date(df)
    assert as_of == D + timedelta(99)
    train, score = models.live_window(df, as_of, 30, 20)
    assert train.agg(F.min("date"), F.max("date"), F.countDistinct("date")).first()[:] == (D + timedelta(50), D + timedelta(79), 30) and score.count() == 4
    with pytest.raises(ValueError):
        models.scoring_date(df.limit(0))
    made = spark.createDataFrame([(D, "S1", 0.5, None, 2)], "date date, symbol string, linear_score_raw double, ml_score_raw double, prediction_window_count long")
    joined = {(r.date, r.symbol): (r.linear_score_raw, r.prediction_window_count) for r in models.merge_predictions(df, made).where("date = '2024-01-01'").collect()}
    assert joined[D, "S1"] == (0.5, 2) and joined[D, "S0"] == (None, 0)
    assert models.merge_predictions(df, None).where("prediction_window_count = 0").count() == 400
