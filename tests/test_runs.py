"""Runs by key: a run of a span equals the backtest of the panel cut to that span; window models against direct fits."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelrank.config import Params
from panelrank.operators import evaluation, portfolio, windowmodels

DAY = dt.date(2024, 1, 1)
PARAMS = Params(top_n=2, rebalance="weekly", weighting="inverse_vol")


def panel(spark, days=60, seed=1):
    rng = random.Random(seed)
    price = dict.fromkeys("abcd", 100.0)
    rows = []
    for i in range(days):
        for s in price:
            price[s] *= 1 + rng.uniform(-0.05, 0.05)
            rows.append((DAY + dt.timedelta(days=i), s, price[s], i > 10, rng.uniform(0.1, 0.9), rng.random(), rng.random() if i % 4 else None))
    return spark.createDataFrame(rows, "date date, symbol string, open double, in_universe boolean, vol20 double, one double, two double")


def close(a, b):
    return len(a) == len(b) and all(x[:-3] == y[:-3] and np.allclose(x[-3:], y[-3:], atol=1e-12) for x, y in zip(a, b))


def daily(df):
    return sorted((r["date"], r["net_return"], r["turnover"], r["equity"]) for r in df.collect())


def test_runs_equal_single_backtests(spark):
    p = panel(spark)
    spans = {"whole": (None, None), "mid": (DAY + dt.timedelta(days=13), DAY + dt.timedelta(days=40)), "late": (DAY + dt.timedelta(days=45), None), "one_day": (DAY + dt.timedelta(days=20),) * 2, "none": (dt.date(2030, 1, 1), None)}
    runs = portfolio.runs_of(spark, [(f"{score}/{n}", score, *s) for score in ("one", "two") for n, s in spans.items()])
    out = portfolio.keyed_returns(p, runs, ["one", "two"], PARAMS)
    for score in ("one", "two"):
        for name, (a, b) in spans.items():
            mine = daily(out.where(F.col("run") == f"{score}/{name}"))
            cut = p.where((F.lit(True) if a is None else F.col("date") >= a) & (F.lit(True) if b is None else F.col("date") <= b))
            theirs = daily(portfolio.daily_returns(cut, score, PARAMS)) if name != "none" else []
            assert close(mine, theirs), (score, name)


def test_scans_do_not_grow_with_runs(spark):
    """The plan over written tables is the same for one run and for twenty."""
    p = panel(spark, 30)
    scans = []
    for n in (1, 20):
        runs = portfolio.runs_of(spark, [(str(i), "one", None, DAY + dt.timedelta(days=29 - i)) for i in range(n)])
        scans.append(portfolio.keyed_returns(p, runs, ["one"], PARAMS)._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
    assert scans[0] == scans[1]


def test_prediction_counts_move_a_runs_start(spark):
    p = panel(spark).withColumn("prediction_window_count", F.lit(1)).withColumn("one", F.when(F.col("date") >= "2024-02-01", F.col("one")))
    out = daily(portfolio.daily_returns(p, "one", PARAMS))
    assert all(r[1] == 0 for r in out if r[0] <= dt.date(2024, 2, 4)) and any(r[1] != 0 for r in out)


def test_slice_results_and_refused_parameters(spark):
    p = panel(spark)
    runs = portfolio.runs_of(spark, [("a", "one", None, DAY + dt.timedelta(days=30)), ("flat", "one", None, DAY + dt.timedelta(days=5)), ("none", "one", dt.date(2030, 1, 1), None)])
    out = {r["run"]: r for r in evaluation.slice_runs(p, runs, ["one"], PARAMS).collect()}
    assert set(out) == {"a", "flat"} and out["a"]["observations"] == 31 and out["a"]["end_date"] == DAY + dt.timedelta(days=30)
    assert out["flat"]["sharpe"] == 0 and out["flat"]["calmar"] is None and out["flat"]["max_drawdown"] == 0
    assert evaluation.execution_params(PARAMS, {"top_n": 5, "fee_bps": 1.0}).top_n == 5
    with pytest.raises(ValueError, match="unsupported parameters: horizon"):
        evaluation.execution_params(PARAMS, {"horizon": 5, "top_n": 1})


def rows_of(seed=2, dates=80, symbols=6):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(dates):
        for s in range(symbols):
            x = [float(v) for v in rng.normal(size=3)]
            y = 0.5 * x[0] - 0.2 * x[1] + 0.1 * float(rng.normal()) + 7
            x[2] = None if rng.random() < 0.3 else 1000 + x[2]
            out.append((DAY + dt.timedelta(days=i), f"s{s}", bool(rng.random() < 0.8), None if rng.random() < 0.1 else y, *x, 4.0))
    return out


NAMES = ["f0", "f1", "f2", "flat"]


def windows_of(spark):
    d = lambda i: DAY + dt.timedelta(days=i)
    rows = [(w, d(10 * w), d(10 * w + 29), d(10 * w + 26), d(10 * w + 30), d(10 * w + 39)) for w in range(5)]
    return spark.createDataFrame(rows, "window_id int, train_start date, train_end date, effective_train_end date, test_start date, test_end date"), rows


def test_window_models_equal_direct_fits(spark):
    """Each window fitted from its rows by the textbook: medians, standardising, normal equations, and the net's optimality."""
    rows = rows_of()
    p = spark.createDataFrame(rows, "date date, symbol string, in_universe boolean, y double, f0 double, f1 double, f2 double, flat double").repartition(5)
    windows, spans = windows_of(spark)
    ends = {r[0]: r[0] + dt.timedelta(days=5) for r in rows}
    ends[DAY + dt.timedelta(days=12)] = DAY + dt.timedelta(days=500)  # a date whose labels look into every test
    ends[DAY + dt.timedelta(days=13)] = None
    label_ends = spark.createDataFrame(list(ends.items()), "date date, label_end date")
    models, status = windowmodels.train(p, windows, label_ends, NAMES, "y", 90, ("ridge", "plain_ridge", "elasticnet"))
    made = {(r["window_id"], r["kind"]): r for r in models.collect()}
    state = {r["window_id"]: r for r in status.collect()}
    predictions = {(r["date"], r["symbol"], r["window_id"], r["kind"]): r["score"] for r in windowmodels.predict(p, windows, models, NAMES).collect()}
    fitted = 0
    for w, start, end, effective, test, test_end in spans:
        train = [r for r in rows if r[2] and r[3] is not None and start <= r[0] <= effective and ends[r[0]] and ends[r[0]] < test]
        pre = [r for r in rows if r[2] and r[3] is not None and start <= r[0] <= end]
        assert state[w]["train_rows"] == len(train) and state[w]["purged_train_rows"] == len(pre) - len(train)
        assert state[w]["train_dates"] == len({r[0] for r in train}) and state[w]["test_rows"] == sum(r[2] and test <= r[0] <= test_end for r in rows)
        if len(train) < 90:
            assert (w, "ridge") not in made and state[w]["status"] in ("warm_up", "insufficient_data")
            continue
        fitted += 1
        x = np.array([r[4:] for r in train], float)
        middle = np.nanmedian(x, axis=0)
        fill = lambda m, middle=middle: np.where(np.isnan(m), middle, m)
        x, y = fill(x), np.array([r[3] for r in train])
        s = np.where(x.std(0) > 0, x.std(0), 1)
        z = (x - x.mean(0)) / s
        ridge = np.linalg.solve(z.T @ z + 2 * np.eye(4), z.T @ (y - y.mean()))
        c = x - x.mean(0)
        plain = np.linalg.solve(c.T @ c + 2 * np.eye(4), c.T @ (y - y.mean()))
        assert np.allclose(made[w, "ridge"]["coefficients"], ridge / s, atol=1e-9) and np.allclose(made[w, "plain_ridge"]["coefficients"], plain, atol=1e-9)
        b = np.array(made[w, "elasticnet"]["coefficients"]) * s
        slope = z.T @ (y - y.mean() - z @ b) / len(y) - 0.0005 * 0.8 * b
        assert np.all(np.abs(slope) <= 0.0001 + 1e-9) and np.allclose(slope[b != 0], 0.0001 * np.sign(b[b != 0]), atol=1e-9)
        for r in (r for r in rows if r[2] and test <= r[0] <= test_end):
            v = (fill(np.array(r[4:], float)) - x.mean(0)) / s
            assert abs(predictions[r[0], r[1], w, "ridge"] - (y.mean() + v @ ridge)) < 1e-9
    assert fitted >= 3


def test_warm_up_is_the_leading_run_only(spark):
    windows, _ = windows_of(spark)
    dates = [(DAY + dt.timedelta(days=i), DAY + dt.timedelta(days=i + 1), 0 if i < 20 or 40 <= i < 70 else 5, 6) for i in range(90)]
    trained = windowmodels.training_dates(spark.createDataFrame(dates, "date date, label_end date, n long, members long"), windows)
    found = {r["window_id"]: r["status"] for r in windowmodels.window_status(trained, windows, 60).collect()}
    assert found == {0: "warm_up", 1: "fit", 2: "fit", 3: "insufficient_data", 4: "insufficient_data"}
    assert {r["status"] for r in windowmodels.window_status(trained, windows, 10**6).collect()} == {"insufficient_data"}


def test_out_of_sample_mean_and_latest(spark):
    rows = [(DAY, "a", 0, "ridge", 1.0), (DAY, "a", 1, "ridge", 3.0), (DAY, "a", 1, "elasticnet", 5.0), (DAY, "b", 0, "elasticnet", 2.0)]
    df = spark.createDataFrame(rows, "date date, symbol string, window_id int, kind string, score double")
    kinds = {"ridge": "linear_score_raw", "elasticnet": "ml_score_raw"}
    take = lambda mode: sorted(tuple(r)[1:] for r in windowmodels.out_of_sample(df, kinds, mode).collect())
    assert take("mean") == [("a", 2.0, 5.0, 2), ("b", None, 2.0, 1)]
    assert take("latest") == [("a", 3.0, 5.0, 2), ("b", None, 2.0, 1)]
