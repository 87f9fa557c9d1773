"""Models from merged sums against Spark ML, and ensembles as tables of nodes."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from roadtally.operators import fold_statistics as fs, learning
from roadtally.operators.folds import fold_split
from roadtally.operators.metrics import regression_scores
from roadtally.operators.tree_tables import tree_nodes, tree_scores

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hours(spark):
    rng = np.random.default_rng(3)
    rows = []
    for h in range(240):
        for _ in range(4):
            a, b = float(rng.normal(12, 3)), float(rng.normal(5, 40))
            rows.append((START + dt.timedelta(hours=h), a, b, 7.0, float(2 * a - 0.3 * b + rng.normal(0, 2 + h / 50))))
    rows += [(START, None, 1.0, 7.0, 5.0), (None, 1.0, 1.0, 7.0, 5.0), (START, 1.0, 1.0, 7.0, None)]
    return spark.createDataFrame(rows, "ts_hour timestamp, a double, b double, c double, y double").cache()


@pytest.mark.parametrize("penalty", [0.0, 0.1, 25.0])
def test_fits_equal_spark_on_every_fold(hours, penalty):
    # Without a penalty Spark's solver has no use for a column that does not vary.
    features = ["a", "b", "c"] if penalty else ["a", "b"]
    fits = fs.fold_linear_fits(hours, "y", features, penalty=penalty, n_folds=4, test_days=1).collect()
    assert [f.fold for f in fits] == [1, 2, 3, 4]
    whole = hours.dropna()
    for fit in fits:
        train, test = fold_split(whole, "ts_hour", fit.train_end, fit.test_end)
        assert (fit.train_rows, fit.test_rows) == (train.count(), test.count())
        ready = learning.vectors(features, "error")
        model = LinearRegression(labelCol="y", regParam=penalty, solver="normal").fit(ready.transform(train))
        assert np.allclose(fit.coefficients, model.coefficients.toArray(), rtol=1e-5, atol=1e-7)
        scores = regression_scores(model.transform(ready.transform(test)), "y", "prediction").first()
        assert np.isclose(fit.rmse, scores.rmse, rtol=1e-6) and np.isclose(fit.r2, scores.r2, rtol=1e-4)
        assert np.isclose(fit.train_rmse, model.summary.rootMeanSquaredError, rtol=1e-6)


def test_large_values_lose_no_digits(hours):
    """Deviations of 3 around 1e8: the fit must equal one on centred values."""
    far = hours.withColumn("a", F.col("a") + 1e8)
    fits = fs.fold_linear_fits(far, "y", ["a", "b"], penalty=0.0, n_folds=2, test_days=1).collect()
    whole = hours.dropna().toPandas()
    for fit in fits:
        train = whole[whole.ts_hour <= fit.train_end]
        test = whole[(whole.ts_hour > fit.train_end) & (whole.ts_hour <= fit.test_end)]
        x = np.column_stack([train.a, train.b, np.ones(len(train))])
        want = np.linalg.lstsq(x, train.y, rcond=None)[0]
        assert np.allclose(fit.coefficients, want[:2], rtol=1e-6)
        wrong = test.y - np.column_stack([test.a, test.b, np.ones(len(test))]) @ want
        assert np.isclose(fit.rmse, (wrong**2).mean() ** 0.5, rtol=1e-6)


def test_a_label_that_does_not_vary(hours):
    fits = fs.fold_linear_fits(hours.withColumn("y", F.lit(3.0)), "y", ["a", "c"], n_folds=2, test_days=1).collect()
    assert all(f.coefficients == [0.0, 0.0] and f.intercept == 3.0 and f.rmse == 0.0 and f.r2 is None for f in fits)


def test_blocks_merge_to_the_whole(hours):
    columns = ["a", "b", "y"]
    parts = fs.block_moments(hours, columns, F.hour("ts_hour") % 5).collect()
    n, means, products = fs.merged([(p.n, np.array(p.means), np.array(p.products).reshape(3, 3)) for p in parts])
    # A row without a time has no block and does not count.
    table = hours.where("ts_hour is not null").select(*columns).dropna().toPandas().to_numpy()
    assert n == len(table) and np.allclose(means, table.mean(0), rtol=1e-12)
    assert np.allclose(products, np.cov(table.T, bias=True) * n, rtol=1e-9)


def test_scaling_is_fitted_on_one_part(spark):
    rows = [(1.0, 5.0, 1), (3.0, 5.0, 1), (11.0, 9.0, 0), (None, None, 1)]
    df = spark.createDataFrame(rows, "x double, same double, part int")
    got = fs.standardised(df, ["x", "same"], F.col("part") == 1).collect()
    root = 2**0.5
    assert np.allclose([r.x for r in got[:3]], [-1 / root, 1 / root, 9 / root])
    assert [r.same for r in got] == [0.0, 0.0, 0.0, None] and got[3].x is None
    assert [r.x for r in fs.standardised(df, ["x"], F.lit(False)).collect()] == [0.0, 0.0, 0.0, None]


@pytest.mark.parametrize("kind", ["boosted", "forest", "tree", "leaf"])
def test_scores_by_joins_equal_the_models(spark, hours, kind):
    rows = hours.dropna().withColumn("id", F.xxhash64("ts_hour", "a", "b"))
    estimator = {
        "boosted": learning.boosted("y", maxIter=5, maxDepth=3),
        "forest": learning.forest("y", numTrees=6, maxDepth=4),
        "tree": DecisionTreeRegressor(labelCol="y", maxDepth=5),
        "leaf": DecisionTreeRegressor(labelCol="y", maxDepth=0),
    }[kind]
    ready = learning.vectors(["a", "b", "c"], "error").transform(rows)
    model = estimator.fit(ready)
    want = {r.id: r.prediction for r in model.transform(ready).select("id", "prediction").collect()}
    scored = tree_scores(rows, tree_nodes(spark, model), "id", F.array("a", "b", "c"))
    got = {r.id: r.prediction for r in scored.collect()}
    assert got.keys() == want.keys()
    assert np.allclose([got[k] for k in want], [want[k] for k in want], rtol=1e-12)


def test_only_regression_trees_become_tables(spark, hours):
    model = LinearRegression(labelCol="y").fit(learning.vectors(["a"], "skip").transform(hours.dropna()))
    with pytest.raises(TypeError):
        tree_nodes(spark, model)
