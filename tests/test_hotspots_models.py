"""Hotspots, scores, folds and models."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from roadtally.operators import folds, hotspots, learning, metrics
from roadtally.operators import cleaning, quantiles
from roadtally.operators.quantiles import exact_quantiles

START = dt.datetime(2024, 1, 1)


def test_flags_reach_the_quantile(spark):
    rows = [(0, 1, 5.0)] + [(1, i, float(v)) for i, v in enumerate([1, 2, 2, 2, 3])]
    rows += [(2, 1, 4.0), (2, 2, None)]
    df = spark.createDataFrame(
        [(START + dt.timedelta(hours=h), i, v) for h, i, v in rows],
        "ts_hour timestamp, count_point_id int, y_pred double",
    )
    out = hotspots.flag_hotspots(df).orderBy("ts_hour", "count_point_id").collect()
    assert [r.is_hotspot for r in out] == [1, 0, 1, 1, 1, 1, 1, 0]
    assert out[1].hotspot_threshold == 2.0


def test_segment_rule_needs_more_than_the_quantile(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(10)] + [("b", 1.0)] * 10, "seg string, y_pred double")
    got = {r.seg: r for r in hotspots.segment_hotspots(df, "seg", q=0.7).collect()}
    assert got["a"].hotspot_rate == pytest.approx(0.3) and got["a"].is_segment_hotspot
    assert got["b"].hotspot_rate == 0 and not got["b"].is_segment_hotspot


def test_scores_equal_the_evaluator(spark):
    df = spark.range(200).select(
        (F.sin("id") * 50 + 60).alias("y"), (F.sin(F.col("id") + 0.2) * 50 + 58).alias("p")
    )
    row = metrics.regression_scores(df, "y", "p").first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert row[name] == pytest.approx(ev.evaluate(df), abs=1e-9)
    flat = metrics.regression_scores(df.withColumn("y", F.lit(1.0)), "y", "p").first()
    assert flat.r2 is None


def test_geh_share(spark):
    pairs = [(0.0, 0.0), (-5.0, 1.0), (10.0, 10.0), (100.0, 200.0), (100.0, 110.0), (None, 3.0)]
    df = spark.createDataFrame(pairs, "y double, p double")
    assert df.agg(metrics.geh_share("y", "p").alias("g")).first().g == pytest.approx(200 / 3)
    assert df.where("y <= 0").agg(metrics.geh_share("y", "p").alias("g")).first().g == 0.0
    geh = math.sqrt(2 * 100**2 / 300)
    assert geh > 5


def test_model_summary_skips_what_is_not_finite(spark):
    rows = [("A", 2.0, 1.0, 0.5, 60.0), ("A", float("nan"), 3.0, float("-inf"), 80.0), ("B", 1.0, 1.0, 0.9, 50.0)]
    df = spark.createDataFrame(rows, "model string, rmse double, mae double, r2 double, geh_pct_lt5 double")
    got = metrics.model_summary(df).collect()
    assert [r.model for r in got] == ["B", "A"]
    assert (got[1].folds, got[1].avg_rmse, got[1].avg_mae, got[1].avg_r2, got[1].avg_geh) == (2, 2.0, 2.0, 0.5, 70.0)


def hours(spark, n, step=1):
    return spark.createDataFrame([(START + dt.timedelta(hours=step * i),) for i in range(n)], "ts timestamp")


@pytest.mark.parametrize("n, k, days", [(10, 3, 1), (11, 9, 30), (100, 3, 1), (500, 4, 3)])
def test_fold_bounds(spark, n, k, days):
    df = hours(spark, n, 7)
    times = [START + dt.timedelta(hours=7 * i) for i in range(n)]
    want = {}
    for i in range(k):
        e = max(1, min(int((i + 1) / (k + 1) * (n - 1)), n - 2))
        t = min(e + max(1, days * 24), n - 1)
        if t > e:
            want[i + 1] = (times[e], times[t])
    got = folds.walkforward_folds(df.unionAll(df), "ts", k, days).collect()
    assert {r.fold: (r.train_end, r.test_end) for r in got} == want


def test_too_few_times(spark):
    with pytest.raises(ValueError, match="9 distinct"):
        folds.walkforward_folds(hours(spark, 9), "ts")


@pytest.fixture(scope="module")
def gold(spark):
    t = F.timestamp_seconds(F.unix_seconds(F.lit(START)) + F.col("id") * 3600)
    rows = spark.range(600).select(t.alias("ts_hour"), (100 + 40 * F.sin(F.col("id") / 4)).alias("lag_1h"))
    return rows.select(
        "ts_hour",
        "lag_1h",
        F.hour("ts_hour").alias("hour_of_day"),
        F.lit(1).alias("month"),
        (F.col("lag_1h") + F.hour("ts_hour")).alias("y_t_plus_1h"),
        F.lit(5).cast("bigint").alias("count_point_id"),
        F.lit(51.5).alias("latitude"),
        F.lit(0.1).alias("longitude"),
        F.lit("a").alias("start_junction_road_name"),
        F.lit("b").alias("end_junction_road_name"),
    )


def test_walk_forward_rows(gold):
    models = {
        "LR": learning.linear("y_t_plus_1h"),
        "GBT": learning.boosted("y_t_plus_1h", maxIter=3),
        "RF": learning.forest("y_t_plus_1h", numTrees=3),
    }
    out = learning.walk_forward(gold, "y_t_plus_1h", models, test_days=2, max_train_rows=100)
    rows = out.collect()
    assert [(r.fold, r.model) for r in rows] == [(f, m) for f in (1, 2, 3) for m in models]
    first = rows[0]
    assert (first.train_rows, first.test_rows) == (150, 48)
    assert first.rmse < 5 and first.r2 > 0.9


def test_scoring_split_and_predictions(gold):
    preds, model, n_train = learning.score_last_days(gold, score_days=5, maxIter=3)
    assert (n_train, preds.count()) == (480, 120)
    assert {"from_node", "to_node", "y_true", "y_pred", "hour_of_day"} <= set(preds.columns)
    assert len(model.stages) == 2
    everything = learning.last_days_split(gold, "ts_hour", 0)
    assert everything[0].count() == everything[1].count() == 600
    with pytest.raises(ValueError, match="missing"):
        learning.score_last_days(gold.drop("latitude"))
    with pytest.raises(ValueError, match="empty split"):
        learning.score_last_days(gold, score_days=90)


def test_sampling_is_by_key(gold):
    key = ["ts_hour", "count_point_id"]
    small = learning.down_sample(gold, 100, key)
    assert 50 < small.count() < 160
    assert small.exceptAll(learning.down_sample(gold.repartition(7), 100, key)).isEmpty()
    assert learning.down_sample(gold, 0, key).count() == learning.down_sample(gold, 1000, key).count() == 600
    train, test = learning.random_split(gold, key)
    assert train.count() + test.count() == 600 and 60 < test.count() < 180


def test_flag_quality(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.9), (1, 0, 0.8), (0, 1, 0.3), (0, 0, 0.1)], "f int, t int, p double"
    )
    row = metrics.flag_scores(df, "f", "t").first()
    assert (row.tp, row.fp, row.fn, row.tn, row.f1) == (1, 1, 1, 1, 0.5)
    assert metrics.flag_auc(df, "p", "t") == pytest.approx(0.75)
    assert metrics.reliability_curve(df, "p", "t").count() == 4


@pytest.mark.parametrize("q", [0.0, 0.2, 0.5, 0.6, 0.995, 1.0])
def test_exact_quantiles(spark, q):
    """Against sorting; one key has more rows than a sketch keeps apart, one has ties only."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 20 == 0, F.col("id") % 7).otherwise(-1).alias("k"),
        F.when(F.col("id") % 20 == 0, F.lit(1.5)).otherwise(F.pmod(F.hash("id"), F.lit(30_011)) / 4).alias("v"),
    )
    df = df.unionAll(spark.createDataFrame([(9, 2.0), (9, 1.0), (9, None), (10, None)], "k int, v double"))
    want = {}
    for k, v in df.where("v is not null").collect():
        want.setdefault(k, []).append(v)
    want = {k: sorted(vs)[max(math.ceil(q * len(vs) - 1e-9), 1) - 1] for k, vs in want.items()}
    got = {r.k: r.top for r in exact_quantiles(df, "k", "v", q, "top").collect()}
    assert got == want | {10: None}


@pytest.mark.parametrize("few", [3, 100_000])
def test_exact_quantiles_of_null_keys_and_nan(spark, monkeypatch, few):
    """NaN is the largest value, a null key is a key; brackets are narrowed when many are many."""
    monkeypatch.setattr(quantiles, "FEW", few)
    values = {None: [float(k) for k in range(9, -1, -1)], 1: [5.0] * 10 + [math.nan] * 3, 2: [math.nan], 3: [1e300, -1e300, 0.0, 7.0]}
    values[4] = [math.sin(k) for k in range(500)]
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k int, v double")
    for q in (0.0, 0.5, 0.75, 0.9, 1.0):
        got = {r.k: r.top for r in exact_quantiles(df, "k", "v", q, "top").collect()}
        for k, vs in values.items():
            ordered = sorted(v for v in vs if v == v) + [math.nan] * sum(v != v for v in vs)
            want = ordered[max(math.ceil(q * len(vs) - 1e-9), 1) - 1]
            assert got[k] == want or (want != want and got[k] != got[k]), (q, k)
    capped = cleaning.cap_by_key(df, "k", "v", 0.5).where("k is null").agg(F.max("v")).first()[0]
    assert capped == 4.0


def test_fits_take_as_many_tasks_as_their_rows_fill(spark, monkeypatch):
    monkeypatch.setattr(learning, "TASK_ROWS", 40)
    rows = spark.range(0, 100, 1, 64)
    assert learning.in_tasks(rows, 100).rdd.getNumPartitions() == 3
    assert learning.in_tasks(rows, 0).rdd.getNumPartitions() == 1
    assert sorted(r["id"] for r in learning.in_tasks(rows, 100).collect()) == list(range(100))
