"""Weighted medians: narrowed ranges against numpy, and what a task may hold."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadtally.operators.quantiles import narrowed, weighted_medians

NAN, INF = float("nan"), float("inf")


def medians(rows):
    """Every value as often as it weighs, in numpy."""
    found = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        per_axis = []
        for axis in (1, 2):
            values = sorted((r[axis] for r in own if r[axis] is not None for _ in range(r[3])), key=lambda x: (x != x, x))
            n = len(values)
            per_axis.append((values[(n - 1) // 2] + values[n // 2]) / 2 if n else None)
        found[key] = (*per_axis, sum(r[3] for r in own))
    return found


def check(spark, rows, few):
    df = spark.createDataFrame(rows, "k string, lon double, lat double, n bigint")
    got = {r.k: (r.lon, r.lat, r.n) for r in weighted_medians(df, "k", ["lon", "lat"], "n", few).collect()}
    want = medians(rows)
    assert got.keys() == want.keys()
    for key, values in want.items():
        for a, b in zip(got[key], values):
            assert (a is None and b is None) or np.isclose(a, b, rtol=1e-12, equal_nan=True), (key, got[key], values)


@pytest.mark.parametrize("few", [3, 40, 100_000])
def test_medians_equal_numpy(spark, few):
    rng = np.random.default_rng(4)
    rows = [("hot", float(x), float(y), int(w)) for x, y, w in zip(rng.normal(size=1500), rng.lognormal(0, 6, 1500), rng.integers(1, 9, 1500))]
    rows += [("even", 1.0, 2.0, 1), ("even", 2.0, 2.0, 1), ("half", 1.0, None, 1), ("none", None, None, 3)]
    rows += [(None, float(i), float(-i), 1) for i in range(50)]
    rows += [("odd ends", x, -x, 1) for x in (INF, -INF, NAN, 1.0, 2.0, 3.0, 4.0)]
    rows += [("not numbers", NAN, float(i), 5) for i in range(9)]
    rows += [("repeated", 7.0, 8.0, 2)] * 20
    check(spark, rows, few)


def test_an_empty_table_has_no_medians(spark):
    check(spark, [], 3)


def test_no_task_orders_a_busy_nodes_values(spark):
    """The ranges that values are ordered in hold few of them, however skewed they lie."""
    pairs = spark.range(4000).select(
        F.lit("a").alias("_key"), F.lit(0).alias("axis"), F.exp(F.col("id") / 100.0).alias("x"), F.lit(2).cast("bigint").alias("n")
    )
    wanted = pairs.groupBy("_key", "axis").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("held"))
    wanted = wanted.select("_key", "axis", F.lit(4000).cast("bigint").alias("rank"), F.lit(0).cast("bigint").alias("below"), "held", "low", "high")
    (found,) = narrowed(pairs, wanted, few=10).collect()
    inside = pairs.where(F.col("x").between(found.low, found.high)).count()
    assert found.held == inside <= 10
    assert found.below <= 4000 < found.below + 2 * inside
