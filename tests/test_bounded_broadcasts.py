"""Tables that the driver would hold for a search are broadcast only while they are few."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadtally.operators import paths, routes


def hints(df) -> int:
    return df._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")


@pytest.fixture
def line(spark):
    """A way of 8 nodes and a shortcut that is a hotspot."""
    rows = [(f"n{i}", f"n{i + 1}", 1.0, 1.0) for i in range(7)] + [("n0", "n5", 2.0, 90.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, length_km double, weight_km double")
    return edges.withColumns({"hotspot_rate": F.lit(0.0), "penalty_km": F.col("weight_km") - F.col("length_km")})


def test_a_climb_of_many_links_holds_none_on_the_driver(spark, monkeypatch):
    tree = spark.createDataFrame(
        [("n0", "m", f"n{i}", f"n{i - 1}" if i else None) for i in range(8)], "source string, metric string, node string, up string"
    )
    links, starts = tree.where("up is not null"), tree.select("source", "metric", F.col("node").alias("target"), "node")
    few = paths.climb(starts, links, ["source", "metric"], 7)
    assert hints(few) == 3  # one for each of 1, 2 and 4 links
    monkeypatch.setattr(paths, "KEPT_ROWS", 5)
    many = paths.climb(starts, links, ["source", "metric"], 7)
    assert hints(many) < 3
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_values_are_looked_up_for_nodes_and_not_for_steps(line, monkeypatch):
    seen = []
    plain = routes.with_edge_values
    monkeypatch.setattr(routes, "with_edge_values", lambda steps, edges: seen.append(steps.count()) or plain(steps, edges))
    steps = routes.find_routes(line, ["n0"])[1]
    # n5 to n7 are nearer by the shortcut, the avoiding route goes the whole way
    assert seen == [2 * 7] and steps.count() == sum(range(1, 5)) + sum(range(1, 4)) + sum(range(1, 8))
    assert steps.columns == ["from_node", "to_node", "route", "step", "src", "dst", "length_km", "hotspot_rate", "weight_km", "penalty_km"]
    assert steps.where("weight_km = 90.0 and penalty_km = 88.0 and route = 'shortest_distance'").count() == 3
