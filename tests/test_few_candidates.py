"""Work that searches leave out: grouping of tails, ordering of hopeless candidates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadtally.operators import paths


def test_longer_candidates_are_dropped_before_they_are_ordered(spark):
    best = "named_struct('dist', d, 'hops', h, 'pred', p, 'round', 1) AS best"
    layout = "source string, metric string, node string, d double, h int, p string"
    state = spark.createDataFrame([("a", "m", "b", 2.0, 1, "a"), ("a", "m", "c", 9.0, 1, "a")], layout).selectExpr("source", "metric", "node", best)
    nearer = spark.createDataFrame([("a", "m", "c", 5.0, 1, "a")], layout).selectExpr("source", "metric", "node", best)
    rows = [("a", "m", "b", 3.0, 2, "c"), ("a", "m", "b", 2.0, 1, "A"), ("a", "m", "c", 8.0, 2, "b"), ("a", "m", "d", 7.0, 2, "b")]
    reached = spark.createDataFrame(rows, layout).selectExpr("source", "metric", "node", best)
    kept = paths._not_longer(reached, [state, nearer])
    assert kept.columns == reached.columns
    assert {(r.node, r.best.dist, r.best.pred) for r in kept.collect()} == {("b", 2.0, "A"), ("d", 7.0, "b")}


def test_equal_ways_still_go_to_fewer_hops_and_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(paths, "SORTED_ROWS", 0)
    rows = [("s", "b", 1.0), ("s", "a", 1.0), ("b", "t", 1.0), ("a", "t", 1.0), ("s", "x", 0.5), ("x", "y", 0.5), ("y", "t", 1.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, length_km double").withColumn("weight_km", F.col("length_km"))
    tree = paths.shortest_paths(edges, spark.createDataFrame([("s",)], "source string"))
    assert {(r.dist, r.hops, r.pred) for r in tree.where("node = 't'").collect()} == {(2.0, 2, "a")}


def test_tails_are_not_grouped_for_a_search(spark):
    links = spark.createDataFrame([("a", "b"), ("x", "b"), ("y", "y"), ("b", "c")], "src string, dst string")
    heads = paths.linked_heads(links)
    assert {(r.node_id, r.entered) for r in heads.collect()} == {("b", True), ("c", True), ("y", False)}
    assert {r.node_id for r in paths.with_tails(heads, links).collect()} == {"a", "b", "c", "x", "y"}


def test_a_source_that_only_the_whole_network_has(spark):
    edges = spark.createDataFrame([("a", "b")], "src string, dst string")
    whole = spark.createDataFrame([("a",), ("b",), ("z",)], "node_id string")
    paths.require_nodes(edges, spark.createDataFrame([("z",)], "source string"), "source", None, whole)
    with pytest.raises(ValueError, match="not in the graph"):
        paths.require_nodes(edges, spark.createDataFrame([("q",)], "source string"), "source", None, whole)
