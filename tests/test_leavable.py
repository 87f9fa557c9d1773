"""Searches over edges made only of the links that a search may take."""

from __future__ import annotations

import pytest

from roadtally.operators import graph, layers, paths, routes
from roadtally.plans import stand_ins


@pytest.fixture
def links(spark):
    rows = [("a", "b", 2.0), ("a", "b", 4.0), ("b", "c", 1.0), ("c", "b", 1.0), ("x", "b", 1.0), ("y", "c", 1.0), ("y", "y", 1.0), ("c", "e", 5.0)]
    return spark.createDataFrame(rows, "src string, dst string, length_km double")


def _edges(links):
    return graph.edge_table(links).selectExpr("src", "dst", "length_km", "0.0D AS hotspot_rate", "length_km AS weight_km", "0.0D AS penalty_km")


def test_routes_over_leavable_links_are_those_of_all(links):
    nodes = paths.entered_nodes(links)
    few = paths.leavable(links, ["a"], nodes)
    assert {(r.src, r.dst) for r in few.collect()} == {("a", "b"), ("b", "c"), ("c", "b"), ("c", "e")}
    some, every = routes.find_routes(_edges(few), ["a"], whole=nodes), routes.find_routes(_edges(links), ["a"])
    for got, want in zip(some, every):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert some[0].count() == 5 and some[0].where("reachable").count() == 3  # x and y are pairs too


def test_a_source_that_nothing_leaves(links):
    nodes = paths.entered_nodes(links)
    few = paths.leavable(links, ["e"], nodes)
    pairs, found = routes.find_routes(_edges(few.where("src <> 'c'")), ["e"], whole=nodes)
    assert pairs.count() == 5 and pairs.where("reachable").count() == 0 and found.count() == 0
    with pytest.raises(ValueError, match="not in the graph"):
        routes.find_routes(_edges(few), ["nowhere"], whole=nodes)


def test_the_search_tables_hold_no_other_edges(spark, tmp_path):
    rows = [(0, 1, 9.0), (1, 2, 9.0), (5, 1, 9.0), (6, 2, 9.0)]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity double").selectExpr(
        "*", "0.01 as l_tax", "0.02 as l_discount", "'O' as l_linestatus", "'R' as l_returnflag", "1.0D as l_extendedprice"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    edges, nodes = stand_ins.weighted_from(spark, str(tmp_path), "N0")
    assert {(r.src, r.dst) for r in edges.collect()} == {("N0", "N1"), ("N1", "N2")}
    assert nodes.count() == 5
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # chosen below the grouping


def test_positions_are_grouped_for_nodes_on_routes_only(spark, links):
    _, found = routes.find_routes(_edges(links), ["a"], ["c"])
    at = [(n, i * 1.0, 50.0 + i) for i, n in enumerate("abcexy")] * 2
    nodes = spark.createDataFrame(at, "node_id string, lon double, lat double").groupBy("node_id").agg({"lon": "avg", "lat": "avg"})
    nodes = nodes.toDF("node_id", "lat", "lon") if nodes.columns[1] == "avg(lat)" else nodes.toDF("node_id", "lon", "lat")
    layer = layers.route_layer(found, nodes)
    assert {tuple(map(tuple, r.coordinates)) for r in layer.collect()} == {((0.0, 50.0), (1.0, 51.0), (2.0, 52.0))}
