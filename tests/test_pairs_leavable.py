"""Searches between pairs group only the links that they may take."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadtally.operators import paths, routes
from roadtally.plans import stand_ins


def test_links_that_no_pair_needs_are_not_grouped(spark, tmp_path):
    ends = [(1, 2), (2, 3), (3, 1), (3, 4), (900, 2), (901, 3), (902, 4)]
    rows = spark.createDataFrame(ends, "l_partkey bigint, l_suppkey bigint").withColumns(
        {
            "l_quantity": F.lit(9.0), "l_discount": F.lit(0.0), "l_tax": F.lit(0.0), "l_extendedprice": F.lit(1.0),
            "l_linestatus": F.lit("O"), "l_returnflag": F.lit("R"),
        }
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1,), (2,), (3,), (4,), (21,)], "s_suppkey bigint").write.parquet(f"{tmp_path}/supplier.parquet")
    edges, wanted, nodes = stand_ins.weighted_between(spark, str(tmp_path))
    assert {(r.src, r.dst) for r in edges.collect()} == {("N1", "N2"), ("N2", "N3"), ("N3", "N1"), ("N3", "N4")}
    assert sorted(map(tuple, wanted.collect())) == [(f"N{i}", f"N{i}") for i in range(1, 5)]
    assert sorted(map(tuple, stand_ins.wanted_pairs(spark, str(tmp_path)).collect())) == sorted(map(tuple, wanted.collect()))
    assert "N902" in {r.node_id for r in nodes.collect()}


def test_a_table_of_sources_chooses_the_same_links(spark):
    links = spark.createDataFrame([("a", "b"), ("x", "b"), ("b", "c"), ("y", "y")], "src string, dst string")
    heads = paths.linked_heads(links)
    table = spark.createDataFrame([("x",), ("x",)], "source string")
    assert sorted(map(tuple, paths.leavable(links, table, heads).collect())) == [("b", "c"), ("x", "b")]
    assert sorted(map(tuple, paths.leavable(links, ["x"], heads).collect())) == [("b", "c"), ("x", "b")]


def test_a_wanted_end_that_no_edge_has_is_no_error_if_the_network_has_it(spark):
    edges = spark.createDataFrame(
        [("a", "b", 1.0, 1.0, 0.0, 0.0)], "src string, dst string, length_km double, weight_km double, hotspot_rate double, penalty_km double"
    )
    wanted = spark.createDataFrame([("a", "b"), ("a", "z")], "source string, target string")
    whole = spark.createDataFrame([("a",), ("b",), ("z",)], "node_id string")
    pairs, steps = routes.routes_between(edges, wanted, whole)
    assert {tuple(r) for r in pairs.collect()} == {("a", "b", True), ("a", "z", False)}
    assert steps.count() == 2
