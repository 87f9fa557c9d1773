"""Nodes, edges and weights of the road graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadtally.operators import graph as ops
from roadtally.plans import stand_ins
from roadtally.plans.registry import query, rounded
from roadtally.plans.stand_ins import GRAPH, LINKS


@query(f"WITH {GRAPH} SELECT src, dst, round(length_km, 6) AS length_km, n_rows FROM edges")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.edge_table(stand_ins.links(spark, sf_dir)))


@query(
    f"""WITH {GRAPH}
SELECT node_id, round(lon, 6) AS lon, round(lat, 6) AS lat, n_rows FROM nodes"""
)
def graph_nodes_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.node_table(stand_ins.links(spark, sf_dir)))


@query(
    f"""WITH {LINKS}
SELECT node_id, round(median(lon), 6) AS lon, round(median(lat), 6) AS lat, count(*) AS n_rows
FROM (SELECT src AS node_id, lon, lat FROM links UNION ALL SELECT dst, lon, lat FROM links)
GROUP BY 1"""
)
def graph_nodes_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.node_table(stand_ins.links(spark, sf_dir), "median"))


@query(
    f"""WITH {LINKS}
SELECT src, dst, round(avg(length_km), 6) AS length_km, count(*) AS n_rows
FROM links WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1, 2"""
)
def graph_edges_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = ops.clean_links(stand_ins.raw_links(spark, sf_dir), drop_missing_coords=True)
    return rounded(ops.edge_table(links))


@query(
    f"""WITH {GRAPH},
kept AS (
  SELECT least(e.src, e.dst) AS low, greatest(e.src, e.dst) AS high, e.length_km, e.n_rows
  FROM edges e LEFT JOIN edges b ON b.src = e.dst AND b.dst = e.src
  WHERE b.src IS NULL OR e.src >= e.dst)
SELECT low AS src, high AS dst, round(length_km, 6) AS length_km, n_rows FROM kept
UNION
SELECT high, low, round(length_km, 6), n_rows FROM kept"""
)
def undirected_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.undirected(ops.edge_table(stand_ins.links(spark, sf_dir))))


@query(
    f"""WITH {GRAPH}
SELECT src, dst, round(length_km, 6) AS length_km, n_rows, round(hotspot_rate, 6) AS hotspot_rate,
       round(weight_km, 6) AS weight_km, round(penalty_km, 6) AS penalty_km
FROM weighted"""
)
def weighted_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stand_ins.weighted(spark, sf_dir))


@query(
    f"""WITH {GRAPH}
SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges"""
)
def graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = ops.edge_table(stand_ins.links(spark, sf_dir))
    return ops.graph_counts(ops.graph_nodes(edges), edges)
