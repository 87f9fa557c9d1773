"""Sources and sinks: each query writes a layer in the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roadtally.functions.columns import snake_columns
from roadtally.operators import cleaning, graph, layers
from roadtally.plans import stand_ins
from roadtally.plans.queries_cleaning import disruption_records
from roadtally.plans.queries_hotspots import _flags
from roadtally.plans.queries_routes import _found, _hotspot_lines
from roadtally.plans.registry import query, rounded, table
from roadtally.plans.stand_ins import CLEAN_COUNTS, FLAGS, GRAPH, RAW_COUNTS, ROUTES, SOURCE
from roadtally.session import scratch_path
from roadtally.sources import readers, sinks

RUN = "20260101T000000Z"


@query(f"WITH {RAW_COUNTS} SELECT * FROM raw_counts")
def csv_string_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns from part files below ``region=`` and ``year=`` folders."""
    return snake_columns(stand_ins.raw_files(spark, sf_dir))


@query(
    """SELECT p_partkey::VARCHAR AS p_partkey, 'a "' || p_name || '", ' || p_brand AS label
FROM part"""
)
def csv_quoted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with commas and doubled quotes, in compressed files."""
    path = scratch_path(spark, "quoted")
    label = F.concat(F.lit('a "'), "p_name", F.lit('", '), "p_brand").alias("label")
    rows = table(spark, sf_dir, "part").select("p_partkey", label)
    rows.write.options(**sinks.CSV_OPTIONS).option("compression", "gzip").csv(path)
    return readers.csv_quoted(spark, path)


@query("SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier")
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "typed")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    sinks.write_csv(rows, path)
    return rounded(readers.csv_typed(spark, path, T.StructType(rows.schema.fields)))


@query(
    """SELECT p_partkey::INT AS p_partkey, p_brand, p_size, round(p_retailprice, 6) AS p_retailprice
FROM part"""
)
def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file while the rows are few, and types found by reading them."""
    path = scratch_path(spark, "inferred")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    sinks.write_csv(rows, path, single_file=True)
    return rounded(readers.csv_typed(spark, path))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def parquet_data_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files in nested folders that also hold files of other kinds."""
    path = scratch_path(spark, "mixed")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    orders.write.parquet(f"{path}/layer")
    table(spark, sf_dir, "region").write.csv(f"{path}/notes")
    return readers.parquet_files(spark, path)


@query("SELECT 'N' || l_partkey AS node_id, l_quantity AS length_km FROM lineitem")
def parquet_column_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of many columns, found by candidate names."""
    found = readers.parquet_columns(
        spark,
        f"{sf_dir}/lineitem.parquet",
        {"part": ("part_id", "L_PARTKEY"), "length_km": ("link_length_km", "l_quantity")},
    )
    return found.select(F.concat(F.lit("N"), F.col("part").cast("string")).alias("node_id"), "length_km")


@query(
    f"""WITH {CLEAN_COUNTS}
SELECT count_point_id, count_date::VARCHAR AS count_date, hour,
       CASE WHEN year(count_date) = 1999 THEN all_motor_vehicles + 1 ELSE all_motor_vehicles END AS all_motor_vehicles,
       year(count_date)::INT AS p_year
FROM clean_counts"""
)
def month_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by month; one year is then written again with other values. All months are read."""
    path = scratch_path(spark, "silver")
    clean = cleaning.clean_counts(stand_ins.raw_files(spark, sf_dir))
    sinks.write_months(clean, path)
    changed = clean.where("p_year = 1999").withColumn("all_motor_vehicles", F.col("all_motor_vehicles") + 1)
    sinks.write_months(changed, path)
    day = F.col("count_date").cast("string").alias("count_date")
    rows = spark.read.parquet(path)
    return rows.select("count_point_id", day, "hour", "all_motor_vehicles", "p_year")


@query(
    """SELECT c_custkey, 'East' AS region FROM customer
UNION ALL SELECT c_custkey, 'East' FROM customer
UNION ALL SELECT s_suppkey, 'West' FROM supplier"""
)
def region_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region overwritten and appended to, another overwritten and left alone."""
    path = scratch_path(spark, "gold")
    east = cleaning.tag_region(table(spark, sf_dir, "customer").select("c_custkey"), "East")
    west = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    sinks.write_region(cleaning.tag_region(west, "West"), path)
    sinks.write_region(east, path)
    sinks.write_region(east, path, mode="overwrite", repartition=4)
    sinks.write_region(east, path, mode="append", coalesce=2)
    return spark.read.parquet(path)


@query(f"WITH RECURSIVE {ROUTES} SELECT from_node, to_node, route, step, src, dst FROM routes")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a region; with no stable export the newest is read."""
    root = scratch_path(spark, "runs")
    found = _found(spark, sf_dir)[1].select("from_node", "to_node", "route", "step", "src", "dst")
    older = found.where("step = 1")
    sinks.write_run(older, f"{root}/route_analysis", "London", "20251231T235959Z")
    sinks.write_run(found, f"{root}/route_analysis", "London", RUN)
    return readers.latest_routes(spark, root, "London").drop("region", "run_utc")


@query(
    f"""WITH {GRAPH}
SELECT src, dst, round(length_km, 6) AS length_km, n_rows, round(hotspot_rate, 6) AS hotspot_rate
FROM weighted"""
)
def exchanged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges and rates written as CSV by one step and joined by the next."""
    edges_path, rates_path = scratch_path(spark, "edges"), scratch_path(spark, "rates")
    sinks.write_csv(graph.edge_table(stand_ins.links(spark, sf_dir)), edges_path)
    sinks.write_csv(stand_ins.rates(spark, sf_dir), rates_path)
    joined = graph.weight_edges(
        readers.edges_csv(spark, edges_path), readers.edge_rates_csv(spark, rates_path)
    )
    return rounded(joined.select("src", "dst", "length_km", "n_rows", "hotspot_rate"))


@query(f"WITH {FLAGS} SELECT ts_hour, count_point_id, round(y_pred, 6) AS y_pred, is_hotspot FROM flags")
def predictions_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(_flags(spark, sf_dir), path)
    stored = spark.read.parquet(path).select("ts_hour", "count_point_id", "y_pred", "is_hotspot")
    return rounded(stored)


@query(
    f"""WITH {GRAPH}
SELECT 'London' AS region, '{SOURCE}' AS from_node, 2.0::DOUBLE AS alpha,
       (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges"""
)
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metadata")
    edges = graph.edge_table(stand_ins.links(spark, sf_dir))
    counts = graph.graph_counts(graph.graph_nodes(edges), edges)
    sinks.write_metadata(counts, path, region="London", from_node=SOURCE, alpha=2.0)
    layout = "region string, from_node string, alpha double, nodes bigint, edges bigint"
    return spark.read.schema(layout).json(path)


@query(
    """SELECT 'disruption ' || event_id AS title, event_type AS category,
       CASE WHEN event_type <> 'view' THEN date_trunc('hour', ts) END AS timestamp_hour
FROM events"""
)
def disruption_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records from JSON files on disk."""
    path = scratch_path(spark, "feed")
    disruption_records(spark, sf_dir).write.json(path)
    flat = readers.flatten_disruptions(readers.disruption_feed(spark, path))
    title = F.concat(F.lit("disruption "), "disruption_id").alias("title")
    return flat.select(title, "category", "timestamp_hour")


@query(
    f"""WITH {GRAPH}
SELECT r.from_node, r.to_node, round(r.hotspot_rate, 6) AS hotspot_rate
FROM rates r JOIN nodes a ON a.node_id = r.from_node JOIN nodes b ON b.node_id = r.to_node
WHERE a.lon IS NOT NULL AND b.lon IS NOT NULL"""
)
def geojson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written one per line and parsed back."""
    path = scratch_path(spark, "layer")
    sinks.write_features(layers.hotspot_features(_hotspot_lines(spark, sf_dir, 0.0)), path)
    layout = "properties struct<from_node:string,to_node:string,hotspot_rate:double>"
    return rounded(spark.read.schema(layout).json(path).select("properties.*"))


_DRAWN = f"""WITH {GRAPH},
drawn AS (
  SELECT row_number() OVER (
           ORDER BY '{{"from_node":"' || r.from_node || '","to_node":"' || r.to_node || '"}}') - 1 AS rank,
         r.from_node, r.to_node, round(r.hotspot_rate, 6) AS hotspot_rate, round(a.lon, 6) AS src_lon,
         round(a.lat, 6) AS src_lat, round(b.lon, 6) AS dst_lon, round(b.lat, 6) AS dst_lat
  FROM rates r JOIN nodes a ON a.node_id = r.from_node JOIN nodes b ON b.node_id = r.to_node
  WHERE a.lon IS NOT NULL AND b.lon IS NOT NULL)"""


def _read_back(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    path = scratch_path(spark, "collection")
    features = layers.hotspot_features(_hotspot_lines(spark, sf_dir, 0.0))
    sinks.write_collection(features, path, ["from_node", "to_node"], limit)
    layout = (
        "geometry struct<type:string,coordinates:array<array<double>>>, "
        "properties struct<from_node:string,to_node:string,hotspot_rate:double>"
    )
    ends = [
        F.col("geometry.coordinates")[i][j].alias(f"{end}_{axis}")
        for i, end in enumerate(("src", "dst"))
        for j, axis in enumerate(("lon", "lat"))
    ]
    return rounded(readers.collection_features(spark, path, layout).select("rank", "properties.*", *ends))


@query(f"{_DRAWN} SELECT * FROM drawn")
def geojson_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection over sorted part files, read back as one document, each feature with its place."""
    return _read_back(spark, sf_dir)


@query(f"{_DRAWN}, cut AS (SELECT * FROM drawn ORDER BY from_node, to_node LIMIT 120) SELECT * FROM cut")
def geojson_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 120 lines only: a map's limit is the feature here."""
    return _read_back(spark, sf_dir, limit=120)


@query(f"WITH RECURSIVE {ROUTES} SELECT from_node, to_node, route, step, src, dst FROM routes")
def committed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A newer run broke off after its first rows: without a manifest it is passed over."""
    root = scratch_path(spark, "runs")
    found = _found(spark, sf_dir)[1].select("from_node", "to_node", "route", "step", "src", "dst")
    sinks.write_run(found, f"{root}/route_analysis", "London", RUN)
    found.where("step <= 2").write.parquet(f"{root}/route_analysis/region=London/run_utc=20260102T000000Z")
    return readers.latest_routes(spark, root, "London").drop("region", "run_utc")
