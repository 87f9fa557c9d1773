"""All steps in order: raw files to clean rows, features, scores, graph, routes and map layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadtally.functions.columns import event_time_column
from roadtally.functions.parsing import hour_timestamp, parse_event_time
from roadtally.operators import cleaning, graph, hotspots, layers, learning, metrics, routes, series
from roadtally.sources import readers, sinks


@dataclass
class Settings:
    """Parameters of a run.

    Test and score days, the model of the folds, the trees and the hotspot bound default to those
    of the daily job. Nothing is left out by default: no target or map line is cut, and only the
    scoring model is fitted on a bounded sample of labelled rows (``max_train_rows``, 0: all).
    """

    raw: str
    root: str
    region: str
    run_utc: str
    sources: list[str]
    targets: list[str] | None = None
    event_feed: str | None = None
    event_csv: str | None = None
    horizon: int = 1
    n_folds: int = 3
    test_days: int = 3
    with_boosting: bool = False
    score_days: int = 7
    max_train_rows: int = 50_000
    max_fold_rows: int = 0
    quantile: float = hotspots.DEFAULT_QUANTILE
    coordinates: str = "mean"
    directed: bool = True
    alpha: float = graph.ALPHA
    hot_above: float = 0.20
    max_targets: int = 0
    geojson_limit: int | None = None
    trees: int = 20
    depth: int = 4
    fold_trees: int = 40
    save_model: bool = False


def build_layers(spark: SparkSession, s: Settings) -> None:
    """Run every step; each writes its layer below ``root`` and the next reads it from there."""
    clean_step(spark, s)
    feature_step(spark, s)
    fold_step(spark, s)
    graph_step(spark, s)
    scoring_step(spark, s)
    weight_step(spark, s)
    route_step(spark, s)
    map_step(spark, s)


def _of_region(spark: SparkSession, path: str, region: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("region") == region)


def clean_step(spark: SparkSession, s: Settings) -> None:
    clean = cleaning.clean_counts(readers.csv_strings(spark, s.raw))
    sinks.write_months(clean, f"{s.root}/silver/region={s.region}")


def feature_step(spark: SparkSession, s: Settings) -> None:
    """Features per counting point; rows of the same hour are ordered by their other columns."""
    silver = spark.read.parquet(f"{s.root}/silver/region={s.region}").drop("year")
    rows = silver.withColumn("ts_hour", hour_timestamp(silver, "count_date", "hour"))
    rows = rows.where(F.col("ts_hour").isNotNull())
    ties = ["start_junction_road_name", "end_junction_road_name", "all_motor_vehicles"]
    ties += [c for c in ("direction_of_travel",) if c in rows.columns]
    feeds = []
    if s.event_feed:
        feed = readers.flatten_disruptions(readers.disruption_feed(spark, s.event_feed))
        when = event_time_column(feed)
        feed = feed.select(parse_event_time(when).alias("ts"))
        feeds.append(series.hourly_event_counts(feed, "ts"))
    if s.event_csv:  # the same counts from a table
        feed = readers.csv_strings(spark, s.event_csv)
        when = event_time_column(feed)
        feed = feed.select(parse_event_time(when).alias("ts"))
        feeds.append(series.hourly_event_counts(feed, "ts"))
    gold = series.gold_features(rows, s.region, tie_break=ties, horizon=s.horizon, hourly=feeds)
    sinks.write_region(gold, f"{s.root}/gold/features")


def fold_step(spark: SparkSession, s: Settings) -> None:
    label = f"y_t_plus_{s.horizon}h"
    models = {"LR": learning.linear(label)}
    if s.with_boosting:
        models["GBT"] = learning.boosted(label, maxIter=s.fold_trees)
    gold = _of_region(spark, f"{s.root}/gold/features", s.region)
    scores = learning.walk_forward(
        gold,
        label,
        models,
        n_folds=s.n_folds,
        test_days=s.test_days,
        max_train_rows=s.max_fold_rows,
    )
    sinks.write_csv(scores, f"{s.root}/gold/walkforward_metrics", single_file=True)
    sinks.write_csv(metrics.model_summary(scores), f"{s.root}/gold/model_summary", single_file=True)


def graph_step(spark: SparkSession, s: Settings) -> None:
    """Nodes and links of the rows that have features, as the daily job takes them."""
    links = graph.clean_links(_of_region(spark, f"{s.root}/gold/features", s.region))
    nodes = graph.node_table(links, s.coordinates)
    edges = graph.edge_table(links)
    nodes.write.mode("overwrite").parquet(f"{s.root}/gold/nodes")
    edges.write.mode("overwrite").parquet(f"{s.root}/gold/edges")


def scoring_step(spark: SparkSession, s: Settings) -> None:
    out = f"{s.root}/gold/dashboard"
    label = f"y_t_plus_{s.horizon}h"
    gold = _of_region(spark, f"{s.root}/gold/features", s.region)
    preds, model, n_train = learning.score_last_days(
        gold, label, score_days=s.score_days, max_train_rows=s.max_train_rows, maxIter=s.trees, maxDepth=s.depth
    )
    if s.save_model:
        model.write().overwrite().save(f"{out}/model")
    # The model runs once, here; flags and scores read what was stored.
    preds = preds.persist(StorageLevel.MEMORY_AND_DISK)
    sinks.write_predictions(hotspots.flag_hotspots(preds, s.quantile), f"{out}/predictions")
    preds.unpersist()
    flags = spark.read.parquet(f"{out}/predictions")
    scores = metrics.regression_scores(flags, "y_true", "y_pred").withColumnRenamed(
        "n_rows", "score_rows"
    )
    scores = scores.withColumn("train_rows", F.lit(n_train))
    sinks.write_scores(scores, f"{out}/evaluation", s.quantile)
    sinks.write_csv(hotspots.point_rates(flags), f"{out}/hotspots_map")
    sinks.write_csv(hotspots.time_profile(flags), f"{out}/time_profile", single_file=True)
    hotspots.edge_rates(flags).write.mode("overwrite").parquet(f"{out}/edge_rates")


def weight_step(spark: SparkSession, s: Settings) -> None:
    edges = spark.read.parquet(f"{s.root}/gold/edges")
    rates = spark.read.parquet(f"{s.root}/gold/dashboard/edge_rates")
    weighted = graph.weight_edges(edges, rates, s.alpha)
    if not s.directed:
        weighted = graph.undirected(weighted)
    weighted.write.mode("overwrite").parquet(f"{s.root}/gold/weighted_edges")
    nodes = spark.read.parquet(f"{s.root}/gold/nodes")
    weighted = spark.read.parquet(f"{s.root}/gold/weighted_edges")
    sinks.write_metadata(
        graph.graph_counts(nodes, weighted),
        f"{s.root}/gold/graph_metadata",
        alpha=s.alpha,
        directed=s.directed,
        coordinates=s.coordinates,
    )


def route_step(spark: SparkSession, s: Settings) -> None:
    weighted = spark.read.parquet(f"{s.root}/gold/weighted_edges")
    nodes = spark.read.parquet(f"{s.root}/gold/nodes")
    pairs, found = routes.find_routes(weighted, s.sources, s.targets, s.max_targets)
    compared = routes.compare_routes(pairs, found, s.hot_above)
    sinks.write_run(found, f"{s.root}/gold/route_analysis", s.region, s.run_utc)
    sinks.write_run(compared, f"{s.root}/gold/route_summary", s.region, s.run_utc)
    lines = layers.route_lines(found, nodes, s.hot_above).withColumn("region", F.lit(s.region))
    sinks.write_collection(
        layers.run_features(lines),
        f"{s.root}/gold/route_lines",
        routes.ROUTE,
        limit=None if s.geojson_limit is None else 2 * s.geojson_limit,
    )
    sinks.write_metadata(
        routes.route_counts(pairs),
        f"{s.root}/gold/run_metadata",
        region=s.region,
        run_utc=s.run_utc,
        from_nodes=",".join(s.sources),
        hotspot_threshold=s.hot_above,
    )


def map_step(spark: SparkSession, s: Settings) -> None:
    """Export the newest run and draw both map layers from the stored tables."""
    runs = readers.latest_committed(spark, f"{s.root}/gold/route_analysis", s.region)
    newest = runs.drop("region", "run_utc")
    newest.write.mode("overwrite").parquet(f"{s.root}/gold/exports/routes_edges")
    stored = readers.latest_routes(spark, f"{s.root}/gold", s.region)
    nodes = spark.read.parquet(f"{s.root}/gold/nodes")
    drawn = layers.layer_features(layers.route_layer(stored, nodes, s.hot_above))
    sinks.write_collection(drawn, f"{s.root}/map/routes", routes.ROUTE)
    lines = layers.hotspot_lines(
        spark.read.parquet(f"{s.root}/gold/dashboard/edge_rates"),
        spark.read.parquet(f"{s.root}/gold/weighted_edges"),
        nodes,
    )
    sinks.write_collection(
        layers.hotspot_features(lines), f"{s.root}/map/hotspots", routes.PAIR
    )
