"""Map layers: hotspot lines, route lines, and what the map reads off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from roadtally.functions.geojson import line_feature, position
from roadtally.operators.paths import climb
from roadtally.operators.routes import PAIR, ROUTE, route_points
from roadtally.operators.trails import forked_trails
from roadtally.session import broadcast_if_small, cut_lineage

ALL_ROUTES = "ALL"


def hotspot_lines(
    rates: DataFrame, edges: DataFrame | None, nodes: DataFrame, min_rate: float = 0.0
) -> DataFrame:
    """One row per hotspot edge with its end positions, NULL where a node has none.

    ``n_rows`` counts the observations of the edge, ``n_scored`` those behind the rate. Without
    ``edges`` the rates carry the values of their edge, and ``n_scored`` under its name.
    """
    shown = rates.where(F.col("hotspot_rate") >= min_rate)
    if edges is None:
        whole = F.col("from_node").isNotNull() & F.col("to_node").isNotNull()
        own = ("n_rows", "length_km", "weight_km")
        rows = shown.select(
            *[F.when(whole, F.col(c)).alias(c) if c in own else F.col(c) for c in shown.columns], whole.alias("known")
        )
    else:
        if "n_rows" in shown.columns:
            shown = shown.withColumnRenamed("n_rows", "n_scored")
        values = [c for c in edges.columns if c in ("n_rows", "length_km", "weight_km")]
        known = edges.select(
            F.col("src").alias("from_node"), F.col("dst").alias("to_node"), F.lit(True).alias("known"), *values
        )
        rows = shown.join(known, list(PAIR), "left")
    places = broadcast_if_small(nodes.select("node_id", "lon", "lat"))
    for end, name in (("src", "from_node"), ("dst", "to_node")):
        here = places.select(
            F.col("node_id").alias(name), F.col("lon").alias(f"{end}_lon"), F.col("lat").alias(f"{end}_lat")
        )
        rows = rows.join(here, name, "left")
    placed = F.coalesce("known", F.lit(False))
    for c in ("src_lon", "src_lat", "dst_lon", "dst_lat"):
        placed = placed & F.col(c).isNotNull()
    return rows.withColumn("placed", placed).drop("known")


def hotspot_features(lines: DataFrame) -> DataFrame:
    """GeoJSON features of the lines whose ends are known; absent extras are left out."""
    extras = ["avg_pred", "n_scored", "n_rows", "length_km", "weight_km"]
    properties = [*PAIR, "hotspot_rate", *[c for c in extras if c in lines.columns]]
    ends = F.array(position("src_lon", "src_lat"), position("dst_lon", "dst_lat"))
    return lines.where("placed").select(*PAIR, line_feature(ends, properties).alias("feature"))


def layer_counts(lines: DataFrame) -> DataFrame:
    """Features that can be drawn and rows dropped for want of a position, in one pass."""
    return lines.agg(
        F.count_if("placed").alias("n_features"), F.count_if(~F.col("placed")).alias("n_dropped")
    )


def _drawn(routes: DataFrame, nodes: DataFrame, hot_above: float) -> DataFrame:
    """Per route: its positions in order and the sums over its edges, in one aggregation."""
    points = route_points(routes)
    passed = broadcast_if_small(points.select(F.col("node").alias("node_id")).distinct())
    # As a filter on the key it is applied before positions are grouped, if they are not yet.
    on_routes = nodes.select("node_id", "lon", "lat").join(passed, "node_id", "left_semi")
    points = points.join(broadcast_if_small(on_routes.withColumnRenamed("node_id", "node")), "node", "left")
    has_place = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    spot = F.when(has_place, F.struct("step", position("lon", "lat").alias("at")))
    return points.groupBy(*ROUTE).agg(
        F.sort_array(F.collect_list(spot))["at"].alias("coordinates"),
        F.count_if(~has_place).alias("n_unplaced"),
        F.bool_or(has_place & (F.col("node") == F.col("from_node"))).alias("start_placed"),
        F.bool_or(has_place & (F.col("node") == F.col("to_node"))).alias("end_placed"),
        F.count("length_km").alias("n_edges"),
        F.sum("length_km").alias("length_km"),
        F.sum("weight_km").alias("weight_km"),
        F.avg("hotspot_rate").alias("hotspot_mean"),
        F.max("hotspot_rate").alias("hotspot_max"),
        F.count_if(F.col("hotspot_rate") > hot_above).alias("hot_edges"),
    )


def route_lines(routes: DataFrame, nodes: DataFrame, hot_above: float = 0.0) -> DataFrame:
    """Route rows for drawing; only routes whose every node has a position are ``placed``."""
    return _drawn(routes, nodes, hot_above).withColumn("placed", F.col("n_unplaced") == 0)


def route_layer(routes: DataFrame, nodes: DataFrame, hot_above: float = 0.0) -> DataFrame:
    """Route rows for the map: nodes without a position are skipped.

    A route is ``placed`` when both its ends are known and two positions are left.
    """
    ends = F.coalesce("start_placed", F.lit(False)) & F.coalesce("end_placed", F.lit(False))
    return _drawn(routes, nodes, hot_above).withColumns(
        {
            "placed": ends & (F.size("coordinates") >= 2),
            "route_id": F.concat_ws("__", *ROUTE),
        }
    )


def run_features(lines: DataFrame) -> DataFrame:
    """Features of a route run, with the property names of the run's own export."""
    properties: list[Column | str] = [
        F.col("from_node").alias("from"),
        F.col("to_node").alias("to"),
        "route",
        "length_km",
        "weight_km",
        "hot_edges",
    ]
    if "region" in lines.columns:
        properties.insert(0, "region")
    feature = line_feature(F.col("coordinates"), properties)
    return lines.where("placed").select(*ROUTE, feature.alias("feature"))


def layer_features(layer: DataFrame) -> DataFrame:
    """Features of the map's route layer."""
    properties = [
        "route_id",
        "route",
        *PAIR,
        "n_edges",
        "length_km",
        "weight_km",
        "hotspot_mean",
        "hotspot_max",
    ]
    feature = line_feature(F.col("coordinates"), properties)
    return layer.where("placed").select(*ROUTE, feature.alias("feature"))


def order_steps(rows: DataFrame, order: str) -> DataFrame:
    """Number the steps of routes that came as unordered edge rows.

    From the start of a route the first unused edge out of the current node is taken, in the
    order of the column ``order``, until the end is reached.  Result: ``from_node, to_node,
    route, step, node`` with step 0 for the start.  A route that does not reach its end this
    way keeps the order of its rows.

    Where no node has two ways out, as on every shortest path, links are followed with doubling
    steps.  The loops and chains of the other routes are spliced (``forked_trails``).
    """
    keys = list(ROUTE)
    edges = cut_lineage(
        rows.groupBy(*keys, "src", "dst").agg(F.min(order).alias("place"))
    )
    out = Window.partitionBy(*keys, "src").orderBy("place")
    edges = edges.withColumn("nth", F.row_number().over(out)).where("src <> to_node")
    forked = edges.where("nth > 1").select(*keys).distinct()

    plain = edges.join(forked, keys, "left_anti").select(
        *keys, F.col("src").alias("node"), F.col("dst").alias("up")
    )
    starts = plain.select(*keys, F.col("from_node").alias("node")).distinct()
    longest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    walked = climb(starts, plain, keys, longest).withColumnRenamed("offset", "step")
    if not forked.isEmpty():
        walked = walked.unionByName(forked_trails(edges.join(forked, keys, "left_semi"), keys))
    walked = cut_lineage(walked)

    arrived = walked.where("node = to_node").groupBy(*keys).agg(F.min("step").alias("last"))
    chained = walked.join(arrived, keys).where("step <= last").drop("last")
    numbered = Window.partitionBy(*keys).orderBy(order)
    in_order = (
        rows.join(arrived, keys, "left_anti")
        .withColumn("_n", F.row_number().over(numbered))
        .select(
            *keys,
            F.inline(
                F.when(
                    F.col("_n") == 1,
                    F.array(
                        F.struct(F.lit(0).alias("step"), F.col("src").alias("node")),
                        F.struct(F.col("_n").alias("step"), F.col("dst").alias("node")),
                    ),
                ).otherwise(
                    F.array(F.struct(F.col("_n").alias("step"), F.col("dst").alias("node")))
                )
            ),
        )
    )
    return chained.select(*keys, "step", "node").unionByName(in_order)


def route_layer_from_rows(rows: DataFrame, nodes: DataFrame, order: str) -> DataFrame:
    """The map's route layer from unordered edge rows; sums cover every row of the route."""
    places = broadcast_if_small(nodes.select(F.col("node_id").alias("node"), "lon", "lat"))
    has_place = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    spot = F.when(has_place, F.struct("step", position("lon", "lat").alias("at")))
    shape = (
        order_steps(rows, order)
        .join(places, "node", "left")
        .groupBy(*ROUTE)
        .agg(F.sort_array(F.collect_list(spot))["at"].alias("coordinates"))
    )
    sums = rows.groupBy(*ROUTE).agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.sum("length_km").alias("length_km"),
        F.sum("weight_km").alias("weight_km"),
        F.avg("hotspot_rate").alias("hotspot_mean"),
        F.max("hotspot_rate").alias("hotspot_max"),
    )
    layer = sums.join(shape, list(ROUTE), "left")
    ends = F.lit(True)
    for name in PAIR:
        here = places.where(has_place).select(F.col("node").alias(name), F.lit(True).alias(f"_{name}"))
        layer = layer.join(here, name, "left")
        ends = ends & F.coalesce(f"_{name}", F.lit(False))
    return layer.select(
        *sums.columns,
        "coordinates",
        (ends & (F.size("coordinates") >= 2)).alias("placed"),
        F.concat_ws("__", *ROUTE).alias("route_id"),
    )


def route_options(layer: DataFrame) -> DataFrame:
    """What the map offers to choose from: destinations and route types, each sorted."""
    values = F.array(
        F.struct(F.lit("destination").alias("kind"), F.col("to_node").alias("value")),
        F.struct(F.lit("route").alias("kind"), F.col("route").alias("value")),
    )
    return (
        layer.select(F.inline(values))
        .where("value <> ''")
        .distinct()
        .orderBy("kind", "value")
    )


def select_routes(
    layer: DataFrame, to_node: str | None = None, route: str = ALL_ROUTES
) -> DataFrame:
    """The routes shown for a destination and a route type; ``ALL`` keeps both types."""
    if to_node:
        layer = layer.where(F.col("to_node") == to_node)
    return layer if route == ALL_ROUTES else layer.where(F.col("route") == route)


def first_route(layer: DataFrame, by: str = "route_id") -> DataFrame:
    """Length and weight of the first route shown for each destination."""
    return layer.groupBy("to_node").agg(
        F.min_by("length_km", by).alias("length_km"), F.min_by("weight_km", by).alias("weight_km")
    )
