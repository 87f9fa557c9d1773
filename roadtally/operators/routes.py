"""Routes as edge rows, their statistics, and the comparison of the two routes of a pair.

A route table has one row per edge: ``from_node, to_node, route, step, src, dst`` and the
values of the edge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from roadtally.operators.paths import (
    AVOIDING,
    KEPT_ROWS,
    SHORTEST,
    all_targets,
    entered_nodes,
    path_steps,
    reachability,
    require_nodes,
    shortest_paths,
    tree_steps,
)
from roadtally.operators.road_search import pair_tree
from roadtally.session import broadcast_if_small, cut_lineage, stored

PAIR = ("from_node", "to_node")
ROUTE = (*PAIR, "route")

# The three explanations of a changed route.
SAME_PATH = "No change (same path)"
BYPASSED = "Avoid-route changed to bypass higher-risk edges on the shortest route."
EQUAL_COST = (
    "Avoid-route changed, but removed edges were not above threshold "
    "(graph tie/alternative equal cost)."
)
TOP_RISKY = 5


def with_edge_values(steps: DataFrame, edges: DataFrame) -> DataFrame:
    """Look up each step's edge in a stored table.

    A missing weight is the length, a missing penalty is what weight and length differ by.
    """
    values = ["length_km", "hotspot_rate", "weight_km", "penalty_km"]
    have = [c for c in values if c in edges.columns]
    looked_up = broadcast_if_small(edges.select("src", "dst", *have), KEPT_ROWS, stored=True)
    rows = steps.join(looked_up, ["src", "dst"], "left")
    given = {c: F.col(c) if c in have else F.lit(None).cast("double") for c in values}
    length = F.coalesce(given["length_km"], F.lit(0.0))
    weight = F.coalesce(given["weight_km"], length)
    return rows.select(
        *steps.columns,
        length.alias("length_km"),
        F.coalesce(given["hotspot_rate"], F.lit(0.0)).alias("hotspot_rate"),
        weight.alias("weight_km"),
        F.coalesce(given["penalty_km"], weight - length).alias("penalty_km"),
    )


def find_routes(
    edges: DataFrame,
    sources: Sequence[str],
    targets: Sequence[str] | None = None,
    max_targets: int = 0,
    whole: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(pairs, routes)`` from each source to the named targets, or to all other nodes.

    ``pairs`` has a ``reachable`` flag; ``routes`` holds both routes of every reachable pair.
    ``whole`` are the nodes of the network where ``edges`` are made of its leavable links only; they
    need not be stored, as routes to all nodes are found without them.
    """
    spark = edges.sparkSession
    edges, _ = stored(edges, "edges")
    own = entered_nodes(edges) if whole is None else None
    nodes = own if whole is None else whole
    starts = spark.createDataFrame([(s,) for s in sources], "source string")
    if targets is None:
        wanted = all_targets(edges, sources, max_targets, nodes)
    else:
        wanted = spark.createDataFrame(
            [(s, t) for s in sources for t in targets], "source string, target string"
        )
        require_nodes(edges, wanted, "target", own, whole)
    tree = shortest_paths(edges, starts, is_stored=True, nodes=own, whole=whole)
    return _route_tables(tree, wanted, edges, every=targets is None and max_targets <= 0)


def routes_between(
    edges: DataFrame, wanted: DataFrame, whole: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`find_routes` for a table of pairs, ``source, target``; nothing else is searched for."""
    edges, _ = stored(edges, "edges")
    wanted = cut_lineage(wanted.select("source", "target").distinct())
    tree = cut_lineage(pair_tree(edges, wanted, is_stored=True, whole=whole))
    return _route_tables(tree, wanted, edges)


def _route_tables(
    tree: DataFrame, wanted: DataFrame, edges: DataFrame, every: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``every`` says that all nodes but the sources are wanted, which the tree tells by itself."""
    pairs = reachability(tree, wanted).select(
        F.col("source").alias("from_node"), F.col("target").alias("to_node"), "reachable"
    )
    # Only edges of the tree are looked up; all others would be measured and shuffled for nothing.
    taken = tree.where("pred is not null").select(F.col("pred").alias("src"), F.col("node").alias("dst")).distinct()
    used = cut_lineage(edges.join(broadcast_if_small(taken, KEPT_ROWS), ["src", "dst"], "left_semi").select(edges.columns))
    # Values are looked up once for a node of the tree, not for each route that passes it.
    last_steps = cut_lineage(with_edge_values(tree_steps(tree), used))
    steps = path_steps(tree, None if every else wanted, last_steps).withColumnsRenamed(
        {"source": "from_node", "target": "to_node", "metric": "route"}
    )
    return pairs, cut_lineage(steps)


def _stats(hot_above: float, on: Column | None = None) -> dict[str, Column]:
    """Path statistics over the rows where ``on`` holds; an empty path gives zeros."""

    def pick(value: Column | str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return value if on is None else F.when(on, value)

    def or_zero(col: Column) -> Column:
        return F.coalesce(col, F.lit(0.0))

    hot = (F.col("hotspot_rate") > hot_above).cast("int")
    return {
        "len_km": or_zero(F.sum(pick("length_km"))),
        "weight_km": or_zero(F.sum(pick("weight_km"))),
        "penalty_km": or_zero(F.sum(pick("penalty_km"))),
        "n_edges": F.count(pick("src")),
        "hot_edges": F.coalesce(F.sum(pick(hot)), F.lit(0).cast("bigint")),
        "hot_share_pct": or_zero(F.avg(pick(hot)) * 100.0),
        "avg_hotspot": or_zero(F.avg(pick("hotspot_rate"))),
        "max_hotspot": or_zero(F.max(pick("hotspot_rate"))),
    }


def route_stats(routes: DataFrame, hot_above: float = 0.0) -> DataFrame:
    return routes.groupBy(*ROUTE).agg(
        *[c.alias(name) for name, c in _stats(hot_above).items()]
    )


def pair_edges(routes: DataFrame) -> DataFrame:
    """One row per pair and edge, with the steps it takes in either route."""

    def step_in(route: str) -> Column:
        return F.min(F.when(F.col("route") == route, F.col("step")))

    values = ("length_km", "hotspot_rate", "weight_km", "penalty_km")
    return routes.groupBy(*PAIR, "src", "dst").agg(
        step_in(SHORTEST).alias("short_step"),
        step_in(AVOIDING).alias("avoid_step"),
        *[F.max(v).alias(v) for v in values],
    )


_REMOVED = "short_step is not null and avoid_step is null"
_ADDED = "avoid_step is not null and short_step is null"


def removed_edges(routes: DataFrame) -> DataFrame:
    """Edges of the shortest route that the avoiding route leaves out."""
    return pair_edges(routes).where(_REMOVED).drop("avoid_step")


def added_edges(routes: DataFrame) -> DataFrame:
    """Edges of the avoiding route that the shortest route lacks."""
    return pair_edges(routes).where(_ADDED).drop("short_step")


def _risky(hot_above: float) -> Column:
    return (F.col("hotspot_rate") > hot_above) | (F.col("penalty_km") > 0)


def top_risky(removed: DataFrame, hot_above: float = 0.0, k: int = TOP_RISKY) -> DataFrame:
    """Per pair the ``k`` removed edges of highest penalty, rate and length, ranked.

    Spark applies the rank limit before the shuffle as well.
    """
    worst = Window.partitionBy(*PAIR).orderBy(
        F.desc("penalty_km"), F.desc("hotspot_rate"), F.desc("length_km"), "short_step"
    )
    ranked = removed.where(_risky(hot_above)).withColumn("rank", F.row_number().over(worst))
    return ranked.where(F.col("rank") <= k)


def risky_text(top: DataFrame) -> DataFrame:
    line = F.format_string(
        "%s->%s (risk=%.3f, penalty=%.3f)", "src", "dst", "hotspot_rate", "penalty_km"
    )
    lines = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    return top.groupBy(*PAIR).agg(
        F.array_join(lines["line"], "; ").alias("explain_removed_risky_top5")
    )


def compare_routes(pairs: DataFrame, routes: DataFrame, hot_above: float = 0.0) -> DataFrame:
    """One row per pair: both routes' statistics, their differences and the explanation.

    Pairs without a path keep their row with ``reachable`` false and no values.
    """
    edges = pair_edges(routes)
    short, avoid = F.col("short_step").isNotNull(), F.col("avoid_step").isNotNull()
    stats = [
        c.alias(f"{side}_{name}")
        for side, on in (("short", short), ("avoid", avoid))
        for name, c in _stats(hot_above, on).items()
    ]
    gone = F.expr(_REMOVED)
    summary = edges.groupBy(*PAIR).agg(
        *stats,
        F.count_if(gone).alias("explain_removed_edges"),
        F.count_if(gone & _risky(hot_above)).alias("explain_removed_risky_edges"),
        F.count_if(F.expr(_ADDED)).alias("added_edges"),
    )
    named = [c for c in summary.columns if c not in PAIR]
    # A pair of a node with itself is reached by a path without edges: zeros throughout.
    zeros = [
        F.when(F.col("reachable"), F.coalesce(c, F.lit(0).cast(t))).alias(c)
        for c, t in summary.dtypes
        if c in named
    ]
    rows = pairs.join(summary, list(PAIR), "left").select(*PAIR, "reachable", *zeros)
    reason = (
        F.when(F.col("explain_removed_edges") == 0, SAME_PATH)
        .when(F.col("explain_removed_risky_edges") > 0, BYPASSED)
        .when(F.col("reachable"), EQUAL_COST)
    )
    changed = F.col("explain_removed_edges") + F.col("added_edges")
    compared = rows.withColumns(
        {
            "same_path": changed == 0,
            "delta_len_km": F.col("avoid_len_km") - F.col("short_len_km"),
            "delta_weight_km": F.col("avoid_weight_km") - F.col("short_weight_km"),
            "delta_hot_edges": F.col("short_hot_edges") - F.col("avoid_hot_edges"),
            "hot_share_reduction": F.col("short_hot_share_pct") - F.col("avoid_hot_share_pct"),
            "avg_hotspot_reduction": F.col("short_avg_hotspot") - F.col("avoid_avg_hotspot"),
            "max_hotspot_reduction": F.col("short_max_hotspot") - F.col("avoid_max_hotspot"),
            "explain_reason": reason,
        }
    )
    text = risky_text(top_risky(edges.where(_REMOVED), hot_above))
    told = F.when(F.col("reachable"), F.coalesce("explain_removed_risky_top5", F.lit("")))
    return compared.join(text, list(PAIR), "left").withColumn("explain_removed_risky_top5", told)


def hot_edges(routes: DataFrame, hot_above: float = 0.0) -> DataFrame:
    """The steps of each route that are hotspots."""
    return routes.where(F.col("hotspot_rate") > hot_above)


def route_points(routes: DataFrame) -> DataFrame:
    """The nodes along each route: step 0 is the start, step n the end of edge n.

    Edge values go with the node the edge leads to.
    """
    arrival = F.struct(
        "step", F.col("dst").alias("node"), *["length_km", "weight_km", "hotspot_rate"]
    )
    nothing = [F.lit(None).cast("double").alias(c) for c in ("length_km", "weight_km", "hotspot_rate")]
    start = F.struct(F.lit(0).alias("step"), F.col("src").alias("node"), *nothing)
    points = F.when(F.col("step") == 1, F.array(start, arrival)).otherwise(F.array(arrival))
    return routes.select(*ROUTE, F.inline(points))


def path_text(routes: DataFrame) -> DataFrame:
    """Each route's nodes in order, as ``a -> b -> c``."""
    nodes = F.sort_array(F.collect_list(F.struct("step", "node")))
    return route_points(routes).groupBy(*ROUTE).agg(F.array_join(nodes["node"], " -> ").alias("path"))


def route_counts(pairs: DataFrame) -> DataFrame:
    """How many targets were attempted and how many of them were reached."""
    return pairs.agg(
        F.count(F.lit(1)).alias("targets_attempted"),
        F.count_if("reachable").alias("targets_reached"),
    )
