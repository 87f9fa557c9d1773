"""Shortest paths from many sources at once, for several cost columns at once.

The search keeps one row per (source, metric, node) with the best distance so far and the
node it was reached from.  Whole paths are never carried through the rounds; they are unrolled
afterwards for the wanted targets, in a number of joins logarithmic in the longest path.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from roadtally.operators.graph import graph_nodes
from roadtally.session import (
    broadcast_if_small,
    cut_and_measure,
    cut_lineage,
    cut_to_few_tasks,
    fits,
    stored,
)

# The two routes that are compared and the edge column each minimises.
SHORTEST = "shortest_distance"
AVOIDING = "avoid_hotspots"
ROUTE_COSTS = {SHORTEST: "length_km", AVOIDING: "weight_km"}

TREE_KEYS = ("source", "metric", "node")

# What a round of a search improved is broadcast up to so many rows: the driver holds those of several
# rounds until it collects its garbage.
BROADCAST_ROWS = 100_000
# The same for tables of which several are broadcast at once: the state, every hop of a climb, values of edges.
KEPT_ROWS = 40_000
# A table that one join of many arcs needs is broadcast up to so many bytes of values.
ONCE_BYTES = 8_000_000
# Up to so many rows the whole state of a search is rewritten each round; above, only once
# so many parts have gathered beside it.
MERGE_ROWS = 2_000_000
MAX_PARTS = 16
# Below so many rows of state all candidates of a round are ordered sooner than a broadcast is made.
SORTED_ROWS = 20_000
# Arcs that cannot be entered are dropped again while a round keeps less than this share.
KEPT_SHARE = 0.75


def entered_nodes(edges: DataFrame) -> DataFrame:
    """``node_id, entered`` of all nodes, stored: whether an arc leads there from another node.

    Made by one scan, for all that asks for nodes of the same edges.
    """
    ends = F.array(
        F.struct(F.col("src").alias("node_id"), F.lit(False).alias("entered")),
        F.struct(F.col("dst").alias("node_id"), F.coalesce(F.col("src") != F.col("dst"), F.lit(False)).alias("entered")),
    )
    return cut_lineage(edges.select(F.inline(ends)).groupBy("node_id").agg(F.max("entered").alias("entered")))


def linked_heads(links: DataFrame) -> DataFrame:
    """:func:`entered_nodes` of the nodes that links lead to, stored; nodes that links only leave are not grouped."""
    entered = F.coalesce(F.col("src") != F.col("dst"), F.lit(False))
    return cut_to_few_tasks(links.groupBy(F.col("dst").alias("node_id")).agg(F.max(entered).alias("entered")))


def with_tails(heads: DataFrame, links: DataFrame) -> DataFrame:
    """The ids of all nodes of ``links``, whose :func:`linked_heads` are known; made only if something asks for them."""
    return heads.select("node_id").unionByName(links.select(F.col("src").alias("node_id"))).distinct()


def require_nodes(
    edges: DataFrame, wanted: DataFrame, column: str, nodes: DataFrame | None = None, whole: DataFrame | None = None
) -> None:
    """An error if some ``column`` of ``wanted`` is no node; ``nodes`` are the edges' :func:`entered_nodes`.

    Nodes of ``whole`` count as well; it is asked only for those that the edges lack.
    """
    ids = broadcast_if_small(wanted.select(F.col(column).alias("node_id")).distinct())
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node_id")) if nodes is None else nodes.select("node_id")
    lacking = lambda have: ids.join(have.join(ids, "node_id", "left_semi").distinct(), "node_id", "left_anti")
    strangers = lacking(ends).take(5)
    if strangers and whole is not None:
        strangers = lacking(ends.unionByName(whole.select("node_id"))).take(5)
    if strangers:
        raise ValueError(f"{column} not in the graph: {[r.node_id for r in strangers]}")


def leavable(links: DataFrame, sources: Sequence[str] | DataFrame, nodes: DataFrame) -> DataFrame:
    """The links that leave a source or a node that is entered; no search from the sources takes others.

    Chosen before links are grouped to edges, so that only edges a search may take are made.
    ``nodes`` are the :func:`entered_nodes` of all links; ``sources`` may be a table of one column.
    """
    if isinstance(sources, DataFrame):
        begin = sources.select(F.col(sources.columns[0]).alias("src"))
    else:
        begin = links.sparkSession.createDataFrame([(s,) for s in sources], "src string")
    entered = nodes.where("entered").select(F.col("node_id").alias("src")).unionByName(begin).distinct()
    return links.join(broadcast_if_small(entered, max_bytes=ONCE_BYTES), "src", "left_semi").select(links.columns)


def stored_arcs(edges: DataFrame, costs: dict[str, str], is_stored: bool = False) -> DataFrame:
    """Arcs with one cost per metric, materialised; a negative or missing cost is an error.

    ``is_stored`` says that ``edges`` reads a stored table, which is then not stored again.
    """
    arcs = edges.select("src", "dst", *[F.col(c).cast("double").alias(m) for m, c in costs.items()])
    measures = {m: F.count_if(~F.coalesce(F.col(m) >= 0, F.lit(False))) for m in costs}
    if is_stored:
        wrong = arcs.agg(*[c.alias(m) for m, c in measures.items()]).first().asDict()
    else:
        arcs, wrong = stored(arcs, "arcs", **measures)
    if any(wrong.values()):
        raise ValueError(f"negative or missing costs: {wrong}")
    return arcs


def enterable_arcs(arcs: DataFrame, starts: DataFrame, column: str = "source", nodes: DataFrame | None = None) -> DataFrame:
    """The arcs that a search from ``starts`` may take, stored; arcs from a node to itself are left out.

    An arc is dropped if it leaves a node that no arc enters and that is no start. This is repeated
    while it drops a quarter of the arcs, so all rounds together cost a few scans of ``arcs``, which
    every round of a search would read otherwise. ``nodes`` are the arcs' :func:`entered_nodes`.
    """
    arcs, left, before = arcs.where("src <> dst"), None, None
    begin = starts.select(F.col(column).alias("src"))
    while before is None or left < KEPT_SHARE * before:
        before = arcs.count() if left is None else left
        heads = arcs.select(F.col("dst").alias("src"))
        if left is None and nodes is not None:
            heads = nodes.where("entered").select(F.col("node_id").alias("src"))
        entered = heads.unionByName(begin).distinct()
        arcs, seen = cut_and_measure(
            arcs.join(broadcast_if_small(entered, max_bytes=ONCE_BYTES), "src", "left_semi").select(arcs.columns),
            n=F.count(F.lit(1)),
        )
        left = seen["n"]
    return arcs


def _best(parts: Sequence[DataFrame]) -> DataFrame:
    """The best row per key; the map-side part reduces many arcs into one busy node."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*TREE_KEYS).agg(F.min("best").alias("best"))


def _not_longer(reached: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """The candidates that are no longer than any way their node has; the others need not be ordered.

    Equal ones stay: hops and ids decide among them.
    """
    known = [p.select(*TREE_KEYS, F.col("best.dist").alias("held")) for p in parts]
    held = known[0] if len(known) == 1 else reduce(DataFrame.unionByName, known).groupBy(*TREE_KEYS).agg(F.min("held").alias("held"))
    kept = reached.join(F.broadcast(held), list(TREE_KEYS), "left")
    return kept.where(F.col("held").isNull() | (F.col("best.dist") <= F.col("held"))).select(*TREE_KEYS, "best")


def shortest_paths(
    edges: DataFrame, sources: DataFrame, costs: dict[str, str] = ROUTE_COSTS, is_stored: bool = False,
    nodes: DataFrame | None = None, whole: DataFrame | None = None,
) -> DataFrame:
    """``source, metric, node, dist, hops, pred`` for every node that can be reached.

    Ties go to fewer hops, then to the smaller predecessor id, so the result is unique.
    Each round relaxes only the arcs that leave rows improved in the round before.  Those rows
    are broadcast to the arcs while they are few; beyond that it is a shuffle join, and AQE
    splits the arcs of a node that has very many.  Rounds are bounded by the longest best path.

    While the state is small, every round merges into it with one aggregation, and the job
    that writes the new state also counts what improved.  Candidates longer than what their node
    has are dropped before that where the state is worth a broadcast and can be broadcast.  A large state is left in place: the
    few candidates of a round are broadcast to it, only rows they meet are compared, and what
    improved is kept beside it as another part. ``nodes`` are the edges' :func:`entered_nodes`;
    ``whole`` are those of the network where ``edges`` are made of its :func:`leavable` links only.
    """
    arcs = stored_arcs(edges, costs, is_stored)
    require_nodes(arcs, sources, "source", nodes, whole)
    arcs = enterable_arcs(arcs, sources, nodes=nodes)
    step_cost = F.lit(None).cast("double")
    for metric in costs:
        step_cost = F.when(F.col("metric") == metric, F.col(metric)).otherwise(step_cost)

    start = F.struct(
        F.lit(0.0).alias("dist"),
        F.lit(0).alias("hops"),
        F.lit(None).cast("string").alias("pred"),
        F.lit(0).alias("round"),
    )
    state, seen = cut_and_measure(
        sources.select("source")
        .distinct()
        .select(
            "source",
            F.explode(F.array(*[F.lit(m) for m in costs])).alias("metric"),
            F.col("source").alias("node"),
            start.alias("best"),
        ),
        n=F.count(F.lit(1)),
    )
    parts, n_rows = [state], seen["n"]
    improved, n_improved = state, seen["n"]
    turn = 0
    while n_improved:
        turn += 1
        if n_improved <= BROADCAST_ROWS:
            improved = F.broadcast(improved)
        reached = improved.join(arcs, F.col("node") == F.col("src")).select(
            "source",
            "metric",
            F.col("dst").alias("node"),
            F.struct(
                (F.col("best.dist") + step_cost).alias("dist"),
                (F.col("best.hops") + 1).alias("hops"),
                F.col("node").alias("pred"),
                F.lit(turn).alias("round"),
            ).alias("best"),
        )
        newest = F.col("best.round") == turn
        merge = n_rows <= MERGE_ROWS
        if SORTED_ROWS <= n_rows <= KEPT_ROWS:
            reached = _not_longer(reached, parts)
        if not merge:
            reached, seen = cut_and_measure(_best([reached]), n=F.count(F.lit(1)))
            merge = seen["n"] > BROADCAST_ROWS or len(parts) >= MAX_PARTS
        if merge:
            state, seen = cut_and_measure(
                _best([*parts, reached]), n=F.count(F.lit(1)), improved=F.count_if(newest)
            )
            parts, n_rows = [state], seen["n"]
            improved, n_improved = state.where(newest), seen["improved"]
        else:
            known = reduce(DataFrame.unionByName, parts)
            met = known.join(F.broadcast(reached.select(*TREE_KEYS)), list(TREE_KEYS), "left_semi")
            improved, seen = cut_and_measure(
                _best([met, reached]).where(newest), n=F.count(F.lit(1))
            )
            parts.append(improved)
            n_rows, n_improved = n_rows + seen["n"], seen["n"]
    state = parts[0] if len(parts) == 1 else cut_lineage(_best(parts))
    return state.select(*TREE_KEYS, "best.dist", "best.hops", "best.pred")


def climb(starts: DataFrame, links: DataFrame, keys: Sequence[str], longest: int) -> DataFrame:
    """Follow links from each start: rows of ``starts`` repeated per node on the way, ``offset``.

    ``links`` gives for (keys, node) at most one next node ``up``.  Link length doubles each
    round, so a way of n nodes takes about log2(n) rounds.  Many starts share the nodes near a
    trunk: the links are broadcast if few, else AQE splits the starts of a busy node.
    """
    on = [*keys, "node"]
    jump = cut_lineage(links.select(*on, "up"))
    small = fits(jump, KEPT_ROWS)
    rows = starts.withColumn("offset", F.lit(0))
    reach = 1
    while reach <= longest:
        hop = F.broadcast(jump) if small else jump
        both = F.array(
            F.struct("node", "offset"),
            F.struct(F.col("up").alias("node"), (F.col("offset") + reach).alias("offset")),
        )
        rows = rows.join(hop, on, "left").select(
            *starts.drop("node").columns,
            F.inline(F.when(F.col("up").isNull(), F.slice(both, 1, 1)).otherwise(both)),
        )
        reach *= 2
        if reach <= longest:
            further = jump.select(*keys, F.col("node").alias("up"), F.col("up").alias("top"))
            further = F.broadcast(further) if small else further
            jump = cut_lineage(
                jump.join(further, [*keys, "up"]).select(*on, F.col("top").alias("up"))
            )
    return rows


def tree_steps(tree: DataFrame) -> DataFrame:
    """``source, metric, node, step, src, dst``: the last edge of the best path to each node."""
    return tree.where("hops > 0").select(*TREE_KEYS, F.col("hops").alias("step"), F.col("pred").alias("src"), F.col("node").alias("dst"))


def path_steps(tree: DataFrame, targets: DataFrame | None, last_steps: DataFrame | None = None) -> DataFrame:
    """Edge rows ``source, target, metric, step, src, dst`` of the best path to each target.

    ``targets`` holds (source, target) pairs; a pair without a path yields no rows. Without it all
    nodes but the sources are targets. ``last_steps`` are the :func:`tree_steps` in a stored table, with
    any values that the rows are to carry: a table of nodes, which is far smaller than that of steps.
    """
    longest = tree.agg(F.max("hops")).first()[0] or 0
    keys = ["source", "metric"]
    starts = tree.select(*keys, F.col("node").alias("target"), "node")
    if targets is None:
        starts = starts.where("source <> target")
    else:
        starts = starts.join(broadcast_if_small(targets.distinct(), max_bytes=ONCE_BYTES), ["source", "target"])
    links = tree.where("pred is not null").select(*TREE_KEYS, F.col("pred").alias("up"))
    nodes = climb(starts, links, keys, longest).drop("offset")
    steps = tree_steps(tree) if last_steps is None else last_steps
    values = [c for c in steps.columns if c not in TREE_KEYS]
    return nodes.join(broadcast_if_small(steps, KEPT_ROWS, stored=True), list(TREE_KEYS)).select(
        "source", "target", "metric", *values
    )


def all_targets(
    edges: DataFrame, sources: Sequence[str], max_targets: int = 0, nodes: DataFrame | None = None
) -> DataFrame:
    """Every other node as a target of each named source, or the first few by node id."""
    pairs = (
        (graph_nodes(edges) if nodes is None else nodes)
        .select(
            F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"),
            F.col("node_id").alias("target"),
        )
        .where("source <> target")
    )
    if max_targets <= 0:
        return pairs
    order = Window.partitionBy("source").orderBy("target")
    nth = pairs.withColumn("_nth", F.row_number().over(order))
    return nth.where(F.col("_nth") <= max_targets).drop("_nth")


def reachability(tree: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each requested pair with the flag whether every metric found a path."""
    found = tree.select("source", F.col("node").alias("target")).distinct()
    return pairs.join(
        found.withColumn("reachable", F.lit(True)), ["source", "target"], "left"
    ).fillna({"reachable": False})
