"""Trails through routes with forks: loops and chains are spliced before anything is walked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from roadtally.session import cut_lineage

# So many rounds of a walk are kept as tables of their own before they are stored as one.
MERGED_ROUNDS = 16
# Where no route has more edges, walking takes fewer jobs than splicing.
WALKED_EDGES = 8
# A route of up to so many edges is walked whole in its row; the steps of that grow with their square.
ROW_EDGES = 128


def forked_trails(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``keys, node, step`` of the trail of each route; step 0 is ``from_node``.

    ``edges`` has ``keys, src, nth, dst``: the n-th visit of ``src`` leaves by its edge ``nth``,
    counted from 1 without gaps; a trail ends where no edge is left. ``keys`` contain ``from_node``.
    Rows without a source or a key belong to no trail.

    Routes of up to :data:`ROW_EDGES` edges are walked each in a row of its own, without a join; of longer
    ones no row holds all edges.
    """
    keys = list(keys)
    n_edges = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    edges = cut_lineage(edges.select(*keys, "src", "nth", "dst", n_edges.alias("n_edges")))
    longer = edges.where(F.col("n_edges") > ROW_EDGES).drop("n_edges")
    walked = _walked_in_rows(edges.where(F.col("n_edges") <= ROW_EDGES), keys)
    return walked if longer.isEmpty() else walked.unionByName(_spliced_trails(longer, keys))


def _walked_in_rows(edges: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`forked_trails` of routes that fit in a row: as many steps as there are edges, each to the next leg.

    The leg is that of the node's visit; where there is none, the trail stays as it is.
    """
    legs = edges.groupBy(*keys).agg(F.collect_list(F.struct("src", "nth", "dst")).alias("legs"))

    def further(trail: Column, _: Column) -> Column:
        here = F.element_at(trail, -1)
        visit = F.size(F.filter(trail, lambda node: node == here))
        ways = F.filter(F.col("legs"), lambda leg: (leg["src"] == here) & (leg["nth"] == visit))
        return F.concat(trail, F.transform(F.slice(ways, 1, 1), lambda leg: leg["dst"]))

    trail = F.aggregate("legs", F.array(F.col("from_node")), further)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return legs.select(*keys, F.posexplode(F.when(known, trail).otherwise(F.array("from_node"))).alias("step", "node")).select(
        *keys, "node", "step"
    )


def _spliced_trails(edges: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`forked_trails` of routes of any length.

    Legs that can only follow one another are spliced, all routes at once: a loop at a node is
    followed by the node's next leg, a leg into a node with one way in and one way out by that way.
    Splicing takes rounds logarithmic in the edges and is repeated while it finds anything, once for
    each depth of loops within loops. Only forks that are left after it are walked visit by visit.
    """
    legs = edges = cut_lineage(edges.withColumn("size", F.lit(1)))
    starts = edges.select(*keys).distinct().withColumn("node", F.col("from_node"))
    levels = []
    longest = edges.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    while longest > WALKED_EDGES:
        links = cut_lineage(_links(legs, starts, keys))
        if links.isEmpty():
            break
        legs, children = _spliced(legs, links, keys)
        levels.append(children)
    taken = _walked(legs, starts, keys)
    for children in reversed(levels):
        inner = children.withColumnRenamed("at", "within")
        taken = cut_lineage(
            taken.join(inner, [*keys, "src", "nth"]).select(
                *keys, F.col("leg.src").alias("src"), F.col("leg.nth").alias("nth"), (F.col("at") + F.col("within")).alias("at")
            )
        )
    steps = taken.join(edges, [*keys, "src", "nth"]).select(*keys, F.col("dst").alias("node"), (F.col("at") + 1).alias("step"))
    return starts.select(*keys, "node", F.lit(0).alias("step")).unionByName(steps.withColumn("step", F.col("step").cast("int")))


def _leg(src: str, nth: Column) -> Column:
    return F.struct(F.col(src).alias("src"), nth.alias("nth"))


def _links(legs: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, node, up``: the leg ``up`` that must follow the leg ``node``."""
    arrivals = legs.where("src <> dst").select(*keys, F.col("dst").alias("node")).unionByName(starts)
    ways_in = arrivals.groupBy(*keys, "node").agg(F.count(F.lit(1)).alias("n_in"))
    ways_out = legs.groupBy(*keys, "src").agg(F.max("nth").alias("n_out"))
    this, first = _leg("src", F.col("nth")).alias("node"), F.lit(1)
    loops = legs.where("src = dst").join(ways_out, [*keys, "src"]).where("nth < n_out")
    single = (
        ways_out.where("n_out = 1")
        .withColumnRenamed("src", "node")
        .join(ways_in.where("n_in = 1"), [*keys, "node"])
        .select(*keys, F.col("node").alias("dst"))
    )
    chained = legs.where("src <> dst").join(single, [*keys, "dst"])
    return loops.select(*keys, this, _leg("src", F.col("nth") + 1).alias("up")).unionByName(
        chained.select(*keys, this, _leg("dst", first).alias("up"))
    )


def _spliced(legs: DataFrame, links: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Longer legs, and their parts: ``keys, src, nth, leg, at`` with the leg before splicing.

    Legs that only lead to each other in a ring have no first one; no trail gets there.
    """
    here = legs.withColumn("node", _leg("src", F.col("nth")))
    order = Window.partitionBy(*keys, "head.src").orderBy("head.nth")
    run = _ranked(here.select(*keys, "node"), links, keys)
    heads = run.where("offset = 0").select(*keys, "head", F.row_number().over(order).alias("nth"))
    run = run.join(heads, [*keys, "head"]).select(*keys, F.col("head.src").alias("src"), "nth", "node", "offset")
    parts = run.join(here.select(*keys, "node", "dst", "size"), [*keys, "node"])
    before = Window.partitionBy(*keys, "src", "nth").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut_lineage(parts.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0))))
    longer = parts.groupBy(*keys, "src", "nth").agg(
        F.max_by("dst", "offset").alias("dst"), F.sum("size").alias("size")
    )
    return cut_lineage(longer), parts.select(*keys, "src", "nth", F.col("node").alias("leg"), "at")


def _ranked(nodes: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, node, head, offset``: the first of the run each node is in, and the links from it.

    Pointers to what comes before double their reach until a round settles no node; what then still
    has a pointer is in a ring and left out.
    """
    back = links.select(*keys, F.col("up").alias("node"), F.col("node").alias("back"))
    state = nodes.join(back, [*keys, "node"], "left").select(
        *keys, "node", "back", F.when(F.col("back").isNull(), F.col("node")).alias("head"), F.col("back").isNotNull().cast("int").alias("offset")
    )
    state = cut_lineage(state)
    open_before, still_open = None, state.where("back is not null").count()
    while still_open and still_open != open_before:
        ahead = state.select(
            *keys, F.col("node").alias("back"), F.col("back").alias("next"), F.col("head").alias("found"), F.col("offset").alias("more")
        )
        state = cut_lineage(
            state.join(ahead, [*keys, "back"], "left").select(
                *keys,
                "node",
                F.col("next").alias("back"),
                F.coalesce("head", "found").alias("head"),
                (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"),
            )
        )
        open_before, still_open = still_open, state.where("back is not null").count()
    return state.where("back is null").drop("back")


def _walked(legs: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, src, nth, at`` of the legs that the trails take, all routes a leg a round."""
    state = starts.select(*keys, "node", F.lit(1).alias("nth"), F.lit(True).alias("here"), F.lit(0).cast("long").alias("at"))
    state = cut_lineage(state)
    taken = []
    while True:
        now = state.where("here").select(*keys, F.col("node").alias("src"), "nth", "at")
        moves = cut_lineage(now.join(legs, [*keys, "src", "nth"]))
        if taken and moves.isEmpty():
            break
        taken.append(moves.select(*keys, "src", "nth", "at"))
        if len(taken) > MERGED_ROUNDS:
            taken = [cut_lineage(_union(taken))]
        arrived = moves.select(
            *keys, F.col("dst").alias("node"), F.lit(1).alias("nth"), F.lit(True).alias("here"), (F.col("at") + F.col("size")).alias("at")
        )
        before = state.withColumns({"here": F.lit(False), "at": F.lit(0).cast("long")})
        state = cut_lineage(
            before.unionByName(arrived)
            .groupBy(*keys, "node")
            .agg(F.sum("nth").cast("int").alias("nth"), F.bool_or("here").alias("here"), F.max("at").alias("at"))
        )
    return _union(taken)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
