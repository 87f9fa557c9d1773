"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadtally.session import cut_and_measure, cut_lineage, in_few_tasks

MAX_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    ways = _both_ways(links)
    least = ways.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return ways.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") > F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    linked = down.join(least, "u").where(F.col("v") > F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return linked.union(least.select("u", F.col("least").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """Smallest node that each linked node can reach: ``node, component``.

    ``links`` is ``u, v``, in any direction; repeated links and loops do no harm, rows with a null
    are ignored. Large-star and small-star rounds alternate until nothing changes; then every node
    is linked to its component's smallest. A node without links has no row. Minima are taken
    before rows move, so a node with many links makes no large task of its own. A step of a round
    makes no more rows than the round has links and runs in as many tasks as these fill.
    """
    links = links.where(F.col("u") != F.col("v")).select("u", "v").distinct()
    mark = {"n": F.count(F.lit(1)), "sum": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    links, seen = cut_and_measure(links, **mark)
    for _ in range(MAX_ROUNDS):
        if not seen["n"]:
            break
        before = seen
        rows = 2 * seen["n"]  # both ways
        large = in_few_tasks(in_few_tasks(_large_star(in_few_tasks(links, rows)), rows).distinct(), rows)
        small = in_few_tasks(_small_star(large).where(F.col("u") != F.col("v")), rows).distinct()
        links, seen = cut_and_measure(in_few_tasks(small, rows), **mark)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    links = in_few_tasks(links, seen["n"])
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    return cut_lineage(in_few_tasks(nodes, 2 * seen["n"]))
