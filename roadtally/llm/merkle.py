"""Merkle manifest of a table: leaves, roots, and proofs found by pointer jumping.

Rows of one group are the leaves of a tree in the order of their ids; the roots of all groups are
the leaves of one more tree. A node is the hash of two consecutive nodes below it, or of one if
that is all there is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadtally.llm.columns import narrow
from roadtally.session import broadcast_if_small, cut_lineage

# Levels of a tree that a task builds at once, so that it holds 2 ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 10
HEX_CHARS = 64


def record_hash(values: Sequence[Column]) -> Column:
    """Hash of values in order: each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = [
        F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")))
        for v in values
    ]
    return F.sha2(F.concat(*parts), 256)


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves: the bits of ``n - 1``."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def _shift(value: Column, levels: Column) -> Column:
    return F.call_function("shiftright", value, levels)


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the row's place in its group from 0, and ``n``, the group's rows; stored.

    ``group`` is a text column without nulls. Rows are dealt by ranges of (group, order), so a
    group may be spread over all tasks; equal rows are dealt by their place in the input, so a row
    that is repeated very often is no hot key. Only counts of (task, group) move after that.
    """
    salt, at = "_salt", "_at"
    rows = cut_lineage(rows.withColumn(salt, F.monotonically_increasing_id()))
    keys = [group, *order, salt]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(salt)
    dealt = cut_lineage(dealt.withColumn(at, F.monotonically_increasing_id()))
    task = F.shiftright(at, 33)
    counts = dealt.groupBy(task.alias("_task"), group).agg(F.count(F.lit(1)).alias("_count"), F.min(at).alias("_first"))
    within = Window.partitionBy(group).orderBy("_task")  # at most a row for each task
    ahead = F.coalesce(F.sum("_count").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(
        "_task", group, (ahead - F.col("_first")).alias("_shift"), F.sum("_count").over(Window.partitionBy(group)).alias("n")
    )
    found = dealt.withColumn("_task", task).join(broadcast_if_small(starts), ["_task", group])
    return cut_lineage(found.withColumn("pos", F.col(at) + F.col("_shift")).drop("_task", at, "_shift"))


def tree_nodes(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes below the roots, ``tree, level, pos, sibling``, and the roots, ``tree, n, root``.

    ``leaves`` is ``tree, pos, n, hash``, stored. Blocks of consecutive nodes are built level by
    level in one task each; the blocks' tops are the leaves of the next, far smaller step. A
    sibling is the other node of a pair, as bytes, and null if there is none.
    """
    rows = leaves.select("tree", "n", "pos", "hash")
    highest = leaves.agg(F.max(_height(F.col("n")))).first()[0]
    if highest is None:
        return rows.select("tree", F.lit(0).alias("level"), "pos", F.unhex("hash").alias("sibling")), rows.select("tree", "n", F.col("hash").alias("root"))

    def above(level: Column) -> Column:
        def parent(i: Column) -> Column:
            return F.sha2(F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256)

        return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), parent)

    def sibling(level: Column, i: Column) -> Column:
        other = F.when(i % 2 == 1, i - 1).when(i + 1 < F.size(level), i + 1)
        return F.unhex(F.get(level, other))

    nodes, base = None, 0
    while True:
        size = 1 << BLOCK_LEVELS
        blocks = rows.groupBy("tree", "n", F.floor(F.col("pos") / size).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "hash")))["hash"].alias("level")
        )
        climb = F.least(F.lit(BLOCK_LEVELS), _height(F.col("n")) - base)
        grown = F.when(
            climb > 0,
            F.aggregate(
                F.sequence(F.lit(1), climb), F.array("level"), lambda acc, _: F.concat(acc, F.array(above(F.element_at(acc, -1))))
            ),
        ).otherwise(F.array("level"))
        levels = cut_lineage(blocks.select("tree", "n", "block", grown.alias("levels")))
        pairs = F.transform(F.slice("levels", F.lit(1), F.size("levels") - 1), lambda level: F.transform(level, lambda _, i: sibling(level, i)))
        each = levels.select("tree", "block", F.posexplode(pairs).alias("step", "siblings"))
        found = each.select("tree", "block", "step", F.posexplode("siblings").alias("i", "sibling")).select(
            "tree",
            (F.col("step") + base).alias("level"),
            (F.col("block") * _power(BLOCK_LEVELS - F.col("step")) + F.col("i")).alias("pos"),
            "sibling",
        )
        nodes = found if nodes is None else nodes.unionByName(found)
        rows = levels.select("tree", "n", F.col("block").alias("pos"), F.element_at("levels", -1)[0].alias("hash"))
        base += BLOCK_LEVELS
        if base >= highest:
            return nodes, rows.select("tree", "n", F.col("hash").alias("root"))


def _power(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bits)


def proofs(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Siblings on the way from each leaf to its root, and the roots of :func:`tree_nodes`.

    ``leaves`` with the column ``siblings``: the hashes, end to end, as bytes. A pointer of a node
    holds the siblings up to an ancestor. Each round joins a node with its ancestor's pointer,
    which doubles the distance; after round k only leaves and nodes at levels that 2 ** k divides
    are pointed from, so the table of ancestors shrinks with the square of its own size and is
    soon broadcast. A pointer that would lead beyond the root ends there.
    """
    nodes, roots = tree_nodes(leaves)
    nodes = cut_lineage(nodes.select("tree", "level", "pos", F.coalesce("sibling", F.lit(b"")).alias("siblings")))
    highest = leaves.agg(F.max(_height(F.col("n")))).first()[0] or 0

    def jump(lower: DataFrame, upper: DataFrame, distance: int) -> DataFrame:
        """Pointers of ``lower`` to ``distance`` levels above, lengthened by those of ``upper``."""
        ancestors = upper.select(
            F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("pos").alias("_pos"), F.col("siblings").alias("_more")
        )
        on = (
            (F.col("tree") == F.col("_tree"))
            & (F.col("level") + distance == F.col("_level"))
            & (F.shiftright("pos", distance) == F.col("_pos"))
        )
        joined = lower.join(ancestors, on, "left")
        return joined.withColumn("siblings", F.concat("siblings", F.coalesce("_more", F.lit(b"")))).select(*lower.columns)

    level = F.lit(0).alias("level")
    first = nodes.where("level = 0").select("tree", "pos", "siblings")
    out = leaves.join(first, ["tree", "pos"], "left").withColumn("siblings", F.coalesce("siblings", F.lit(b"")))
    out = out.withColumn("level", level)
    upper, distance = nodes.where("level > 0"), 1
    while distance < highest:
        ancestors = broadcast_if_small(upper.where(F.col("level") % (2 * distance) == distance))
        out = jump(out, ancestors, distance)
        if 2 * distance < highest:
            kept = upper.where(F.col("level") % (2 * distance) == 0)
            upper = cut_lineage(jump(kept, ancestors, distance))
        distance *= 2
    return out.drop("level"), roots


def fold(leaf: Column, pos: Column, n: Column, siblings: Column) -> Column:
    """The root that a leaf hash at ``pos`` of ``n`` leads to with its siblings (hexadecimal)."""

    def step(state: Column, level: Column) -> Column:
        at = _shift(pos, level)
        last = _shift(n - 1, level)
        other = F.substring(siblings, state["used"] + 1, F.lit(HEX_CHARS))
        right, left = at % 2 == 1, (at % 2 == 0) & (at < last)
        taken = F.when(right | left, F.lit(HEX_CHARS)).otherwise(F.lit(0))
        both = F.when(right, F.concat(other, state["hash"])).when(left, F.concat(state["hash"], other)).otherwise(state["hash"])
        return F.struct(F.sha2(both, 256).alias("hash"), (state["used"] + taken).alias("used"))

    begin = F.struct(leaf.alias("hash"), F.lit(0).alias("used"))
    height = _height(n)
    climbed = F.aggregate(F.sequence(F.lit(0), height - 1), begin, step, lambda s: s["hash"])
    return F.when(height == 0, leaf).otherwise(climbed)


def manifest(docs: DataFrame, id_col: str, values: Sequence[str], group_col: str, **extra: Column) -> DataFrame:
    """A row for each row of ``docs``: its leaf, its places, its proof and the roots.

    ``id, <extra>, leaf, pos, n, subroot, group_pos, n_groups, root, siblings, group_siblings``. A
    leaf hashes ``values``; leaves of a group ascend by id (null first), equal ids by leaf;
    groups are in byte order, the null group first. Both lists of siblings are hexadecimal, end to
    end, from the leaf to the subroot and from there to the root. ``extra`` are expressions over
    ``docs`` that come along. Repeated rows are leaves of their own, other columns are ignored, and
    an empty table gives no rows.
    """
    group = F.col(group_col).cast("string")
    named = docs.select(
        F.col(id_col).alias("id"),
        F.when(group.isNull(), "0").otherwise(F.concat(F.lit("1"), group)).alias("tree"),
        record_hash([F.col(v) for v in values]).alias("hash"),
        *[c.alias(name) for name, c in extra.items()],
    )
    leaves = placed(named, "tree", ["id", "hash"])
    proved, subroots = proofs(leaves)
    tops = subroots.select(F.lit("").alias("top"), "tree", F.col("root").alias("hash"))
    top_leaves = placed(tops, "top", ["tree"]).withColumnsRenamed({"tree": "subtree", "top": "tree"})
    proved_tops, roots = proofs(top_leaves)
    of_group = proved_tops.join(roots.select("tree", "root"), "tree").select(
        F.col("subtree").alias("tree"),
        F.col("hash").alias("subroot"),
        F.col("pos").alias("group_pos"),
        F.col("n").alias("n_groups"),
        "root",
        F.lower(F.hex("siblings")).alias("group_siblings"),
    )
    found = proved.withColumn("siblings", F.lower(F.hex("siblings"))).join(broadcast_if_small(of_group), "tree")
    return found.withColumnRenamed("hash", "leaf").drop("tree")
