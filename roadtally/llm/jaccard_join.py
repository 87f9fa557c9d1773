"""Exact n-gram Jaccard join: count-vector R-trees over texts that share a rare shingle.

A text is its set of five-word shingles. Its point counts them by group; the overlap of two sets
is at most the sum of the coordinate-wise minima of their points, and for a box of points that of
the query's coordinates and the box's upper corner. One tree over all texts would be scanned
almost whole, as a box of unrelated texts has a high corner in every coordinate. So texts first
meet by the rare shingles of which two similar texts must share one, and trees are packed for each
meeting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadtally.llm.batches import parts
from roadtally.llm.columns import narrow
from roadtally.llm.components import components
from roadtally.llm.shingles import fold, point, set_key, shingle_set
from roadtally.session import broadcast_if_small, cut_lineage, cut_to_few_tasks, scratch_path

# Links: 100 * intersection >= 80 * union, so 9 * intersection >= 4 * (sum of the sizes).
PERCENT = 80
COUNTERS = 1 << 16  # cells that count how often shingles occur; fixed, whatever the input
LEAF = 16
# A meeting of more texts is dealt into strips of about so many, two of which make a task's tree.
STRIP = 4096
# The same for candidates whose whole sets a task holds.
SET_STRIP = 1024

_SETS = "id long, n long, k long, k2 long, point binary, cell int, times long"


def _sets(docs: DataFrame) -> DataFrame:
    """A row for each document, and rows that count the cells of its task's shingles."""

    def run(batches):
        times = np.zeros(COUNTERS, np.int64)
        for batch in (x for whole in batches for x in parts(whole, 1)):
            out = [[], [], [], []]
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                np.add.at(times, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
                k, k2 = set_key(s)
                for column, value in zip(out, (len(s), k, k2, point(s).tobytes())):
                    column.append(value)
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    *[pa.array(x, pa.int64()) for x in out[:3]],
                    pa.array(out[3], pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.int64()),
                ],
                ["id", "n", "k", "k2", "point", "cell", "times"],
            )
        cells = np.flatnonzero(times)
        none = len(cells)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(none, pa.int64())] * 4, pa.nulls(none, pa.binary()), pa.array(cells, pa.int32()), pa.array(times[cells])],
            ["id", "n", "k", "k2", "point", "cell", "times"],
        )

    return docs.mapInArrow(run, _SETS)


def _meetings(docs: DataFrame, order: np.ndarray) -> DataFrame:
    """``h, k, n``: each set under the rare shingles one of which a similar set must share.

    Shingles are ordered by how often their cell occurs, then by hash, the same in all texts. Two
    sets that link share at least four fifths of the larger, so they share one of the first
    n // 5 + 1 of each.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        rank = ranks.value
        for batch in (x for whole in batches for x in parts(whole, 0)):
            hs, ks, ns = [], [], []
            for text in batch.column(0).to_pylist():
                s = shingle_set(text)
                if not len(s):
                    continue
                first = np.lexsort((s, rank[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]))[: len(s) // 5 + 1]
                hs.append(s[first].view(np.int64))
                ks.append(np.full(len(first), set_key(s)[0], np.int64))
                ns.append(np.full(len(first), len(s), np.int32))
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hs, ks, ns)], ["h", "k", "n"])

    return docs.select("text").mapInArrow(run, "h long, k long, n int")


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Rows sorted by the first column, regrouped so that no value of it is cut in two."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        own = [np.asarray(batch.column(c)) if batch.column(c).type != pa.binary() else np.array(batch.column(c).to_pylist(), object) for c in names]
        if held is not None:
            own = [np.concatenate(x) for x in zip(held, own)]
        if not len(own[0]):
            continue
        cut = np.searchsorted(own[0], own[0][-1], side="left")
        if cut:
            yield [x[:cut] for x in own]
        held = [x[cut:] for x in own]
    if held is not None and len(held[0]):
        yield held


def _stars(meetings: DataFrame) -> DataFrame:
    """``meeting, lead, k``: who meets whom; the lead is a meeting's longest set.

    Meetings of the same sets are one. Of a meeting of two only the other set has a row, as the
    pair with the lead is all there is; ``meeting`` is then null. A meeting is read in order of its
    rows: what is held at a time is the keys of one meeting.
    """
    dealt = meetings.repartition("h").sortWithinPartitions("h", F.desc("n"), "k")

    def run(batches):
        for h, k, n in _runs(batches, ["h", "k", "n"]):
            fresh = np.append(True, (h[1:] != h[:-1]) | (k[1:] != k[:-1]))
            h, k = h[fresh], k[fresh]
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            sizes = np.diff(np.append(starts, len(h)))
            many = np.repeat(sizes > 1, sizes)
            lead = np.repeat(k[starts], sizes)
            with np.errstate(over="ignore"):
                mixed = (k.view(np.uint64) ^ k.view(np.uint64) >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
                name = np.add.reduceat(mixed, starts) * np.uint64(0xC2B2AE3D27D4EB4F) + sizes.astype(np.uint64)
            name = np.repeat(name, sizes).view(np.int64)
            pair = np.repeat(sizes == 2, sizes)
            kept = many & ~(pair & (k == lead))
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[kept], mask=pair[kept]), pa.array(lead[kept]), pa.array(k[kept])], ["meeting", "lead", "k"]
            )

    return dealt.mapInArrow(run, "meeting long, lead long, k long").distinct()


def _bounded(pairs: DataFrame) -> DataFrame:
    """Pairs whose points allow a link: the minima of their coordinates sum up to enough."""

    def allowed(a: bytes, b: bytes, total: int) -> bool:
        x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        groups = min(len(x), len(y))
        return 9 * int(np.minimum(fold(x, groups), fold(y, groups)).sum(dtype=np.int64)) >= 4 * total

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("point_a", "point_b", "n_a", "n_b")]
            kept = pa.array([allowed(a, b, m + n) for a, b, m, n in zip(*columns)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("a", "b")], ["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "point_a", "point_b").mapInArrow(run, "a long, b long")


def point_pairs(
    n: np.ndarray, points: list[bytes], part: np.ndarray, side: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`tree_pairs` for points of several lengths.

    For each length a tree holds the points of this length and, folded, the longer ones whose
    sizes could fit; pairs of two longer ones are left to their own tree.
    """
    length = np.fromiter(map(len, points), np.int64, len(points))
    for groups in np.unique(length):
        own = length == groups
        fits = (100 * n >= PERCENT * n[own].min()) & (PERCENT * n <= 100 * n[own].max())
        rows = np.flatnonzero(own | ((length > groups) & fits))
        if len(rows) > 1:
            same = [fold(np.frombuffer(points[r], np.uint8), int(groups)) for r in rows]
            for x, y in tree_pairs(n[rows], np.stack(same), part[rows], side[rows], own[rows]):
                yield rows[x], rows[y]


def tree_pairs(
    n: np.ndarray, points: np.ndarray, part: np.ndarray, side: np.ndarray, own: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of different ``part`` whose points allow a link, by a packed R-tree. If rows
    come from two sides, only pairs of both are wanted; of a pair, one at least is to be ``own``.

    Rows are packed into leaves by part, size and counts, so that what is already known to be
    linked shares boxes; boxes are packed into boxes up to the root. A leaf is the query: it goes
    down where the minima of upper corners sum up to enough for the smallest sizes and a box holds
    another part, and the pairs of the leaves that are reached are compared one by one.
    """
    order = np.lexsort((points[:, 0], points[:, 1], n, part))
    n, points, part, side, own = n[order], points[order], part[order], side[order], own[order]
    two_sided = (side != side[0]).any()
    starts = np.arange(0, len(n), LEAF)
    levels = [(np.minimum.reduceat(n, starts), np.maximum.reduceat(points, starts, axis=0), np.minimum.reduceat(part, starts), np.maximum.reduceat(part, starts))]
    while len(levels[-1][0]) > 1:
        least, upper, low, high = levels[-1]
        s = np.arange(0, len(least), LEAF)
        levels.append((np.minimum.reduceat(least, s), np.maximum.reduceat(upper, s, axis=0), np.minimum.reduceat(low, s), np.maximum.reduceat(high, s)))
    least, upper, low, high = levels[0]
    for leaf in range(len(least)):
        boxes = np.zeros(1, np.int64)
        for level in range(len(levels) - 1, -1, -1):
            if level < len(levels) - 1:
                boxes = (boxes[:, None] * LEAF + np.arange(LEAF)).ravel()
                boxes = boxes[boxes < len(levels[level][0])]
            if level == 0:
                boxes = boxes[boxes >= leaf]
            own_n, own_upper, own_low, own_high = (x[boxes] for x in levels[level])
            enough = 9 * np.minimum(own_upper, upper[leaf]).sum(1, dtype=np.int64) >= 4 * (own_n + least[leaf])
            same = (own_low == own_high) & (own_low == low[leaf]) & (own_high == high[leaf]) & (low[leaf] == high[leaf])
            boxes = boxes[enough & ~same]
            if not len(boxes):
                break
        mine = np.arange(leaf * LEAF, min((leaf + 1) * LEAF, len(n)))
        rows = (boxes[:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < len(n)]
        for i in mine:
            others = rows[(rows > i) & (part[rows] != part[i])]
            others = others[side[others] != side[i]] if two_sided else others
            others = others if own[i] else others[own[others]]
            small, large = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
            others = others[100 * small >= PERCENT * large]
            if len(others):
                enough = 9 * np.minimum(points[others], points[i]).sum(1, dtype=np.int64) >= 4 * (n[others] + n[i])
                if enough.any():
                    yield np.full(int(enough.sum()), order[i]), order[others[enough]]


def _strips(placed: DataFrame, most: int) -> DataFrame:
    """``cell, k, n, component, strip`` for meetings that hold more than one component.

    Small components of a meeting share strips by hash; a large one has strips of its own, so that
    pairs of its strips can be left out unseen.
    """
    of_component = placed.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("c"))
    cells = (
        of_component.groupBy("cell").agg(F.count(F.lit(1)).alias("components"), F.sum("c").alias("m")).where("components > 1")
    )
    shares = of_component.join(cells, "cell").select(
        "cell", "component", F.ceil(F.col("m") / most).alias("of_cell"), F.ceil(F.col("c") / most).alias("of_own"), "c"
    )
    own = F.xxhash64(F.col("component"), F.pmod(F.xxhash64("k"), F.col("of_own")))
    strip = F.when(2 * F.col("c") > most, own).otherwise(F.pmod(F.xxhash64("component"), F.col("of_cell")))
    return placed.join(shares, ["cell", "component"]).select("cell", "k", "n", "component", strip.alias("strip"))


def _units(placed: DataFrame, most: int) -> DataFrame:
    """``unit, k, n, component, strip``: what a task compares, two strips of one cell at most."""
    rows = cut_to_few_tasks(_strips(cut_to_few_tasks(placed), most))
    boxes = rows.groupBy("cell", "strip").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    left, right = boxes.alias("i"), boxes.alias("j")
    one_component = (F.col("i.low") == F.col("i.high")) & (F.col("j.low") == F.col("i.low")) & (F.col("j.high") == F.col("i.low"))
    near = (100 * F.col("i.most") >= PERCENT * F.col("j.least")) & (100 * F.col("j.most") >= PERCENT * F.col("i.least"))
    units = left.join(right, F.col("i.cell") == F.col("j.cell")).where(
        (F.col("i.strip") <= F.col("j.strip")) & ~one_component & near
    )
    unit = F.xxhash64("i.cell", "i.strip", "j.strip").alias("unit")
    sides = units.select(
        F.col("i.cell").alias("cell"), unit, F.explode(F.array_distinct(F.array("i.strip", "j.strip"))).alias("strip")
    )
    return rows.join(sides, ["cell", "strip"]).select("unit", "k", "n", "component", "strip")


class _Forest:
    """Which rows are known to be connected."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _by_unit(batches, names: list[str]) -> Iterator[list[np.ndarray]]:
    for columns in _runs(batches, names):
        starts = np.flatnonzero(np.append(True, columns[0][1:] != columns[0][:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(columns[0]))):
            yield [x[a:b] for x in columns[1:]]


def _candidates(units: DataFrame, points: DataFrame) -> DataFrame:
    """``cell, k``: groups of sets that pairs allowed by their points connect.

    Groups come out instead of their pairs, so rows do not grow with the square of a group; the
    same group found in several meetings is one.
    """
    dealt = units.join(points, "k").repartition("unit").sortWithinPartitions("unit", "component")
    names = ["unit", "k", "n", "component", "strip", "point"]

    def run(batches):
        for k, n, comp, strip, own in _by_unit(batches, names):
            forest = _Forest(len(k))
            for x, y in point_pairs(n, list(own), comp, strip):
                for i, j in zip(x.tolist(), y.tolist()):
                    forest.join(i, j)
            roots = np.array([forest.root(i) for i in range(len(k))])
            for root in np.flatnonzero(np.bincount(roots) > 1):
                members = np.sort(k[roots == root])
                name = set_key(members)[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(members), name)), pa.array(members)], ["cell", "k"])

    return dealt.select(*names).mapInArrow(run, "cell long, k long").distinct()


def _links(units: DataFrame, known: DataFrame) -> DataFrame:
    """Links ``a, b`` between components, found by comparing whole sets in the task.

    The tree of a unit proposes pairs; a pair that earlier links connect is not compared, and only
    links that connect something new come out, fewer than the unit has rows.
    """
    packed = known.select("k", "shingles")
    dealt = units.join(packed, "k").repartition("unit").sortWithinPartitions("unit", "component")
    names = ["unit", "k", "n", "component", "strip"]

    def raw(batches):
        for batch in batches:
            lists = batch.column("shingles")
            sets = [np.asarray(x.values).tobytes() for x in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sets, pa.binary())], [*names, "set"])

    def run(batches):
        for k, n, comp, strip, own in _by_unit(raw(batches), [*names, "set"]):
            sets = [np.frombuffer(x, np.uint64) for x in own]
            forest, first = _Forest(len(k)), {}
            for i, c in enumerate(comp.tolist()):
                forest.join(first.setdefault(c, i), i)
            found = []
            for x, y in point_pairs(n, [point(s).tobytes() for s in sets], comp, strip):
                for i, j in zip(x.tolist(), y.tolist()):
                    if forest.root(i) != forest.root(j):
                        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if 100 * both >= PERCENT * (len(sets[i]) + len(sets[j]) - both):
                            forest.join(i, j)
                            found.append((k[i], k[j]))
            if found:
                pairs = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return dealt.select(*names, "shingles").mapInArrow(run, "a long, b long")


def _known(docs: DataFrame, sets: DataFrame, keys: DataFrame, repeats: bool) -> DataFrame:
    """``k, id, shingles`` of the sets that have one of the keys, made again from the texts.

    ``repeats`` says that a set's text may come more than once, as ids are repeated.
    """
    # If the few numbers that name these texts fit into memory, no text but theirs is moved.
    holders = broadcast_if_small(sets.join(keys.distinct(), "k").select("k", "k2", "id"))

    def run(batches):
        for batch in (x for whole in batches for x in parts(whole, "text")):
            found = [shingle_set(t) for t in batch.column("text").to_pylist()]
            same = np.array([set_key(s) for s in found], np.int64).reshape(-1, 2)
            right = (same[:, 0] == np.asarray(batch.column("k"))) & (same[:, 1] == np.asarray(batch.column("k2")))
            kept = [s.view(np.int64) for s, r in zip(found, right) if r]
            ends = np.cumsum([0, *map(len, kept)])
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).filter(pa.array(right)) for c in ("k", "k2", "id")], lists], ["k", "k2", "id", "shingles"]
            )

    texts = docs.join(holders, "id").select("k", "k2", "id", "text")
    known = texts.mapInArrow(run, "k long, k2 long, id long, shingles array<long>")
    known = known.dropDuplicates(["k", "k2"]) if repeats else known
    return cut_lineage(known.select("k", "id", "shingles"))


def _verified(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Links ``u, v`` (ids) among pairs of set keys, by their whole sets."""
    left = known.select(F.col("k").alias("a"), F.col("id").alias("u"), F.col("shingles").alias("left"))
    right = known.select(F.col("k").alias("b"), F.col("id").alias("v"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right")).cast("long")
    either = F.size("left") + F.size("right") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= PERCENT * either).select("u", "v")


def near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Classes of texts linked by a shingle Jaccard of 0.8 or more: ``id, n_shingles, component_id``.

    One row for each input row. Equal sets are one node, named by their smallest id, so copies are
    never paired. First each set is compared with the longest of its meeting; then only sets of
    different components are, by the meeting's tree. A component is the smallest id that links
    reach. Texts without words link with nothing. Rows of a repeated id are linked with each other
    if their texts have words. A row without id has no name to be linked by: it takes no part and its
    component is null. Extra columns are ignored, an empty table gives no rows.
    """
    rows = narrow(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    named = rows.where(F.col("id").isNotNull())
    path = scratch_path(docs.sparkSession, "sets")
    _sets(rows).write.parquet(path)
    made = docs.sparkSession.read.parquet(path)
    each = made.where(F.col("cell").isNull()).drop("cell", "times")
    times = made.where(F.col("cell").isNotNull()).groupBy("cell").agg(F.sum("times").alias("times")).collect()
    order = np.zeros(COUNTERS, np.int64)  # a number for each of a fixed number of cells
    order[[r["cell"] for r in times]] = [r["times"] for r in times]

    full = each.where((F.col("n") > 0) & F.col("id").isNotNull())
    sets = cut_to_few_tasks(full.groupBy("k", "k2").agg(F.min("id").alias("id"), F.first("n").alias("n")))
    repeats = not full.groupBy("id").count().where("count > 1").isEmpty()

    def points(keys: DataFrame) -> DataFrame:
        """``k, n, point`` of the sets that have one of the keys."""
        wanted = broadcast_if_small(sets.join(keys.distinct(), "k").select("k", "k2", "id"))
        found = full.join(wanted, ["k", "k2", "id"]).select("k", "k2", "n", "point")
        return cut_lineage((found.dropDuplicates(["k", "k2"]) if repeats else found).drop("k2"))

    stars = cut_to_few_tasks(_stars(_meetings(named, order)))
    tried = stars.where(F.col("lead") != F.col("k")).select(F.least("lead", "k").alias("a"), F.greatest("lead", "k").alias("b"))
    sizes = {x: sets.select(F.col("k").alias(x), F.col("n").alias(f"n_{x}")) for x in ("a", "b")}
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    tried = cut_lineage(tried.distinct().join(sizes["a"], "a").join(sizes["b"], "b").where(fits))
    of_tried = points(tried.select(F.explode(F.array("a", "b")).alias("k")))
    with_points = tried
    for x in ("a", "b"):
        with_points = with_points.join(of_tried.select(F.col("k").alias(x), F.col("point").alias(f"point_{x}")), x)
    proposed = cut_to_few_tasks(_bounded(with_points))
    ends = proposed.select(F.explode(F.array("a", "b")).alias("k"))
    star_links = cut_to_few_tasks(_verified(proposed, _known(named, sets, ends, repeats)))

    repeated = full.groupBy("id").agg(F.min("k").alias("low"), F.max("k").alias("high")).where("low != high").select("id")
    of_set = sets.select("k", "k2", F.col("id").alias("v"))
    same_id = full.join(repeated, "id").join(of_set, ["k", "k2"]).select(F.col("id").alias("u"), "v")
    known = components(star_links.union(same_id))

    member = cut_to_few_tasks(
        sets.join(known, sets["id"] == known["node"], "left").select("k", "n", F.coalesce("component", "id").alias("component"))
    )
    placed = stars.where(F.col("meeting").isNotNull()).select(F.col("meeting").alias("cell"), "k").distinct().join(member, "k")
    units = _units(placed, STRIP)
    groups = cut_to_few_tasks(_candidates(units, points(units.select("k")).drop("n")))
    units = _units(groups.join(member, "k"), SET_STRIP)
    found = _links(units, _known(named, sets, groups.select("k"), repeats))
    ids = {x: sets.select(F.col("k").alias(x), F.col("id").alias(y)) for x, y in (("a", "u"), ("b", "v"))}
    more = found.join(ids["a"], "a").join(ids["b"], "b").select("u", "v")
    final = components(star_links.union(same_id).union(more))

    name = sets.join(final, sets["id"] == final["node"], "left").select(
        "k", "k2", F.coalesce("component", "id").alias("component_id")
    )
    linked = full.join(name, ["k", "k2"]).select("id", F.col("n").alias("n_shingles"), "component_id")
    alone = each.where((F.col("n") == 0) | F.col("id").isNull()).select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return linked.union(alone)
