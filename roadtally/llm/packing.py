"""Packing of token pieces into sequences of a fixed length by best-two-fit."""

from __future__ import annotations

import base64
import functools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadtally.llm.batches import parts
from roadtally.llm.columns import narrow
from roadtally.session import cut_lineage


def best_two_fit(counts: dict[int, int], limit: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins for documents given as a number of documents for each length.

    A bin is filled greedily with the longest document that fits its gap. If a gap stays, its
    smallest document is exchanged for the two unpacked ones that fit the expanded gap most
    tightly, if they fit better. The same filling is used as often as the counts allow.
    Returns (lengths with their number in the bin, how many such bins). At most a few bins for
    each of the ``limit`` lengths come out, however many documents there are.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    bins = []
    while left:
        free = Counter(left)
        lengths = sorted(left, reverse=True)
        held: list[int] = []
        gap = limit
        for n in lengths:
            while free[n] and n <= gap:
                held.append(n)
                free[n] -= 1
                gap -= n
        if gap:
            smallest = held[-1]
            pair = _tightest_pair([n for n in lengths if free[n]], free, gap + smallest)
            if sum(pair) > smallest:
                held[-1:] = pair
        used = Counter(held)
        times = min(left[n] // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        bins.append((sorted(used.items(), reverse=True), times))
    return bins


def _tightest_pair(lengths: list[int], free: Counter, gap: int) -> list[int]:
    """Two free documents whose sum comes closest to ``gap`` from below; lengths fall."""
    best: list[int] = []
    high, low = 0, len(lengths) - 1
    while high <= low:
        a, b = lengths[high], lengths[low]
        if a + b > gap:
            high += 1
            continue
        if (high != low or free[a] > 1) and a + b > sum(best):
            best = [a, b]
        low -= 1
    return best


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str, special: tuple[tuple[str, int], ...]):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def token_pieces(
    docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str,
    special: dict[str, int], end_id: int, limit: int, with_ids: bool = False,
) -> DataFrame:
    """Tokenise texts, add the end token, cut what is longer than ``limit``.

    One row for each piece: ``id, piece, start, length, ids_crc32, part`` and, if asked for,
    ``ids``. The first piece of a cut document takes what the full ones leave. A null or empty
    text is its end token alone. ``part`` numbers the task that made the row. Rows are
    independent: null or repeated ids come out as they are, other columns are ignored.
    """
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    marks = tuple(special.items())

    def run(batches):
        encoding = _encoding(path, pattern, marks)
        for batch in (x for whole in batches for x in parts(whole, 1)):
            rows: list[list] = [[] for _ in range(5)]
            every = []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoding.encode_to_numpy(text or "", allowed_special="all"), end_id).astype("<u4")
                begin, end = 0, (len(ids) - 1) % limit + 1
                piece = 0
                while begin < len(ids):
                    own = ids[begin:end]
                    for column, value in zip(rows, (k, piece, begin, end - begin, zlib.crc32(own.tobytes()))):
                        column.append(value)
                    if with_ids:
                        every.append(own.astype(np.int32))
                    piece, begin, end = piece + 1, end, end + limit
            out = [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32())]
            out += [pa.array(x, pa.int64()) for x in rows[2:]]
            if with_ids:
                ends = np.cumsum([0, *map(len, every)])
                flat = np.concatenate(every) if every else np.zeros(0, np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    made = narrow(docs, id=id_col, text=text_col).mapInArrow(run, shape)
    return made.withColumn("part", F.spark_partition_id())


def pack(pieces: DataFrame, limit: int) -> DataFrame:
    """Give each piece of :func:`token_pieces` a ``sequence_id`` and an ``offset``.

    Bins are planned from the number of pieces of each length, so the driver sees ``limit``
    numbers at most. A piece's place among those of its length picks its slot: it is counted
    within the task that made the piece, then shifted by the counts of the tasks before.
    Identical rows may take each other's slots. No pieces give no rows.
    """
    spark = pieces.sparkSession
    pieces = cut_lineage(pieces)
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = by_part.select(
        "length",
        "part",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}

    slots, taken, sequence = [], Counter(), 0
    for own, times in best_two_fit(totals, limit):
        offset = 0
        for n, k in own:
            slots.append((n, taken[n], taken[n] + k * times, sequence, k, offset))
            taken[n] += k * times
            offset += n * k
        sequence += times
    table = spark.createDataFrame(slots, "length long, low long, high long, base long, copies long, first long")

    order = Window.partitionBy("length", "part").orderBy("id", "piece", "start", "ids_crc32")
    placed = (
        pieces.withColumn("_own", F.row_number().over(order) - 1)
        .join(before, ["length", "part"])
        .withColumn("_rank", F.col("_own") + F.col("before"))
    )
    # The plan has at most some slots for each length, so it is small for any number of pieces.
    joined = placed.join(
        F.broadcast(table),
        (placed["length"] == table["length"]) & (placed["_rank"] >= table["low"]) & (placed["_rank"] < table["high"]),
    ).drop(table["length"])
    step = F.col("_rank") - F.col("low")
    return joined.select(
        *[c for c in pieces.columns if c != "part"],
        (F.col("base") + F.floor(step / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("first") + step % F.col("copies") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence, from packed pieces that carry ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id", F.flatten(F.col("_parts.ids")).alias("ids")
    )
