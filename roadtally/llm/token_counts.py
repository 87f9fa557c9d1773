"""Token counts by merging the lowest-rank pair of every pre-token at once."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadtally.llm.vocabulary import NO_RANK, ChunkStore, PairTable, merge_file


def merge_in_step(pairs: PairTable, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge ragged sequences until no pair is left; symbols that survive and their numbers.

    In each step every sequence that still has a mergeable pair merges the one of lowest rank, at
    all its places from the left that do not overlap. If the product could form a pair of lower
    rank, only the leftmost place is merged in this step. Sequences that are done leave the arrays.
    """
    none = len(pairs.rank) - 1
    out_sizes = sizes.copy()
    done: list[tuple[np.ndarray, np.ndarray]] = []
    seq = np.repeat(np.arange(len(sizes)), sizes)
    sym = symbols
    row = np.full(len(sym), none, np.int64)
    inner = np.flatnonzero(seq[1:] == seq[:-1])
    row[inner] = pairs.find(sym[inner], sym[inner + 1])
    while len(sym):
        starts = np.flatnonzero(np.diff(seq, prepend=-1))
        lengths = np.diff(np.append(starts, len(seq)))
        rank = pairs.rank[row]
        lowest = np.minimum.reduceat(rank, starts)
        busy = lowest < NO_RANK
        if not busy.all():
            kept = np.repeat(busy, lengths)
            done.append((seq[~kept], sym[~kept]))
            out_sizes[seq[starts[~busy]]] = lengths[~busy]
            seq, sym, row, rank = seq[kept], sym[kept], row[kept], rank[kept]
            lowest, lengths = lowest[busy], lengths[busy]
            if not len(sym):
                break
        places = np.flatnonzero(rank == np.repeat(lowest, lengths))
        places = _apart(places)
        delicate = pairs.delicate[row[places]]
        if delicate.any():
            later = np.append(False, seq[places[1:]] == seq[places[:-1]])
            places = places[~(delicate & later)]
        sym[places] = pairs.made[row[places]]
        kept = np.ones(len(sym), bool)
        kept[places + 1] = False
        moved = (np.cumsum(kept) - 1)[places]
        seq, sym, row = seq[kept], sym[kept], row[kept]
        touched = np.concatenate([moved, moved[moved > 0] - 1])
        near = np.minimum(touched + 1, len(seq) - 1)
        joined = (seq[near] == seq[touched]) & (near > touched)
        row[touched[~joined]] = none
        touched = touched[joined]
        row[touched] = pairs.find(sym[touched], sym[touched + 1])
    if not done:
        return symbols[:0], out_sizes
    seq, sym = (np.concatenate(x) for x in zip(*done))
    return sym[np.argsort(seq, kind="stable")], out_sizes


def _apart(places: np.ndarray) -> np.ndarray:
    """From the left, drop places that overlap the one kept before them."""
    if len(places) < 2:
        return places
    starts = np.flatnonzero(np.diff(places, prepend=places[0] - 2) > 1)
    within = np.arange(len(places)) - np.repeat(starts, np.diff(np.append(starts, len(places))))
    return places[within % 2 == 0]


@functools.lru_cache(maxsize=2)
def chunk_store(path: str, pattern: str) -> ChunkStore:
    return ChunkStore(merge_file(path), pattern, merge_in_step)


def count_tokens(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str, limit: int) -> DataFrame:
    """Bytes and tokens of each text: ``id, n_bytes, n_tokens, over_limit``.

    The vocabulary's special strings count as their one token, as its library does by default.
    Null and empty texts have 0 bytes and 0 tokens. Rows are independent: null or repeated ids come
    out as they are, other columns are ignored.
    """

    def run(batches):
        store = chunk_store(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            numbers = store.numbered(texts)
            n = np.array([int(store.lengths[x].sum()) for x in numbers], np.int64)
            sizes = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(n), pa.array(n > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
