"""Byte-level BPE encoding by replaying merges over all new pre-tokens of a batch in rank order."""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadtally.llm.vocabulary import NO_RANK, ChunkStore, PairTable, rank_file

# Text of at most about so many characters is merged together; a longer text makes a batch alone.
BATCH_CHARS = 16_000_000


def replay(pairs: PairTable, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Apply every merge in rank order to sequences that lie end to end.

    An inverted index leads from a rank to the places where its pair stands. The lowest rank with
    places left is taken from a heap, all its places are merged at once, and only the two
    neighbours of each are looked up anew. A merge whose product can form a pair of lower rank is
    applied to one place of a sequence at a time, so that the lower pair goes first.
    """
    symbols = symbols.copy()
    n = len(symbols)
    word = np.repeat(np.arange(len(sizes)), sizes)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    row = np.full(n + 1, len(pairs.rank) - 1, np.int64)  # of the pair that starts at a place
    inner = np.flatnonzero(word[1:] == word[:-1])
    row[inner] = pairs.find(symbols[inner], symbols[inner + 1])
    alive = np.ones(n, bool)

    ranks = pairs.rank[row[inner]]
    inner = inner[ranks < NO_RANK]
    ranks = ranks[ranks < NO_RANK]
    order = np.argsort(ranks, kind="stable")
    first, begins = np.unique(ranks[order], return_index=True)
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    for r, places in zip(first.tolist(), np.split(inner[order], begins[1:])):
        index[r].append(places)
    heap = first.tolist()

    while heap:
        r = heapq.heappop(heap)
        held = index.pop(r)
        places = held[0] if len(held) == 1 else np.concatenate(held)
        places = np.sort(places[pairs.rank[row[places]] == r])
        if not len(places):
            continue
        places = places[np.diff(places, prepend=-1) > 0]
        if len(places) > 1:
            if pairs.delicate[row[places]].any():
                later = np.append(False, word[places[1:]] == word[places[:-1]])
                if later.any():
                    index[r].append(places[later])
                    heapq.heappush(heap, r)
                    places = places[~later]
            else:
                places = _apart(places, after)
        gone = after[places]
        symbols[places] = pairs.made[row[places]]
        alive[gone] = False
        row[gone] = len(pairs.rank) - 1
        follow = after[gone]
        after[places] = follow
        inside = follow < n
        before[follow[inside]] = places[inside]

        touched = np.concatenate([places, before[places]])
        touched = touched[touched >= 0]
        touched = touched[alive[touched]]
        nearby = after[touched]
        joined = nearby < n
        joined[joined] = word[nearby[joined]] == word[touched[joined]]
        row[touched] = len(pairs.rank) - 1
        touched, nearby = touched[joined], nearby[joined]
        if not len(touched):
            continue
        row[touched] = pairs.find(symbols[touched], symbols[nearby])
        ranks = pairs.rank[row[touched]]
        useful = ranks < NO_RANK
        touched, ranks = touched[useful], ranks[useful]
        if not len(touched):
            continue
        order = np.argsort(ranks, kind="stable")
        ranks, touched = ranks[order], touched[order]
        edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begins = [0, *edges.tolist(), len(ranks)]
        for k, new in enumerate(ranks[begins[:-1]].tolist()):
            if new not in index:
                heapq.heappush(heap, new)
            index[new].append(touched[begins[k] : begins[k + 1]])
    return symbols[alive], np.bincount(word[alive], minlength=len(sizes))


def _apart(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """From the left, drop places whose first symbol the merge before them takes."""
    chained = np.append(False, after[places[:-1]] == places[1:])
    if not chained.any():
        return places
    starts = np.flatnonzero(~chained)
    within = np.arange(len(places)) - np.repeat(starts, np.diff(np.append(starts, len(places))))
    return places[within % 2 == 0]


@functools.lru_cache(maxsize=2)
def _store(path: str, pattern: str) -> ChunkStore:
    return ChunkStore(rank_file(path), pattern, replay)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part has much more than the wanted amount of text."""
    sizes = np.asarray(batch.column(1).to_pandas().str.len().fillna(0), np.int64)
    part = (np.cumsum(sizes) - sizes) // BATCH_CHARS
    begins = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        yield batch.slice(a, b - a)


def encode(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """Token ids of each text: ``id, ids``.

    A null or empty text has no ids. Rows are independent: null or repeated ids come out as they
    are, other columns are ignored.
    """

    def run(batches):
        store = _store(path, pattern)
        for batch in batches:
            for part in _parts(batch):
                numbers = store.numbered(t or "" for t in part.column(1).to_pylist())
                ids = [store.ids(x) for x in numbers]
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _pair(docs, id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Bytes of each list of ids: ``id, decoded``; null ids decode to no bytes."""

    def run(batches):
        tokens = rank_file(path).tokens
        for batch in batches:
            texts = [b"".join(map(tokens.__getitem__, x or ())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["id", "decoded"])

    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "ids").mapInArrow(run, f"id {kind}, decoded binary")


def round_trip_digests(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """Encode, decode the ids again, and return digests of both: ``id, n_tokens, ids_sha256,
    decoded_sha256``. The ids stay in the task that made them. Null texts count as empty.
    """

    def run(batches):
        store = _store(path, pattern)
        tokens = store.vocabulary.tokens
        written = {i: str(i) for i in tokens}
        for batch in batches:
            for part in _parts(batch):
                numbers = store.numbered(t or "" for t in part.column(1).to_pylist())
                counts, of_ids, of_bytes = [], [], []
                for x in numbers:
                    ids = store.ids(x).tolist()
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(written.__getitem__, ids)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(b"".join(map(tokens.__getitem__, ids))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return _pair(docs, id_col, text_col).mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _pair(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
