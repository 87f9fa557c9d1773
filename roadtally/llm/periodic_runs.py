"""Stretches of words that repeat with a period, found exactly in every text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from roadtally.llm.grammar import Grammar

LEAST_WORDS = 24
LEAST_PERIODS = 3
# Texts are taken together up to about so many characters; a longer text is taken alone.
PART_CHARS = 2_000_000
# Most words that are compared on either side of a place before the grammar is asked.
BESIDE = 4

_GAPS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def text_words(text: str | None) -> list[bytes]:
    """Words between spaces and the controls 9 to 13, as UTF-8 bytes."""
    return (text or "").encode().translate(_GAPS).split()


class _Numbers(dict):
    """A number from 0 for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


def grid(lengths: np.ndarray, least: int, periods: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``period, stride, sequence, place`` of all candidates, for sequences from the longest down.

    A run of period q has words that equal those q further on in a stretch of at least
    ``max(least, periods * q) - q`` places, so places that far apart meet every run. The number of
    places is the harmonic sum of the length over the periods.
    """
    longest = int(lengths[0]) if len(lengths) else 0
    for q in range(1, longest // periods + 1):
        run = max(least, periods * q)
        count = int(np.searchsorted(-lengths, -run, side="right"))  # sequences that could hold it
        if not count:
            return
        stride = run - q
        places = (lengths[:count] - q + stride - 1) // stride
        seq = np.repeat(np.arange(count), places)
        yield q, stride, seq, (np.arange(len(seq)) - np.repeat(np.cumsum(places) - places, places)) * stride


def runs_of(
    sequences: list[np.ndarray], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> list[np.ndarray]:
    """Rows ``start, length, period`` of all runs of each sequence, by start, then period.

    Candidates on the grid whose neighbourhood repeats are extended both ways by a grammar of the
    sequences that have any. An extension with a multiple of the smallest period ends where that
    with the smallest does, so of equal stretches the smallest period stays.
    """
    if periods < 2:
        raise ValueError("a run has two periods at least")
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(sequences)
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    lengths = np.array([len(sequences[i]) for i in order], np.int64)
    if not len(lengths) or lengths[0] < least:
        return out
    starts = np.cumsum(lengths) - lengths
    # One number that no word has, so that places behind the end equal none.
    flat = np.concatenate([*(sequences[i] for i in order), np.array([-1])]).astype(np.int64)
    found = []
    for q, stride, seq, place in grid(lengths, least, periods):
        at = starts[seq] + place
        hit = np.flatnonzero(flat[at] == flat[at + q])
        if not len(hit):
            continue
        seq, at, place = seq[hit], at[hit], place[hit]
        room = lengths[seq] - q
        after = np.ones(len(at), bool)
        before = np.ones(len(at), bool)
        # A run holds half a stride of places on one side at least.
        for k in range(1, min(BESIDE, stride // 2) + 1):
            x, y = np.minimum(at + k, len(flat) - 1 - q), np.maximum(at - k, 0)
            after &= (place + k < room) & (flat[x] == flat[x + q])
            before &= (place >= k) & (flat[y] == flat[y + q])
        near = after | before
        if near.any():
            found.append((seq[near], place[near], np.full(int(near.sum()), q)))
    if not found:
        return out
    seq, place, period = (np.concatenate(x) for x in zip(*found))
    held = np.unique(seq)
    at_held = np.searchsorted(held, seq)
    marks = int(flat.max()) + 1
    pieces, begins, filled = [np.array([marks])], [], 1
    for number, s in enumerate(held.tolist(), 1):
        pieces += [sequences[order[s]], np.array([marks + number])]
        begins.append(filled)
        filled += int(lengths[s]) + 1
    grammar = Grammar(np.concatenate(pieces))
    left = np.array(begins, np.int64)[at_held] + place
    right = left + period
    forward, backward = grammar.extend(left, right), grammar.extend(left, right, backward=True)
    length = forward + backward + period
    enough = length >= np.maximum(least, periods * period)
    rows = np.stack([at_held, place - backward, length, period], 1)[enough]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    ends = np.searchsorted(rows[:, 0], np.arange(len(held) + 1))
    for i, s in enumerate(held.tolist()):
        out[order[s]] = rows[ends[i] : ends[i + 1], 1:]
    return out


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded text, so that memory does not follow the batch's bytes."""
    lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths) - lengths) // PART_CHARS
    begins = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        yield batch.slice(a, b - a)


def find_runs(
    docs: DataFrame, id_col: str, text_col: str, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> DataFrame:
    """Runs of each text and the text without its repeats: ``id, n_words, runs, collapsed``.

    A run is a longest stretch in which words one smallest period apart are equal, of at least
    ``least`` words and ``periods`` periods. ``runs`` lists ``start, length, period`` by start, then
    period; ``collapsed`` joins by a space the words that no run contains after its first period.
    A null or empty text has no words and no runs. Rows are independent: null or repeated ids come
    out as they are, other columns are ignored, an empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                texts = [text_words(t) for t in part.column(1).to_pylist()]
                number = _Numbers().__getitem__
                coded = [np.fromiter(map(number, words), np.int64, len(words)) for words in texts]
                found = runs_of(coded, least, periods)
                flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                fields = [pa.array(flat[:, c]) for c in range(3)]
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                collapsed = [b" ".join(without_repeats(w, r)).decode() for w, r in zip(texts, found)]
                sizes = pa.array([len(w) for w in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), sizes, lists, pa.array(collapsed, pa.string())], ["id", "n_words", "runs", "collapsed"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run,
        f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )
