"""Byte-level BPE vocabularies: merge tables, the split into pre-tokens, a store of known chunks.

Nothing here runs on the driver's side of a job; tasks load a vocabulary once per Python worker.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import regex

NO_RANK = np.int64(2**40)
_SLOT_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank and product of each mergeable pair of symbols, looked up for whole arrays at once."""

    def __init__(self, left, right, rank, made) -> None:
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        self.rank = np.append(np.asarray(rank, np.int64), NO_RANK)
        self.made = np.append(np.asarray(made, np.int64), -1)
        keys = left << 32 | right
        size = 1 << max(_SLOT_BITS, int(2 * len(keys)).bit_length())
        self._shift = np.uint64(64 - size.bit_length() + 1)
        self._mask = size - 1
        self._keys = np.full(size, -1, np.int64)
        self._at = np.full(size, len(keys), np.int64)
        todo, slot = np.arange(len(keys)), self._slots(keys)
        while len(todo):
            free = self._keys[slot] < 0
            first = np.unique(slot[free], return_index=True)[1]
            chosen = np.flatnonzero(free)[first]
            self._keys[slot[chosen]] = keys[todo[chosen]]
            self._at[slot[chosen]] = todo[chosen]
            left_over = np.ones(len(todo), bool)
            left_over[chosen] = False
            todo, slot = todo[left_over], (slot[left_over] + 1) & self._mask
        # A product is delicate if some pair that holds it ranks before the merge that made it:
        # then a merge may bring up a pair that has to go first.
        earliest = np.full(int(max(left.max(), right.max(), self.made.max())) + 1, NO_RANK)
        np.minimum.at(earliest, left, self.rank[:-1])
        np.minimum.at(earliest, right, self.rank[:-1])
        self.delicate = np.append(earliest[self.made[:-1]] < self.rank[:-1], False)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.astype(np.uint64) * _SPREAD >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of each pair in ``rank`` and ``made``; the last row stands for no merge."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slots(keys)
        found = self._keys[slot]
        out = self._at[slot]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self._mask
            found = self._keys[slot[open_]]
            out[open_] = self._at[slot[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        stray = self._keys[slot] != keys
        out[stray] = len(self.rank) - 1
        return out


class Vocabulary:
    """``tokens``: bytes by id; ``whole``: pieces that are one token without any merge."""

    def __init__(self, tokens, byte_ids, pairs, whole, special) -> None:
        self.tokens: dict[int, bytes] = tokens
        self.byte_ids: np.ndarray = byte_ids
        self.pairs: PairTable = pairs
        self.whole: dict[bytes, int] = whole
        self.special: dict[str, int] = special


@functools.lru_cache(maxsize=4)
def rank_file(path: str) -> Vocabulary:
    """A vocabulary stored as ranks: two symbols merge if their joined bytes have a rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    left, right, rank = [], [], []
    for token, r in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a), right.append(b), rank.append(r)
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    return Vocabulary({r: t for t, r in ranks.items()}, byte_ids, PairTable(left, right, rank, rank), ranks, {})


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: visible Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def merge_file(path: str) -> Vocabulary:
    """A vocabulary stored as a list of merges in rank order."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    letters = byte_letters()
    ids = stored["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in stored["model"]["merges"]]
    tokens = {i: bytes(letters[c] for c in t) for t, i in ids.items()}
    pairs = PairTable(
        [ids[a] for a, _ in merges],
        [ids[b] for _, b in merges],
        range(len(merges)),
        [ids[a + b] for a, b in merges],
    )
    byte_ids = np.zeros(256, np.int64)
    byte_ids[list(letters.values())] = [ids[c] for c in letters]
    special = {t["content"]: t["id"] for t in stored["added_tokens"]}
    tokens |= {i: t.encode() for t, i in special.items()}
    return Vocabulary(tokens, byte_ids, pairs, {}, special)


@functools.lru_cache(maxsize=1)
def _later_characters() -> frozenset[str]:
    """Letters and digits that the pattern library knows and the tokenizer library does not yet."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False)
    unknown = "".join(
        c
        for c in map(chr, range(sys.maxunicode + 1))
        if not 0xD800 <= ord(c) < 0xE000 and unicodedata.category(c) == "Cn"
    )
    later = [c for c in regex.findall(r"\p{L}", unknown) if len(split.pre_tokenize_str(f"a{c}a")) > 1]
    later += [c for c in regex.findall(r"\p{N}", unknown) if len(split.pre_tokenize_str(f"1{c}1")) > 1]
    return frozenset(later)


class Splitter:
    """Cuts a text into chunks whose tokens do not depend on what stands around them."""

    # A space at which a chunk cannot begin: white space follows, or nothing.
    _loose = re.compile(r" (?=\s|\Z)")

    def __init__(self, pattern: str) -> None:
        self._pattern = regex.compile(pattern)

    def pretokens(self, text: str) -> list[str]:
        if text.isascii() or _later_characters().isdisjoint(text):
            return self._pattern.findall(text)
        masked = text.translate(dict.fromkeys(map(ord, _later_characters()), "\ufffd"))
        return [text[m.start() : m.end()] for m in self._pattern.finditer(masked)]

    def chunks(self, text: str) -> tuple[list[str], list[str]]:
        """Chunks as they stand, then chunks that lack the space they begin with (and hold none)."""
        if self._loose.search(text):
            return self.pretokens(text), []
        first, *rest = text.split(" ")
        return [first], rest


class _Numbers(dict):
    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.new.append(key)
        return number


# Merges symbol sequences, laid end to end and cut at the given starts, into fewer symbols.
Merger = Callable[[PairTable, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class ChunkStore:
    """Token ids of every chunk seen, kept over batches up to ``most`` chunks.

    Texts become arrays of chunk numbers; new chunks of a whole batch are merged together.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, merge: Merger, most: int = 400_000):
        self.vocabulary, self._merge, self._most = vocabulary, merge, most
        self._split = Splitter(pattern)
        self._clear()
        special = sorted(vocabulary.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def _clear(self) -> None:
        self._numbers = _Numbers()
        self._flat = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int64)
        self._starts = np.zeros(0, np.int64)

    def numbered(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Chunk numbers of each text; ``lengths`` and :meth:`ids` know them until the next call."""
        if len(self._numbers) > self._most:
            self._clear()
        find = self._numbers.__getitem__
        out = []
        for text in texts:
            parts = self._special.split(text) if self._special and "<" in text else [text]
            found: list[int] = []
            for k, part in enumerate(parts):
                if k % 2:
                    found.append(find((self.vocabulary.special[part],)))
                    continue
                whole, spaced = self._split.chunks(part)
                found += map(find, map(" ".__add__, whole))
                found += map(find, spaced)
            out.append(np.array(found, np.int32))
        self._encode_new()
        return out

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """Token ids of a text given as chunk numbers."""
        return ragged(self._flat, self._starts[numbers], self.lengths[numbers])

    def _encode_new(self) -> None:
        new, self._numbers.new = self._numbers.new, []
        if not new:
            return
        spaced = [k for k, key in enumerate(new) if type(key) is str and key[:1] != " "]
        pieces = self._split.pretokens("".join([" " + new[k] for k in spaced]))
        # A chunk's own space begins its first piece, and no other piece begins with a space.
        begins = np.flatnonzero(np.fromiter((p[0] == " " for p in pieces), bool, len(pieces)))
        counts = np.zeros(len(new), np.int64)
        first = np.zeros(len(new), np.int64)
        counts[spaced] = np.diff(np.append(begins, len(pieces)))
        first[spaced] = begins
        for k in sorted(set(range(len(new))).difference(spaced)):
            own = [new[k]] if type(new[k]) is tuple else self._split.pretokens(new[k][1:])
            first[k], counts[k] = len(pieces), len(own)
            pieces += own
        distinct = dict.fromkeys(pieces)
        number = dict(zip(distinct, range(len(distinct))))
        order = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        order = ragged(order, first, counts)
        flat, lengths = self._encode([p[0] if type(p) is tuple else p.encode() for p in distinct])
        starts = np.cumsum(lengths) - lengths
        ids = ragged(flat, starts[order], lengths[order])
        ends = np.cumsum(counts)
        sums = np.append(0, np.cumsum(lengths[order]))
        own_lengths = sums[ends] - sums[ends - counts]
        begun = len(self._flat)
        self._flat = np.concatenate([self._flat, ids.astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, own_lengths])
        self._starts = np.concatenate([self._starts, begun + np.cumsum(own_lengths) - own_lengths])

    def _encode(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, end to end, and the number of ids of each."""
        whole = self.vocabulary.whole
        known = np.array([p if type(p) is int else whole.get(p, -1) for p in pieces], np.int64)
        open_ = np.flatnonzero(known < 0)
        lengths = np.ones(len(pieces), np.int64)
        raw = [pieces[k] for k in open_]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.vocabulary.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        merged, merged_sizes = self._merge(self.vocabulary.pairs, symbols, sizes)
        lengths[open_] = merged_sizes
        flat = np.repeat(known, lengths)
        flat[np.repeat(known < 0, lengths)] = merged
        return flat, lengths


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` with the given starts and lengths, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
