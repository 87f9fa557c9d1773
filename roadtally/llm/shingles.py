"""Word shingles as sorted arrays of 64-bit hashes, and points that bound their overlap."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

SHINGLE_WORDS = 5
LEAST_BITS = 6
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_MOST_WORDS = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _MOST_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct five-word shingles of a text, hashed and sorted.

    Words are split at ASCII white space after A-Z became lower case. Fewer words make one shingle
    of the whole sequence; no words make none. Two shingles share a hash with a probability of
    2**-64, so that of an error in comparing two texts of n shingles is about n * n * 2**-64.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = min(len(words), SHINGLE_WORDS)
    with np.errstate(over="ignore"):
        mixed = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            part = h[k : len(h) - n + 1 + k] * _ODD[k]
            mixed += part ^ part >> np.uint64(29)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
    mixed.sort()
    return mixed[np.append(True, mixed[1:] != mixed[:-1])]


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit name of a set, as two signed longs."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def point(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each group, one byte a group.

    A set of n shingles is counted in n / 2 groups or a little more, as a power of two: with fewer,
    unrelated sets of some length have nearly equal counts. A group is told by the top bits of the
    hash, so :func:`fold` makes a coarser point of a finer one.
    """
    bits = max(LEAST_BITS, (max(len(shingles), 2) // 2 - 1).bit_length())
    while True:
        counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        bits += 1


def fold(points: np.ndarray, groups: int) -> np.ndarray:
    """Points in the last axis, counted in fewer groups; wider numbers where they are needed."""
    if points.shape[-1] == groups:
        return points
    return points.reshape(*points.shape[:-1], groups, -1).sum(-1, dtype=np.uint16)
