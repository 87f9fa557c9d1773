"""Run-length grammars of word sequences by recompression, and extensions read off them.

Sequences lie end to end between marks that occur once each. Block compression turns every maximal
run of one symbol into a symbol; pair compression splits the symbols of a level in left and right
ones and turns every left-right pair into a symbol. Both look at a place's neighbours only, so equal
stretches are parsed alike but near their ends, and one symbol names one stretch of words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Rounds end when a pair round shortens all sequences together by less than this share.
LEAST_SHRINK = 1 / 64


@dataclass
class _Level:
    symbol: np.ndarray  # of each token
    child: np.ndarray  # first token below; itself at the bottom
    head: np.ndarray  # token above that starts here, else -1
    tail: np.ndarray  # token above that ends here, else -1
    ahead: np.ndarray  # equal symbols from here on, itself included
    behind: np.ndarray  # equal symbols up to here, itself included


def _repeats(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])) if len(symbol) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(symbol)))
    behind = np.arange(len(symbol)) - np.repeat(starts, sizes) + 1
    return (np.repeat(sizes, sizes) - behind + 1).astype(np.int32), behind.astype(np.int32)


def _right_side(symbol: np.ndarray, level: int) -> np.ndarray:
    """A side for each symbol by a mixed bit of it, another mix on every level."""
    with np.errstate(over="ignore"):
        x = (symbol.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40) & np.uint64(1)).astype(bool)


class Grammar:
    """All levels of the parse of some sequences, which :meth:`extend` compares."""

    def __init__(self, words: np.ndarray) -> None:
        """``words`` are numbers from 0; marks between sequences have to be numbers of their own."""
        self.levels: list[_Level] = []
        symbol = np.ascontiguousarray(words, np.int64)
        child = np.arange(len(symbol))
        fresh = int(symbol.max(initial=-1)) + 1
        while True:
            ahead, behind = _repeats(symbol)
            starts, made, fresh = self._blocks(symbol, ahead, behind, fresh)
            if len(starts) == len(symbol):
                starts, made, fresh = self._pairs(symbol, fresh, len(self.levels))
                if len(symbol) - len(starts) <= LEAST_SHRINK * len(symbol):
                    none = np.full(len(symbol), -1, np.int32)
                    self.levels.append(_Level(symbol, child, none, none, ahead, behind))
                    return
            head = np.full(len(symbol), -1, np.int32)
            tail = np.full(len(symbol), -1, np.int32)
            above = np.arange(len(starts), dtype=np.int32)
            head[starts] = above
            tail[np.append(starts[1:], len(symbol)) - 1] = above
            self.levels.append(_Level(symbol, child, head, tail, ahead, behind))
            symbol, child = made, starts

    @staticmethod
    def _blocks(symbol, ahead, behind, fresh):
        """Starts and symbols of the level above, with every block of two or more as one symbol."""
        starts = np.flatnonzero(behind == 1)
        made = symbol[starts].copy()
        long = np.flatnonzero(ahead[starts] > 1)
        if len(long):
            keys = np.stack([made[long], ahead[starts[long]].astype(np.int64)], 1)
            names, of = np.unique(keys, axis=0, return_inverse=True)
            made[long] = fresh + of.ravel()
            fresh += len(names)
        return starts, made, fresh

    @staticmethod
    def _pairs(symbol, fresh, level):
        right = _right_side(symbol, level)
        first = np.flatnonzero(~right[:-1] & right[1:]) if len(symbol) else np.zeros(0, np.int64)
        kept = np.ones(len(symbol), bool)
        kept[first + 1] = False
        starts = np.flatnonzero(kept)
        made = symbol.copy()
        if len(first):
            names, of = np.unique(symbol[first] * fresh + symbol[first + 1], return_inverse=True)
            made[first] = fresh + of
            fresh += len(names)
        return starts, made[starts], fresh

    def extend(self, left: np.ndarray, right: np.ndarray, backward: bool = False) -> np.ndarray:
        """How many words agree from ``left[i]`` and ``right[i]`` on, or before them.

        All queries move together: up while both places begin (or end) tokens of one symbol on the
        level above, aside over as many equal symbols as both runs have, and down where symbols
        differ, until words differ. The places have to differ and lie between the same marks, one
        at least of which stands on either side, so that no query leaves the sequences.
        """
        way = -1 if backward else 1
        a = np.asarray(left, np.int64) - (1 if backward else 0)
        b = np.asarray(right, np.int64) - (1 if backward else 0)
        begin = a.copy()
        out = np.zeros(len(a), np.int64)
        who = np.arange(len(a))
        level = np.zeros(len(a), np.int64)
        while len(who):
            ended = np.zeros(len(who), bool)
            for h in np.unique(level).tolist():
                here = np.flatnonzero(level == h)
                own = self.levels[h]
                x, y = a[here], b[here]
                same = own.symbol[x] == own.symbol[y]
                up = own.tail if backward else own.head
                ux, uy = up[x], up[y]
                if h + 1 < len(self.levels):
                    above = self.levels[h + 1].symbol
                    climbs = same & (ux >= 0) & (uy >= 0)
                    climbs[climbs] = above[ux[climbs]] == above[uy[climbs]]
                else:
                    climbs = np.zeros(len(here), bool)
                aside = same & ~climbs
                run = own.behind if backward else own.ahead
                step = np.minimum(run[x], run[y]).astype(np.int64)
                x = np.where(climbs, ux, np.where(aside, x + way * step, x))
                y = np.where(climbs, uy, np.where(aside, y + way * step, y))
                down = ~same
                if h:
                    x[down], y[down] = (self._below(h, v[down], backward) for v in (x, y))
                else:
                    ended[here[down]] = True
                level[here] += climbs.astype(np.int64) - (down & (h > 0))
                a[here], b[here] = x, y
            if ended.any():
                out[who[ended]] = way * (a[ended] - begin[who[ended]])
                left_over = ~ended
                a, b, who, level = a[left_over], b[left_over], who[left_over], level[left_over]
        return out

    def _below(self, h: int, token: np.ndarray, last: bool) -> np.ndarray:
        child = self.levels[h].child
        if not last:
            return child[token]
        below = len(self.levels[h - 1].symbol)
        following = np.minimum(token + 1, len(child) - 1)
        return np.where(token + 1 < len(child), child[following], below) - 1
