"""Longest common extensions in a sequence of integers, by a difference cover.

Only the places whose remainder modulo ``SPAN`` lies in ``COVER`` are sorted as suffixes, about a fifth of
all. Any two remainders differ as some two members of the cover do, so from any two places fewer than
``SPAN`` steps lead to two sorted ones at once: these few values are compared one by one, and a sparse
table of minima over the common prefixes of neighbours gives the rest. All queries of a call are answered
together as numpy arrays.
"""

from __future__ import annotations

import numpy as np

#: Every difference modulo 31 is the difference of exactly one pair of members.
SPAN = 31
COVER = (1, 5, 11, 24, 25, 27)


def _first_members() -> np.ndarray:
    """For each difference d, the member m of the cover for which (m + d) % SPAN is a member as well."""
    out = np.full(SPAN, -1)
    for first in COVER:
        for second in COVER:
            out[(second - first) % SPAN] = first
    return out


_FIRST = _first_members()


class Extensions:
    """``values`` must be 0 or more and below 2^32 - 1, and end in a value that occurs only there."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = len(values)
        places = [np.arange(member, n, SPAN) for member in COVER]
        #: Sampled places member by member; one step on is SPAN values on.
        self.sample = np.concatenate(places)
        self.base = np.full(SPAN, -1)
        self.base[list(COVER)] = np.cumsum([0, *(len(one) for one in places[:-1])])
        self.padded = np.concatenate((values.astype(">u4") + 1, np.zeros(SPAN, ">u4"))).astype(">u4")
        self._sort()

    def _blocks(self, sample: np.ndarray) -> np.ndarray:
        windows = np.lib.stride_tricks.sliding_window_view(self.padded, SPAN)
        return np.ascontiguousarray(windows[self.sample[sample]])

    def _sort(self) -> None:
        m = len(self.sample)
        blocks = self._blocks(np.arange(m))
        order = np.argsort(blocks.view(f"S{4 * SPAN}").ravel(), kind="stable") if m else np.zeros(0, int)
        ranks = self._ranked(order, (blocks[order][1:] != blocks[order][:-1]).any(axis=1))
        levels, step = [ranks], 1
        while m and ranks.max() < m - 1:
            # Suffixes that begin alike in ``step`` blocks are told apart by the next ``step``.
            after = np.full(m, -1)
            after[: m - step] = ranks[step:]
            after[self.sample + step * SPAN >= len(self.values)] = -1
            keys = ranks * (m + 1) + after + 1
            order = np.argsort(keys, kind="stable")
            ranks = self._ranked(order, keys[order][1:] != keys[order][:-1])
            levels.append(ranks)
            step *= 2
        self.rank = ranks
        self.minima = self._minima(self._neighbours(order, levels))

    @staticmethod
    def _ranked(order: np.ndarray, new: np.ndarray) -> np.ndarray:
        ranks = np.zeros(len(order), np.int64)
        ranks[order[1:]] = np.cumsum(new)
        return ranks

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sorted suffix and the one before it, in values; 0 for the first."""
        out = np.zeros(len(order), np.int64)
        left, right = order[:-1].copy(), order[1:].copy()
        for level in range(len(levels) - 1, -1, -1):
            # Equal blocks hold no end, so both suffixes go on behind them.
            alike = levels[level][left] == levels[level][right]
            left[alike] += 1 << level
            right[alike] += 1 << level
            out[1:][alike] += SPAN << level
        for at in range(0, len(left), 1 << 16):
            part = slice(at, at + (1 << 16))
            differ = self._blocks(left[part]) != self._blocks(right[part])
            out[1:][part] += differ.argmax(axis=1)
        return out

    @staticmethod
    def _minima(row: np.ndarray) -> list[np.ndarray]:
        rows, step = [row.astype(np.int32)], 1
        while 2 * step <= len(row):
            last = rows[-1]
            rows.append(np.minimum(last[: len(last) - step], last[step:]))
            step *= 2
        return rows

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values from each ``i`` on equal those from its ``j`` on; i and j differ."""
        out = np.zeros(len(i), np.int64)
        steps = (_FIRST[(j - i) % SPAN] - i) % SPAN
        open_ = np.arange(len(i))
        for at in range(SPAN):
            there = open_[steps[open_] <= at]
            if len(there):
                out[there] = at + self._sampled(i[there] + at, j[there] + at)
                open_ = open_[steps[open_] > at]
            if not len(open_):
                break
            # A step never leaves the sequence: its last value equals no other one.
            alike = self.values[i[open_] + at] == self.values[j[open_] + at]
            out[open_[~alike]] = at
            open_ = open_[alike]
        return out

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        first = self.rank[self.base[i % SPAN] + i // SPAN]
        second = self.rank[self.base[j % SPAN] + j // SPAN]
        low, high = np.minimum(first, second) + 1, np.maximum(first, second) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.zeros(len(i), np.int64)
        for one in np.unique(level).tolist():
            at = level == one
            row = self.minima[one]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << one)])
        return out
