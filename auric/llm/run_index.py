"""A run-length index of texts: run-compressed Burrows-Wheeler transform, sampled run ends.

The texts are laid end to end, each closed by the byte 0xFF, which no UTF-8 text holds. Of
the transform only its runs are kept (head, start, rank of the head before it) and the
suffix positions at each run's first and last row: enough to step back by one letter, and
to have a place in the text for every match. ``matching_statistics`` streams patterns
from right to left, all patterns of a batch in step: where the row's letter is the wanted
one, the match grows by it; else it jumps to the end of the nearest run of that letter
above or below, whichever keeps more of the match.
"""

from __future__ import annotations

import numpy as np

END = 0xFF
_BYTE_LIMITS = [np.uint64(1) << np.uint64(8 * k) for k in range(7, 0, -1)]


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as one number (0 beyond the end)."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    n = len(data)
    for k, shift in ((1, 8), (2, 16), (4, 32)):
        wide = np.concatenate([(wide[:-k] << np.uint64(shift)) | wide[k:],
                               np.zeros(k, np.uint64)])
    return wide[:n]


def suffix_order(data: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the prefix that is sorted; suffixes that are told
    apart already take no further part."""
    n = len(data)
    order = np.argsort(words, kind="stable")
    new = np.ones(n, bool)
    new[1:] = words[order][1:] != words[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    alone = new & np.append(new[1:], True)
    place = np.flatnonzero(~alone)
    h = 8
    while len(place):
        at = order[place]
        after = at + h
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[place] = at
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[at] = place[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        place = place[~(new & np.append(new[1:], True))]
        h *= 2
    return order


class RunIndex:
    """Index of ``data``: texts that end in ``END`` each."""

    def __init__(self, data: np.ndarray, least: int):
        """``least``: the length from which suffixes count as the same place (group)."""
        n = self.n = len(data)
        self.words = np.concatenate([packed(data), np.zeros(8, np.uint64)])
        order = suffix_order(data, self.words[:n])
        letter = data[order - 1]
        new = np.ones(n, bool)
        new[1:] = letter[1:] != letter[:-1]
        self.start = np.flatnonzero(new)
        self.head = letter[self.start].astype(np.int64)
        size = np.diff(np.append(self.start, n))
        # runs by letter: C[letter] + how many of the letter lie before the run
        self.by_letter = np.argsort(self.head, kind="stable")
        self.slot = np.empty(len(self.start), np.int64)
        self.slot[self.by_letter] = np.arange(len(self.start))
        self.letter = self.head[self.by_letter]
        self.key = self.letter * (n + 1) + self.start[self.by_letter]
        self.before = np.cumsum(size[self.by_letter]) - size[self.by_letter]
        self.first = order[self.start][self.by_letter]           # sampled run ends
        self.last = order[self.start + size - 1][self.by_letter]
        self.last_row = (self.start + size - 1)[self.by_letter]
        self.first_row = self.start[self.by_letter]
        self.origin = int(order[0])
        # rows whose suffixes agree in ``least`` bytes form a group
        lcp = self.common(order[1:], order[:-1], np.full(n - 1, least))
        self.group = np.concatenate([[0], np.flatnonzero(lcp < least) + 1])
        self._order = order

    @property
    def runs(self) -> int:
        return len(self.start)

    def least_in_groups(self, value: np.ndarray) -> np.ndarray:
        """The smallest ``value`` (one for each position of the text) in each group."""
        return np.minimum.reduceat(value[self._order], self.group)

    def forget_order(self) -> None:
        self._order = None

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes agree from positions ``a`` and ``b`` on, up to ``most``."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            done = out[live]
            x = (self.words[np.minimum(a[live] + done, self.n)]
                 ^ self.words[np.minimum(b[live] + done, self.n)])
            same = np.full(len(live), 8)
            differ = x != 0
            y = x[differ]
            same[differ] = sum((y < limit).astype(np.int64) for limit in _BYTE_LIMITS)
            out[live] = done + same
            live = live[~differ & (out[live] < most[live])]
        return np.minimum(out, most)

    def matching_statistics(self, data: np.ndarray, first: np.ndarray, size: np.ndarray
                            ) -> tuple[np.ndarray, np.ndarray]:
        """For each position of the patterns ``data[first:first + size]`` the length of the
        longest match that begins there and the row of one such match, as arrays that lie
        like ``data``."""
        length, rows = np.zeros(len(data), np.int32), np.zeros(len(data), np.int64)
        by = np.argsort(-size, kind="stable")
        end, size = (first + size)[by], size[by]
        row = np.zeros(len(by), np.int64)
        pos = np.full(len(by), self.origin)
        match = np.zeros(len(by), np.int64)
        for t in range(int(size[0]) if len(size) else 0):
            m = np.searchsorted(-size, -t, "left")            # patterns longer than t
            c = data[end[:m] - 1 - t].astype(np.int64)
            q = row[:m]
            run = np.searchsorted(self.start, q, "right") - 1
            hit = self.head[run] == c
            step = self.before[self.slot[run]] + q - self.start[run]
            near, reach = pos[:m] - 1, match[:m] + 1
            miss = np.flatnonzero(~hit)
            if len(miss):
                step[miss], near[miss], reach[miss] = self._jump(
                    c[miss], q[miss], pos[:m][miss], match[:m][miss])
            row[:m], pos[:m], match[:m] = step, near, reach
            at = end[:m] - 1 - t
            length[at], rows[at] = reach, step
        return length, rows

    def _jump(self, c, row, pos, match):
        """To the last row of the run of ``c`` above, or the first of the one below."""
        below = np.searchsorted(self.key, c * (self.n + 1) + row)
        above = below - 1
        top = len(self.key) - 1
        has_below = (below <= top) & (self.letter[np.minimum(below, top)] == c)
        has_above = (above >= 0) & (self.letter[np.maximum(above, 0)] == c)
        below, above = np.minimum(below, top), np.maximum(above, 0)
        down = np.where(has_below, self.common(pos, self.first[below], match), -1)
        up = np.where(has_above, self.common(pos, self.last[above], match), -1)
        lower = down >= up
        run = np.where(lower, below, above)
        at_row = np.where(lower, self.first_row[run], self.last_row[run])
        at_pos = np.where(lower, self.first[run], self.last[run])
        kept = np.maximum(down, up)
        step = self.before[run] + at_row - self.first_row[run]
        none = kept < 0                                        # the letter does not occur
        return (np.where(none, row, step), np.where(none, pos, at_pos - 1),
                np.where(none, 0, kept + 1))
