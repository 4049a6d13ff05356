"""Matching blocks of two sequences, exactly and at any length.

The longest common block first (of equals the one that starts first in a, then first in b), then what lies left and right of it, and so on: the opcodes that the standard
library's matcher gives without its junk rules, whose time grows with the product of the lengths.

Runs of 2^k items get ranks by doubling: equal runs in a and b have equal ranks, and a run of any length is named by the ranks of the two such runs that cover it. So
the greatest common length of two stretches is found by trying lengths, each in one sorted pass, and all blocks of that length that follow each other in both come
from one pass more. What is left between them has shorter blocks only; a chain of ever shorter blocks is no longer than the square root of twice the length.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import numpy as np

#: Pairs of places of a stretch that is left to the standard matcher, which is faster there.
CELLS = 1 << 15


class Runs:
    """Ranks of the runs of a and b."""

    def __init__(self, a: Sequence, b: Sequence):
        ids: dict = {}
        number = lambda items: np.fromiter((ids.setdefault(x, len(ids)) for x in items), np.int32, len(items))
        self.ranks = [(number(a), number(b))]
        self.width = len(a) + len(b) + 1  # more than any rank

    def doubled(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.ranks) <= k:
            half, (a, b) = 1 << len(self.ranks) - 1, self.ranks[-1]
            pairs = [x[: max(0, len(x) - half)].astype(np.int64) * self.width + x[half:] for x in (a, b)]
            ranks = np.unique(np.concatenate(pairs), return_inverse=True)[1].astype(np.int32)
            self.ranks.append((ranks[: len(pairs[0])], ranks[len(pairs[0]) :]))
        return self.ranks[k]

    def names(self, side: int, lo: int, hi: int, length: int) -> np.ndarray:
        """A number for each run of this length within [lo, hi) of a (side 0) or b (1)."""
        k = length.bit_length() - 1
        ranks = self.doubled(k)[side]
        more = length - (1 << k)
        return ranks[lo : hi - length + 1].astype(np.int64) * self.width + ranks[lo + more : hi - length + 1 + more]

    def meet(self, i: int, k: int, j: int, n: int, length: int) -> bool:
        return bool(np.isin(self.names(0, i, k, length), self.names(1, j, n, length)).any())

    def longest(self, i: int, k: int, j: int, n: int, most: int) -> int:
        """The greatest length, at most `most`, of a run that stands in a[i:k] and b[j:n]."""
        most, low = min(most, k - i, n - j), 0
        if most < 1:
            return 0
        high = 1
        while high <= most and self.meet(i, k, j, n, high):
            low, high = high, min(2 * high, most) if high < most else most + 1
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.meet(i, k, j, n, middle) else (low, middle)
        return low

    def chain(self, i: int, k: int, j: int, n: int, length: int) -> Iterator[tuple[int, int]]:
        """Starts of blocks of the greatest length: the first in a, with its first place in b, then the same to the right of both."""
        left, right = self.names(0, i, k, length), self.names(1, j, n, length)
        order = np.argsort(right, kind="stable")
        values = right[order]
        at = np.flatnonzero(np.isin(left, right))
        lows, highs = np.searchsorted(values, left[at]), np.searchsorted(values, left[at], "right")
        x, y = 0, 0
        for p, lo, hi in zip(at.tolist(), lows.tolist(), highs.tolist(), strict=True):
            if p < x:
                continue
            place = bisect_left(order, y, lo, hi)  # equal runs lie in the order of their places
            if place < hi:
                q = int(order[place])
                yield i + p, j + q
                x, y = p + length, q + length


def matching_blocks(a: Sequence, b: Sequence) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the blocks, rising; neighbours are joined."""
    runs, found = None, []
    todo = [(0, len(a), 0, len(b), min(len(a), len(b)))]
    while todo:
        i, k, j, n, most = todo.pop()
        if not most or i >= k or j >= n:
            continue
        if (k - i) * (n - j) <= CELLS:
            found += [(i + x, j + y, size) for x, y, size in SequenceMatcher(None, a[i:k], b[j:n], autojunk=False).get_matching_blocks() if size]
            continue
        runs = runs or Runs(a, b)
        length = runs.longest(i, k, j, n, most)
        if length:
            for x, y in runs.chain(i, k, j, n, length):
                found.append((x, y, length))
                todo.append((i, x, j, y, length - 1))
                i, j = x + length, y + length
            todo.append((i, k, j, n, length - 1))
    out: list[tuple[int, int, int]] = []
    for x, y, size in sorted(found):
        if out and out[-1][0] + out[-1][2] == x and out[-1][1] + out[-1][2] == y:
            x, y, size = *out[-1][:2], out.pop()[2] + size
        out.append((x, y, size))
    return out


def changes(a: Sequence, b: Sequence) -> list[tuple[str, int, int, int, int]]:
    """kind (replace, delete, insert), from and to in a, from and to in b: what lies between the blocks."""
    out, i, j = [], 0, 0
    for x, y, size in [*matching_blocks(a, b), (len(a), len(b), 0)]:
        if x > i or y > j:
            out.append(("delete" if y == j else "insert" if x == i else "replace", i, x, j, y))
        i, j = x + size, y + size
    return out
