"""Exact joins inside regions of the Jaccard space: pivots, Voronoi cells, triangle-inequality windows, recursion.

Everything here works on the members of one region that a task holds. ``jaccard_join`` cuts the documents into regions
and, where a region is larger than a task should hold, applies one round of the same cells and windows through Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Pivots that a region elects in each round.
PIVOTS = 8
#: Rounds may nest so deep; a bit of a mask stands for each.
_DEPTH = 63
#: Distances are quotients of integers; this covers their rounding.
SLACK = 1e-9
#: A split must leave no more than so many members for each one that it splits.
_GAIN = 1.25


class Rows:
    """Lists of numbers (shingles of documents) as one flat array; numbers that only one list holds are left out."""

    def __init__(self, lists: Sequence[np.ndarray]):
        self.size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.concatenate(lists) if len(lists) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(lists)), self.size)
        values, number, many = np.unique(flat, return_inverse=True, return_counts=True)
        again = many > 1
        keep = again[number]
        self.numbers = int(again.sum())
        self.flat = (np.cumsum(again) - 1)[number[keep]]
        self.start = np.searchsorted(row[keep], np.arange(len(lists) + 1))

    def some(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of some rows: flat, and where each begins."""
        many = self.start[index + 1] - self.start[index]
        start = np.concatenate(([0], np.cumsum(many)))
        return self.flat[np.repeat(self.start[index] - start[:-1], many) + np.arange(start[-1])], start

    def common(self, some: tuple[np.ndarray, np.ndarray], row: int) -> np.ndarray:
        """How many numbers each of some() shares with a row."""
        flat, start = some
        has = np.zeros(self.numbers, bool)
        has[self.flat[self.start[row] : self.start[row + 1]]] = True
        before = np.concatenate(([0], np.cumsum(has[flat])))
        return before[start[1:]] - before[start[:-1]]


class Members:
    """The members of a region, what of them is linked, and how many documents each one links to.

    ``blockers`` are tokens: a pair that shares one is decided elsewhere and counts nothing here, but still connects.
    """

    def __init__(self, sets: Sequence[np.ndarray], copies: np.ndarray, blockers: Sequence[np.ndarray], num: int, den: int):
        self.num, self.den, self.eps = num, den, (den - num) / den
        self.rows, self.copies = Rows(sets), copies
        self.blocked = Rows(blockers) if any(map(len, blockers)) else None
        n = len(sets)
        self.degree, self.top = np.zeros(n, np.int64), np.arange(n)
        self.rounds = 0

    def measure(self, pivots: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact distances of ``index`` to the pivots, one row for each pivot, and which of these are links."""
        some = self.rows.some(index)
        size = self.rows.size
        same = np.stack([self.rows.common(some, p) for p in pivots])
        # a shingle that no other member has counts in the sizes alone
        same[pivots[:, None] == index[None, :]] = 0
        union = size[pivots][:, None] + size[index][None, :] - same
        return 1 - same / np.maximum(union, 1), (same > 0) & (self.den * same >= self.num * union)

    def count(self, pivots: np.ndarray, index: np.ndarray, linked: np.ndarray, owned: np.ndarray) -> None:
        """Note links between pivots and members: they connect, and those that are owned are counted on both sides."""
        some = self.blocked.some(index) if self.blocked else None
        for p, near, own in zip(pivots, linked, owned, strict=True):
            found = index[near]
            if not len(found):
                continue
            tops = np.unique(self.top[np.append(found, p)])
            self.top[np.isin(self.top, tops)] = tops[0]
            mine = near & own
            if some is not None:
                mine &= self.blocked.common(some, p) == 0
            self.degree[p] += self.copies[index[mine]].sum()
            self.degree[index[mine]] += self.copies[p]

    def decide_all(self) -> None:
        """Decide every pair of members, each in one cell of one round."""
        stack = [(np.arange(len(self.copies)), np.zeros(len(self.copies), np.uint64), 0)]
        while stack:
            index, bits, depth = stack.pop()
            if len(index) < 2 or np.bitwise_and.reduce(bits):
                continue  # all pairs that are left are of two guests
            self.rounds += 1
            at = np.unique(np.linspace(0, len(index) - 1, min(PIVOTS, len(index))).astype(np.int64))
            d, linked = self.measure(index[at], index)
            owned = (bits[at][:, None] & bits[None, :]) == 0
            owned &= np.arange(len(index))[None, :] != at[:, None]
            # two pivots meet twice
            order = np.full(len(index), len(at))
            order[at] = np.arange(len(at))
            owned &= order[None, :] > np.arange(len(at))[:, None]
            self.count(index[at], index, linked, owned)
            rest = np.ones(len(index), bool)
            rest[at] = False
            if not rest.any():
                continue
            index, bits, d = index[rest], bits[rest], d[:, rest]
            cell, home, member = cells(d, self.eps)
            if depth < _DEPTH and len(cell) <= _GAIN * len(index) and len(np.unique(cell)) > 1:
                guest = (np.uint64(1) << np.uint64(depth)) * (~home).astype(np.uint64)
                order = np.argsort(cell, kind="stable")
                cut = np.flatnonzero(np.diff(cell[order])) + 1
                stack += [(index[member[o]], bits[member[o]] | guest[o], depth + 1) for o in np.split(order, cut)]
            else:
                stack.append((index, bits, depth))


def cells(d: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, home, member): the Voronoi cells of members with distances ``d`` to the pivots, and their windows.

    Each member is at home in the cell of its nearest pivot. A partner within eps that is at home in another cell q has
    d(x, q) <= d(x, nearest) + 2 * eps by the triangle inequality, so with this window both may look for each other;
    one of the two is enough, and it is the member at home in the later cell that visits the earlier one. So every pair
    within eps meets in one cell, and two guests of a cell have no business with each other there.
    """
    home = d.argmin(axis=0)
    member = np.arange(d.shape[1])
    near = d[home, member]
    visit, who = np.nonzero((d <= near + 2 * eps + SLACK) & (np.arange(len(d))[:, None] < home[None, :]))
    return np.concatenate((home, visit)), np.concatenate((np.ones(len(member), bool), np.zeros(len(who), bool))), np.concatenate((member, who))
