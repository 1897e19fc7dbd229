"""Points of group counts in an R-tree, searched by an upper bound of the overlap.

A set's tokens are hashed into groups; the counts by group are its point. Two
sets share at most the sum over groups of the smaller count, and a set shares at
most the same sum with the upper corner of a box with any set in the box. Boxes
also know the smallest and largest set in them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 16
#: Numbers compared at once.
STEP = 1 << 22


def counts_by_group(tokens: np.ndarray, groups: int) -> np.ndarray:
    """The point of a set of 64-bit tokens."""
    return np.bincount((tokens >> np.uint64(40)).astype(np.int64) % groups, minlength=groups)


def packed_point(counts: np.ndarray) -> bytes:
    """A point as bytes, one per group if all counts fit, else four."""
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else "<u4").tobytes()


def unpacked_points(packed: list[bytes], groups: int) -> np.ndarray:
    """The points in a row, as narrow as the largest allows."""
    if all(len(x) == groups for x in packed):
        return np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), groups)
    return np.array([np.frombuffer(x, np.uint8 if len(x) == groups else "<u4") for x in packed], np.uint32)


def enough(overlap: np.ndarray, m: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes ``m`` and ``n`` that share ``overlap`` are similar enough."""
    return 100 * overlap >= percent * (m + n - overlap)


class CountTree:
    """An R-tree over points, packed bottom-up from points sorted by size and then by their largest spread."""

    def __init__(self, points: np.ndarray, percent: int = 80):
        self.points = points
        self.sizes = points.sum(axis=1, dtype=np.int64)
        self.percent = percent
        self.order = self._packed(np.argsort(self.sizes, kind="stable"))
        high, small, large = self.points[self.order], self.sizes[self.order], self.sizes[self.order]
        #: upper corner, smallest and largest set per level, from the leaves to the root
        self.levels = []
        while len(high) > 1:
            cut = np.arange(0, len(high), FAN)
            high = np.maximum.reduceat(high, cut)
            small, large = np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut)
            self.levels.append((high, small, large))

    def _packed(self, order: np.ndarray) -> np.ndarray:
        """Leaves of alike points: slabs by size, inside a slab by the group that differs most."""
        if len(order) <= FAN:
            return order
        out = []
        for at in range(0, len(order), FAN * FAN):
            slab = order[at : at + FAN * FAN]
            own = self.points[slab]
            widest = np.argsort(-(own.max(axis=0) - own.min(axis=0)), kind="stable")[:3]
            out.append(slab[np.lexsort([own[:, g] for g in widest[::-1]])])
        return np.concatenate(out)

    def _overlap(self, queries: np.ndarray, q: np.ndarray, corners: np.ndarray, at: np.ndarray, sizes: np.ndarray, small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of a query and a box, which may hold a similar set; and the bound of those."""
        p = self.percent
        least = np.maximum(small, -(-p * sizes // 100))
        keep = np.flatnonzero((100 * large >= p * sizes) & (100 * sizes >= p * small))
        bound = np.zeros(len(keep), np.int64)
        step = max(1, STEP // max(1, queries.shape[1]))
        for a in range(0, len(keep), step):
            some = keep[a : a + step]
            bound[a : a + step] = np.minimum(queries[q[some]], corners[at[some]]).sum(axis=1, dtype=np.uint32)
        fits = enough(bound, sizes[keep], least[keep], p)
        return keep[fits], bound[fits]

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, point, bound) of all pairs that the bound leaves, in pieces."""
        sizes = queries.sum(axis=1, dtype=np.int64)
        for a in range(0, len(queries), 256):
            q = np.arange(a, min(a + 256, len(queries)))
            box = np.zeros(len(q), np.int64)
            for level in range(len(self.levels) - 1, -1, -1):
                high, small, large = self.levels[level]
                keep, _ = self._overlap(queries, q, high, box, sizes[q], small[box], large[box])
                q = np.repeat(q[keep], FAN)
                box = (box[keep][:, None] * FAN + np.arange(FAN)).ravel()
                there = box < (len(self.levels[level - 1][0]) if level else len(self.points))
                q, box = q[there], box[there]
            point = self.order[box]
            own = self.sizes[point]
            keep, bound = self._overlap(queries, q, self.points, point, sizes[q], own, own)
            yield q[keep], point[keep], bound
