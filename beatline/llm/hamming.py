"""Gray-order hierarchical index over 64-bit fingerprints, inside one task."""

from __future__ import annotations

import numpy as np

#: Children of an upper node, and pairs of nodes or fingerprints compared at once.
FAN, STEP = 16, 1 << 20


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the reflected Gray order."""
    x = x.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node number linked to each of ``n`` nodes by edges (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (before == label).all():
            break
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


class GrayIndex:
    """Upper nodes over FAN neighbours in Gray order, level by level up to one root.

    A node keeps the bits all its fingerprints share (mask and pattern). The
    differing shared bits of two nodes are a lower bound for every pair below
    them, and grow from level to level as masks widen.
    """

    def __init__(self, prints: np.ndarray):
        """``prints``: distinct fingerprints in Gray order."""
        self.prints = prints.astype(np.uint64)
        full = np.full(len(prints), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.levels = [(self.prints, full)]
        while len(self.levels[-1][0]) > 1:
            pattern, mask = self.levels[-1]
            first = np.arange(0, len(pattern), FAN)
            lead = np.repeat(pattern[first], np.diff(np.append(first, len(pattern))))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ lead), first)
            self.levels.append((pattern[first] & shared, shared))

    def linked(self, most: int) -> np.ndarray:
        """Component of each fingerprint under links of at most ``most`` differing bits.

        Finds a spanning set of the links: pairs of nodes that lie in one
        component already are not opened, so a dense group costs little more
        than its sorted neighbours.
        """
        n = len(self.prints)
        near = np.bitwise_count(self.prints[1:] ^ self.prints[:-1]) <= most
        at = np.flatnonzero(near)
        self.label = components(n, at, at + 1)
        self._bounds()
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > STEP:
                half = len(a) // 2
                stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
                continue
            a, b = self._open(level, a, b, most)
            if not len(a):
                continue
            if level == 0:
                self._join(a, b)
                continue
            size = len(self.levels[level - 1][0])
            for part in range(0, len(a), max(1, STEP // (FAN * FAN))):
                pa, pb = a[part : part + STEP // (FAN * FAN)], b[part : part + STEP // (FAN * FAN)]
                grid = np.arange(FAN)
                ca = (pa[:, None, None] * FAN + grid[None, :, None] + 0 * grid[None, None, :]).ravel()
                cb = (pb[:, None, None] * FAN + grid[None, None, :] + 0 * grid[None, :, None]).ravel()
                real = (ca < size) & (cb < size) & ((ca < cb) if level == 1 else (ca <= cb))
                stack.append((level - 1, ca[real], cb[real]))
        return self.label

    def _open(self, level: int, a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        pattern, mask = self.levels[level]
        shared = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= most
        a, b = a[shared], b[shared]
        low, high = self.low[level], self.high[level]
        one = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        return a[~one], b[~one]

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        pairs = np.unique(np.stack([self.label[a], self.label[b]]), axis=1)
        self.label = components(len(self.label), pairs[0], pairs[1])[self.label]
        self._bounds()

    def _bounds(self) -> None:
        """Smallest and largest component below each node."""
        self.low, self.high = [self.label], [self.label]
        for _ in self.levels[1:]:
            first = np.arange(0, len(self.low[-1]), FAN)
            self.low.append(np.minimum.reduceat(self.low[-1], first))
            self.high.append(np.maximum.reduceat(self.high[-1], first))


def small_groups(prints: np.ndarray, group: np.ndarray, most: int, longest: int) -> np.ndarray:
    """Components inside many adjacent groups of at most ``longest`` fingerprints."""
    left, right = [], []
    for step in range(1, longest):
        near = (group[step:] == group[:-step]) & (np.bitwise_count(prints[step:] ^ prints[:-step]) <= most)
        at = np.flatnonzero(near)
        left.append(at)
        right.append(at + step)
    if not left:
        return np.arange(len(prints))
    return components(len(prints), np.concatenate(left), np.concatenate(right))
