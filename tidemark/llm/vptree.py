"""Vantage-point trees over 64-bit fingerprints, under the Hamming distance of all or some bits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Points in a leaf, and distances that a leaf works out at once.
LEAF, CHUNK = 48, 1 << 20


def distance(points: np.ndarray, point: np.uint64, mask: np.uint64 = ALL) -> np.ndarray:
    return np.bitwise_count((points ^ point) & mask).astype(np.int16)


def connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links (a, b) connect it to."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        if not len(a):
            break
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


@dataclass
class _Node:
    low: int
    high: int
    vantage: np.uint64 = np.uint64(0)
    mask: np.uint64 = ALL
    reach: int = 0
    bound: int = -1
    near: _Node | None = None
    far: _Node | None = None
    label: int = -1


class VantageTree:
    """Distinct points, split again and again at the median distance to one of them.

    Distances count the bits of ``mask``, within which a sought pair differs by at most ``reach``; points
    that agree in all of these go on to be split by all bits, with ``most``. Each split links what lies
    within ``most`` of its vantage point, so a dense group is soon known to be one component: a
    branch that is one component is passed over by queries of that component, and left by any other
    at its first link. So links come as a set that connects the same points as all of them.
    """

    def __init__(self, points: np.ndarray, most: int, mask: np.uint64 = ALL, reach: int | None = None):
        self.points, self.most = points, most
        self.order = np.arange(len(points))
        self._links: list[tuple[np.ndarray, np.ndarray]] = []
        self.root = self._split(0, len(points), np.uint64(mask), most if reach is None else reach)
        a, b = (np.concatenate(x) for x in zip(*self._links, strict=True)) if self._links else (np.empty(0, np.int64),) * 2
        self.label = connected(len(points), a, b)
        self._mark(self.root)

    def _split(self, low: int, high: int, mask: np.uint64, reach: int) -> _Node:
        node = _Node(low, high, mask=mask, reach=reach)
        if high - low <= LEAF:
            return node
        own = self.order[low:high]
        for at in ((high - low) // 2, 0, high - low - 1):
            vantage = self.points[own[at]]
            away = distance(self.points[own], vantage, mask)
            bound = int(np.median(away))
            if (away <= bound).all():
                bound = int(away.max()) - 1
            if (away <= bound).any():
                break
        else:
            if mask == ALL:
                return node
            return self._split(low, high, ALL, self.most)
        linked = own[distance(self.points[own], vantage) <= self.most]
        self._links.append((np.full(len(linked), own[at]), linked))
        near = away <= bound
        middle = low + int(near.sum())
        self.order[low:high] = np.concatenate((own[near], own[~near]))
        node.vantage, node.bound = vantage, bound
        node.near, node.far = self._split(low, middle, mask, reach), self._split(middle, high, mask, reach)
        return node

    def _mark(self, node: _Node) -> int:
        if node.near is None:
            labels = self.label[self.order[node.low : node.high]]
            node.label = int(labels[0]) if len(labels) and (labels == labels[0]).all() else -1
        else:
            a, b = self._mark(node.near), self._mark(node.far)
            node.label = a if a == b else -1
        return node.label

    def links(self, queries: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) within ``most`` bits, enough to connect what all such pairs connect.

        ``labels``: the component of a query among the points, or -1 where it is none of them.
        """
        self._out: list[tuple[np.ndarray, np.ndarray]] = []
        self._visit(self.root, queries, labels, np.arange(len(queries)))
        if not self._out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = zip(*self._out, strict=True)
        return np.concatenate(a), np.concatenate(b)

    def own_links(self) -> tuple[np.ndarray, np.ndarray]:
        """The links found while splitting."""
        if not self._links:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = zip(*self._links, strict=True)
        return np.concatenate(a), np.concatenate(b)

    def _visit(self, node: _Node, queries: np.ndarray, labels: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Searches a branch for the queries ``who``; returns which of these it linked."""
        linked = np.zeros(len(who), bool)
        if node.label >= 0:
            asking = np.flatnonzero(labels[who] != node.label)
        else:
            asking = np.arange(len(who))
        if not len(asking) or node.low == node.high:
            return linked
        if node.near is None:
            points = self.points[self.order[node.low : node.high]]
            step = max(1, CHUNK // len(points))
            for start in range(0, len(asking), step):
                part = asking[start : start + step]
                close = np.bitwise_count(queries[who[part], None] ^ points[None, :]) <= self.most
                hit = close.any(axis=1)
                if not hit.any():
                    continue
                linked[part[hit]] = True
                if node.label >= 0:
                    a, b = np.flatnonzero(hit), close[hit].argmax(axis=1)
                else:
                    a, b = np.nonzero(close)
                self._out.append((who[part[a]], self.order[node.low + b]))
            return linked
        away = distance(queries[who[asking]], node.vantage, node.mask)
        inner, outer = away - node.reach <= node.bound, away + node.reach > node.bound
        first = self._visit(node.near, queries, labels, who[asking[inner]])
        linked[asking[inner]] |= first
        if node.label >= 0:
            outer &= ~linked[asking]
        second = self._visit(node.far, queries, labels, who[asking[outer]])
        linked[asking[outer]] |= second
        return linked


def spanning_links(home: np.ndarray, visitors: np.ndarray, most: int, mask: np.uint64 = ALL, reach: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (smaller index's point, other point) that connect home points and visitors as all pairs of
    a home point with any other within ``most`` bits do, where pairs that differ by more than ``reach``
    bits of ``mask`` may be left to another call. At most one link for each point."""
    tree = VantageTree(home, most, mask, reach)
    everyone = np.concatenate((home, visitors))
    labels = np.concatenate((tree.label, np.full(len(visitors), -1)))
    a, b = tree.links(everyone, labels)
    x, y = tree.own_links()
    group = connected(len(everyone), np.concatenate((a, x)), np.concatenate((b, y)))
    member = np.flatnonzero(group != np.arange(len(group)))
    return everyone[group[member]], everyone[member]
