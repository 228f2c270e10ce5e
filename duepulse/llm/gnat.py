"""A geometric near-neighbour access tree over the entries of one codebook, on integers.

A node holds split points; each other entry below it belongs to the child of its nearest split
point. For every split point and child the node stores the range of distances between them. A
query at distance d from split point i, with a best distance of r so far, can find nothing as near
in child j if [d - r, d + r] and that range are apart: by the triangle inequality every entry there
is further than r.

Distances are whole numbers: lower ends rounded down, upper ends, d and r rounded so that a subtree
goes only if its entries are truly further. So equal distances are never lost, and ties are settled
on exact squared distances, by the lower index.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Split points of a node, and the most entries of a node without children.
SPLITS = 12
LEAF = 16
#: Largest integer that a float and its products hold exactly.
_EXACT = 2**53


def floor_root(squares: np.ndarray) -> np.ndarray:
    """The whole part of the square roots, exact for squares below 2^62."""
    root = np.floor(np.sqrt(squares.astype(np.float64))).astype(np.int64)
    root -= root * root > squares
    root += (root + 1) * (root + 1) <= squares
    return root


def ceil_root(squares: np.ndarray) -> np.ndarray:
    """The square roots, rounded up."""
    root = floor_root(squares)
    return root + (root * root < squares)


def squared_distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances between integer vectors, rows by points."""
    width = max(1, rows.shape[1])
    most = 2 * int(max(np.abs(rows).max(initial=0), np.abs(points).max(initial=0)))
    if width * most * most < _EXACT:
        a, b = rows.astype(np.float64), points.astype(np.float64)
        squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
        return squares.astype(np.int64)
    out = np.empty((len(rows), len(points)), dtype=np.int64)
    for i, point in enumerate(points):
        apart = rows - point
        out[:, i] = (apart * apart).sum(axis=1)
    return out


@dataclass
class _Node:
    """Indexes of the split points; the children of each, and the ranges of distances to them."""

    splits: np.ndarray
    children: list[_Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Gnat:
    """The tree over the rows of ``entries`` (integers); rows may be equal."""

    def __init__(self, entries: np.ndarray, splits: int = SPLITS, leaf: int = LEAF) -> None:
        self.entries = entries
        self.splits, self.leaf = splits, max(leaf, splits)
        self.visits = 0  # distances computed by searches
        self.root = self._grown(np.arange(len(entries)))

    def _grown(self, members: np.ndarray) -> _Node | None:
        if not len(members):
            return None
        if len(members) <= self.leaf:
            return _Node(members)
        chosen = self._far_apart(members)
        splits, rest = members[chosen], np.delete(members, chosen)
        squares = squared_distances(self.entries[rest], self.entries[splits])
        home = squares.argmin(axis=1)
        shape = (len(splits), len(splits))
        node = _Node(splits, [], np.zeros(shape, dtype=np.int64), np.full(shape, -1, dtype=np.int64))
        for j in range(len(splits)):
            mine = home == j
            if mine.any():
                node.low[:, j] = floor_root(squares[mine].min(axis=0))
                node.high[:, j] = ceil_root(squares[mine].max(axis=0))
            node.children.append(self._grown(rest[mine]))
        return node

    def _far_apart(self, members: np.ndarray) -> np.ndarray:
        """Places of split points: the first member, then always the one furthest from those chosen."""
        points = self.entries[members]
        chosen = [0]
        nearest = squared_distances(points, points[:1])[:, 0]
        while len(chosen) < self.splits:
            nearest[chosen[-1]] = -1
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squared_distances(points, points[chosen[-1:]])[:, 0])
            nearest[chosen] = -1
        return np.array(sorted(chosen))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the index of its nearest entry, the lower of equally near, and its squared distance."""
        best = np.full(len(rows), len(self.entries), dtype=np.int64)
        squares = np.full(len(rows), np.iinfo(np.int64).max, dtype=np.int64)
        if len(rows) and self.root is not None:
            self._search(self.root, rows, np.arange(len(rows)), best, squares)
        return best, squares

    def _search(self, node: _Node, rows: np.ndarray, at: np.ndarray, best: np.ndarray, squares: np.ndarray) -> None:
        """Improves best and squares of the rows ``at`` by the entries of a node and below."""
        found = squared_distances(rows[at], self.entries[node.splits])
        self.visits += found.size
        home = found.argmin(axis=1)  # the first of equals, whose index is the lowest
        near, index = found.min(axis=1), node.splits[home]
        better = (near < squares[at]) | ((near == squares[at]) & (index < best[at]))
        squares[at[better]], best[at[better]] = near[better], index[better]
        if not node.children:
            return
        down, up = floor_root(found), ceil_root(found)
        # The own child first: what it finds lets other children go.
        for first in (True, False):
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                some = np.flatnonzero((home == j) == first)
                reach = ceil_root(squares[at[some]])[:, None]
                apart = (node.low[:, j] - up[some] > reach) | (down[some] - node.high[:, j] > reach)
                some = some[~apart.any(axis=1)]
                if len(some):
                    self._search(child, rows, at[some], best, squares)
