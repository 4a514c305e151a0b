"""Geometric near-neighbour access trees over integer vectors: exact nearest entries for batches of queries.

A node picks ``FANOUT`` split points far from each other; every other member goes to the subtree of its nearest split point.
For each split point and subtree the node stores the range of their distances, the lower end rounded down and the
upper end rounded up.  A query's distances to the split points then rule out subtrees: by the triangle inequality one whose range lies
strictly beyond (distance to the split point) +- (best distance so far) holds nothing as near.  Distances are rounded so that
this never rules out too much, and winners are compared by exact integer squares, ties by the smaller index.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

FANOUT = 8
LEAF = 12
EXACT = 1 << 52  # sums of products below this are whole numbers in doubles too


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``a`` to every row of ``b``."""
    largest = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * a.shape[1] * largest**2 < EXACT:  # a product of matrices rounds nothing here
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :]).astype(np.int64)
    away = a[:, None, :] - b[None, :, :]
    return (away * away).sum(2)


def root_down(n: np.ndarray) -> np.ndarray:
    """Whole part of the square root."""
    root = np.sqrt(n.astype(np.float64)).astype(np.int64)
    root -= root * root > n
    return root + ((root + 1) * (root + 1) <= n)


def root_up(n: np.ndarray) -> np.ndarray:
    root = root_down(n)
    return root + (root * root < n)


@dataclass
class Node:
    splits: np.ndarray  # entry numbers; in a leaf all its entries
    low: np.ndarray = field(default_factory=lambda: np.empty((0, 0), np.int64))  # of split i to subtree j
    high: np.ndarray = field(default_factory=lambda: np.empty((0, 0), np.int64))
    children: list[Node | None] = field(default_factory=list)


def _split_points(entries: np.ndarray, members: np.ndarray) -> np.ndarray:
    """``FANOUT`` members, each the farthest from those before; the smaller number on a tie."""
    chosen = [0]
    away = squared(entries[members[:1]], entries[members])[0]
    away[0] = -1
    while len(chosen) < FANOUT:
        at = int(away.argmax())
        chosen.append(at)
        away = np.minimum(away, squared(entries[members[at : at + 1]], entries[members])[0])
        away[chosen] = -1
    return members[np.sort(chosen)]


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node:
    """The tree of the entries (rows of whole numbers); equal entries are allowed."""
    members = np.arange(len(entries)) if members is None else members
    if len(members) <= LEAF:
        return Node(members)
    splits = _split_points(entries, members)
    rest = members[~np.isin(members, splits)]
    away = squared(entries[splits], entries[rest])
    owner = away.argmin(0)
    between = squared(entries[splits], entries[splits])
    low, high, children = between.copy(), between.copy(), []
    for j in range(len(splits)):
        mine = owner == j
        children.append(build(entries, rest[mine]) if mine.any() else None)
        if mine.any():  # the range takes in the split point itself
            low[:, j] = np.minimum(low[:, j], away[:, mine].min(1))
            high[:, j] = np.maximum(high[:, j], away[:, mine].max(1))
    return Node(splits, root_down(low), root_up(high), children)


def _better(best: np.ndarray, which: np.ndarray, rows: np.ndarray, square: np.ndarray, numbers: np.ndarray) -> None:
    """Take over, for ``rows``, the nearest of the entries ``numbers``; equally near ones by the smaller number."""
    order = np.argsort(numbers)
    at = square[:, order].argmin(1)
    found, number = square[np.arange(len(rows)), order[at]], numbers[order][at]
    wins = (found < best[rows]) | ((found == best[rows]) & (number < which[rows]))
    best[rows[wins]], which[rows[wins]] = found[wins], number[wins]


def nearest(tree: Node, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each query the nearest entry, its squared distance, and how many distances were taken in all."""
    best = np.full(len(queries), np.iinfo(np.int64).max)
    which = np.full(len(queries), len(entries))
    taken = 0

    def visit(node: Node, rows: np.ndarray) -> None:
        nonlocal taken
        square = squared(queries[rows], entries[node.splits])
        taken += square.size
        _better(best, which, rows, square, node.splits)
        if not any(child is not None for child in node.children):
            return
        down, up = root_down(square), root_up(square)
        own = square.argmin(1)
        for turn in (True, False):  # the subtree of the nearest split point first: it brings the best distance down
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                some = np.flatnonzero((own == j) == turn)
                reach = root_up(best[rows[some]])[:, None]
                out = (down[some] - reach > node.high[None, :, j]) | (up[some] + reach < node.low[None, :, j])
                some = some[~out.any(1)]
                if len(some):
                    visit(child, rows[some])

    if len(queries) and len(entries):
        visit(tree, np.arange(len(queries)))
    return which, best, taken
