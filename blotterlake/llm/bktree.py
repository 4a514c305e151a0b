"""BK-trees over 64-bit fingerprints as flat arrays: children keyed by Hamming distance to the parent.

A forest holds one tree for each group of a shard.  It is built level by level and searched with a
frontier of (query, node) pairs, so the work is numpy's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPAN = 65  # distances of 64-bit values
FRONTIER = 1 << 20


@dataclass(frozen=True)
class Forest:
    values: np.ndarray  # uint64, distinct within a group
    root: np.ndarray  # the node at which each value's group starts
    edge_codes: np.ndarray  # sorted parent * SPAN + distance of all nodes with a parent
    edge_nodes: np.ndarray  # the child of each code


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def build(groups: np.ndarray, values: np.ndarray) -> Forest:
    """Trees of the values of each run of equal ``groups``; the first value of a run is the root."""
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if len(groups) else np.empty(0, np.int64)
    root = np.repeat(first, np.diff(np.append(first, len(groups))))
    waiting = np.flatnonzero(root != np.arange(len(values)))
    parent = root[waiting]
    codes, nodes = [], []
    while len(waiting):
        code = parent * SPAN + distance(values[waiting], values[parent])
        found, at, which = np.unique(code, return_index=True, return_inverse=True)
        codes.append(found)
        nodes.append(waiting[at])
        rest = np.ones(len(waiting), bool)
        rest[at] = False
        parent, waiting = waiting[at][which[rest]], waiting[rest]
    if not codes:
        empty = np.empty(0, np.int64)
        return Forest(values, root, empty, empty)
    all_codes, all_nodes = np.concatenate(codes), np.concatenate(nodes)
    order = np.argsort(all_codes)
    return Forest(values, root, all_codes[order], all_nodes[order])


def search(forest: Forest, queries: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query index, node) of all nodes within ``radius``, following only edges that can lead there."""
    found_q, found_n = [], []
    stack = [(np.arange(len(queries)), starts)]
    while stack:
        q, node = stack.pop()
        if len(q) > FRONTIER:
            half = len(q) // 2
            stack += [(q[:half], node[:half]), (q[half:], node[half:])]
            continue
        d = distance(queries[q], forest.values[node])
        near = d <= radius
        found_q.append(q[near])
        found_n.append(node[near])
        low = np.searchsorted(forest.edge_codes, node * SPAN + np.maximum(d - radius, 0), "left")
        high = np.searchsorted(forest.edge_codes, node * SPAN + np.minimum(d + radius, SPAN - 1), "right")
        count = high - low
        some = count > 0
        if some.any():
            low, count = low[some], count[some]
            at = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            stack.append((np.repeat(q[some], count), forest.edge_nodes[at]))
    join = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return join(found_q), join(found_n)


def least_linked(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For 0 .. size - 1 the least index that links (a, b) reach."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new
