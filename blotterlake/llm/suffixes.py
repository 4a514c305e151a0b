"""Enhanced suffix arrays of short strings: sorting, common prefixes, and their interval tree."""

from __future__ import annotations

import numpy as np


def suffix_array(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of the suffixes text[start:end]; equal ones keep their order."""
    suffixes = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    return np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__), np.int64)


def common_prefixes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it; 0 for the first."""
    out = np.zeros(len(starts), np.int64)
    if len(starts) < 2:
        return out
    padded = np.concatenate((flat, np.zeros(8, np.uint8)))
    words = np.ndarray(len(flat) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    a, b = starts[:-1], starts[1:]
    most = np.minimum(ends[:-1] - a, ends[1:] - b)
    depth = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        at = depth[live]
        differ = words[a[live] + at] ^ words[b[live] + at]
        # Bytes before the first that differs: the trailing zero bits, by eight.
        equal = np.bitwise_count((differ & -differ) - np.uint64(1)).astype(np.int64) >> 3
        depth[live] = np.minimum(at + equal, most[live])
        live = live[(equal == 8) & (depth[live] < most[live])]
    out[1:] = depth
    return out


def intervals(prefix: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(depth, first, last) of all nodes of depth ``least`` or more, children before parents.

    A scan with a stack over the common prefixes: an interval opens where they rise and closes where
    they fall below its depth, so it holds every suffix that starts with the repeated string.
    """
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate(prefix.tolist() + [0]):
        first = i - 1
        while stack and stack[-1][0] > depth:
            above, first = stack.pop()
            out.append((above, first, i - 1))
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return out


def maximal_repeats(
    flat: np.ndarray, starts: np.ndarray, string_starts: np.ndarray, prefix: np.ndarray, least: int, most: int
) -> list[tuple[int, int, int]]:
    """The intervals whose occurrences differ in the byte to their left.

    Suffixes are given in suffix-array order, none longer than ``most``.  A string's beginning has no byte
    to its left and counts as different from all.  What is left out extends to the left in all its
    occurrences; a repeat of ``most`` bytes, which may go on beyond them, is never left out.
    """
    left = np.where(starts > string_starts, flat[np.maximum(starts - 1, 0)].astype(np.int64), -1)
    # changes[i]: how often the left byte changed up to suffix i; a beginning changes on both sides.
    differs = np.concatenate(([0], np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0) | (left[:-1] < 0))))
    return [(d, a, b) for d, a, b in intervals(prefix, least) if d >= most or differs[b] > differs[a]]
