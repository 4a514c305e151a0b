"""Edit distances between two text columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import IntegerType


def _osa(a: str, b: str) -> int:
    """Optimal string alignment distance: Levenshtein with adjacent swaps at cost 1."""
    before, above = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, above = above, row
    return above[-1]


@F.pandas_udf(IntegerType())
def _osa_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    """Exact distance where both sides are given; a pair met twice is computed once."""
    seen: dict[tuple[str, str], int] = {}
    out = []
    for pair in zip(left, right):
        if pair[0] is None or pair[1] is None:
            out.append(None)
            continue
        if pair not in seen:
            seen[pair] = _osa(*pair)
        out.append(seen[pair])
    return pd.Series(out, dtype="Int32")


# Spark evaluates a deterministic UDF again for each filter on its result.
_osa_once = _osa_udf.asNondeterministic()


def _pairs_of_letters(text: Column, swapped: bool) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1)))
    if swapped:
        return F.transform(at, lambda i: F.concat(F.substr(text, i + 1, F.lit(1)), F.substr(text, i, F.lit(1))))
    return F.transform(at, lambda i: F.substr(text, i, F.lit(2)))


def possible_swaps(left: Column, right: Column) -> Column:
    """Upper bound on the adjacent swaps that can turn ``left`` into ``right``."""
    reversed_pairs = _pairs_of_letters(right, swapped=True)
    mine = _pairs_of_letters(left, swapped=False)
    differ = lambda p: F.substr(p, F.lit(1), F.lit(1)) != F.substr(p, F.lit(2), F.lit(1))
    return F.size(F.filter(mine, lambda p: differ(p) & F.array_contains(reversed_pairs, p)))


def osa_distance(left: Column, right: Column, levenshtein: Column, swaps: Column) -> Column:
    """Distance with swaps, given the Levenshtein distance and the bound on swaps.

    Without a possible swap, or below distance 2, it equals Levenshtein and Python is skipped.
    """
    needed = (swaps > 0) & (levenshtein > 1)
    exact = _osa_once(F.when(needed, left), F.when(needed, right))
    return F.when(needed, exact).otherwise(levenshtein)
