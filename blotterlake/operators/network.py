"""Units and beats as a typed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blotterlake.operators.schema import fill_keys


def assignments(df: DataFrame) -> DataFrame:
    """Distinct (unit, beat) pairs, missing keys filled: all the graph needs of the table."""
    return fill_keys(df.select("unit", "beat")).distinct()


def network_edges(df: DataFrame) -> DataFrame:
    """``assignedTo(beat, unit)`` edges."""
    return assignments(df).select(
        F.col("beat").alias("src"), F.col("unit").alias("dst"), F.lit("assignedTo").alias("rel")
    )


def network_vertices(df: DataFrame) -> DataFrame:
    """Every unit and every beat, typed."""
    pairs = assignments(df)
    units = pairs.select(F.col("unit").alias("id"), F.lit("unit").alias("type"))
    beats = pairs.select(F.col("beat").alias("id"), F.lit("beat").alias("type"))
    return units.unionByName(beats).distinct()


def beats_per_unit(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("unit")).agg(F.count("src").alias("n_beats"))


# ---- patterns -----------------------------------------------------------------------------

Pattern = tuple[str, str, str]  # relation, subject, object; a name with ``?`` is a variable


def relations(df: DataFrame) -> dict[str, DataFrame]:
    """``isA(vertex, type)`` and ``assignedTo(beat, unit)`` as tables of two columns."""
    return {"isA": network_vertices(df).select("id", "type"), "assignedTo": network_edges(df).select("src", "dst")}


def _bindings(facts: dict[str, DataFrame], pattern: Pattern) -> DataFrame:
    """The values of a pattern's variables, each combination once."""
    relation, *terms = pattern
    if relation not in facts:
        raise ValueError(f"unknown relation {relation!r}; there are {sorted(facts)}")
    rows = facts[relation].toDF("__a", "__b")
    for name, term in zip(("__a", "__b"), terms):
        if not term.startswith("?"):
            rows = rows.where(F.col(name) == term)
    if terms[0] == terms[1]:
        rows = rows.where(F.col("__a") == F.col("__b"))
    variables = {term[1:]: name for term, name in zip(terms, ("__a", "__b")) if term.startswith("?")}
    if not variables:
        raise ValueError(f"a pattern without a variable: {pattern}")
    return rows.select(*[F.col(name).alias(v) for v, name in variables.items()]).distinct()


def match_patterns(facts: dict[str, DataFrame], patterns: list[Pattern]) -> DataFrame:
    """All bindings of the variables for which every pattern is a fact; one column for each variable.

    Patterns are joined by the variables they share, which must connect them all: nothing is joined without a key.  Before
    that, each table is reduced by semi-joins along the tree of patterns, first towards its root and then back, so
    that of tables whose patterns form a tree only rows that are in some result are joined.
    """
    tables = [_bindings(facts, p) for p in patterns]
    shared = lambda i, j: [v for v in tables[i].columns if v in tables[j].columns]
    order, parent = [0], {}
    while len(order) < len(tables):
        step = next(((i, j) for i in range(len(tables)) if i not in order for j in order if shared(i, j)), None)
        if step is None:
            raise ValueError("patterns are not connected by variables")
        order.append(step[0])
        parent[step[0]] = step[1]
    for i in reversed(order[1:]):
        tables[parent[i]] = tables[parent[i]].join(tables[i], shared(i, parent[i]), "left_semi")
    for i in order[1:]:
        tables[i] = tables[i].join(tables[parent[i]], shared(i, parent[i]), "left_semi")
    result = tables[order[0]]
    for i in order[1:]:
        result = result.join(tables[i], [v for v in tables[i].columns if v in result.columns])
    return result
