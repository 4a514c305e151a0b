"""Incremental counts and pattern queries."""

import re

import pytest
from pyspark.sql import functions as F

from blotterlake.operators import network
from blotterlake.operators.incremental import refresh_counts
from blotterlake.session import scratch_path
from blotterlake.sources import versions


def rows(spark, first, last):
    return spark.range(first, last).selectExpr("id", "id % 4 AS k", "cast(case when id % 10 < 9 then 2000 + id div 100 end as int) AS arrest_year")


def count(df):
    return df.groupBy("arrest_year", "k").agg(F.count("id").alias("n"))


def test_only_new_partitions_are_read(spark):
    source, store = scratch_path(spark, "source"), scratch_path(spark, "store")
    read = []

    def watched(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[\(*coalesce\(cast\(arrest_year", plan)  # other partitions' files are not opened
        read.append({r.arrest_year for r in df.select("arrest_year").distinct().collect()})
        return count(df)

    refresh = lambda: sorted(map(str, refresh_counts(spark, source, store, watched).select("arrest_year", "k", "n").collect()))
    whole = lambda: sorted(map(str, count(spark.read.parquet(source)).collect()))
    rows(spark, 0, 300).write.partitionBy("arrest_year").parquet(source)
    assert refresh() == whole() and read[-1] == {2000, 2001, 2002, None}
    before = len(versions.published(spark, store))
    assert refresh() == whole() and len(read) == 1 and len(versions.published(spark, store)) == before  # nothing new, nothing read
    rows(spark, 300, 400).where("arrest_year is not null").write.partitionBy("arrest_year").mode("append").parquet(source)
    assert refresh() == whole() and read[-1] == {2003}
    rows(spark, 100, 110).where("arrest_year is not null").write.partitionBy("arrest_year").mode("append").parquet(source)
    assert refresh() == whole() and read[-1] == {2001}  # a partition that has changed is counted anew
    versions.remove(spark, f"{source}/arrest_year=2000")
    spark.catalog.clearCache()
    assert refresh() == whole() and "2000" not in str(refresh())


FACTS = {
    "isA": [("u1", "unit"), ("u2", "unit"), ("b1", "beat"), ("b2", "beat"), ("b3", "beat"), ("x", "x")],
    "assignedTo": [("b1", "u1"), ("b2", "u1"), ("b3", "u2"), ("b3", "u1"), ("lost", "u2"), ("x", "x")],
}


def plain(patterns):
    """Bindings by trying every fact for every pattern."""
    found = [{}]
    for relation, *terms in patterns:
        grown = []
        for known in found:
            for fact in FACTS[relation]:
                new = dict(known)
                if all((new.setdefault(t, v) if t.startswith("?") else t) == v for t, v in zip(terms, fact)):
                    grown.append(new)
        found = grown
    return {tuple(sorted(b.items())) for b in found}


@pytest.mark.parametrize(
    "patterns",
    [
        [("isA", "?X", "unit")],
        [("isA", "?X", "unit"), ("assignedTo", "?B", "?X")],
        [("assignedTo", "?A", "?U"), ("assignedTo", "?B", "?U"), ("isA", "?A", "beat"), ("isA", "?U", "unit")],
        [("assignedTo", "?A", "?U"), ("isA", "?V", "unit"), ("assignedTo", "?A", "?V")],
        [("assignedTo", "?X", "?X"), ("isA", "?X", "?T")],
        [("assignedTo", "?A", "?B"), ("isA", "?B", "?T"), ("isA", "?A", "?T")],  # a cycle
        [("isA", "?X", "nothing"), ("assignedTo", "?B", "?X")],
    ],
)
def test_patterns(spark, patterns):
    facts = {name: spark.createDataFrame(found, "a string, b string") for name, found in FACTS.items()}
    result = network.match_patterns(facts, patterns)
    names = result.columns
    found = [tuple(sorted((f"?{c}", r[c]) for c in names)) for r in result.collect()]
    assert set(found) == plain(patterns) and len(found) == len(set(found))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_patterns_that_do_not_connect(spark):
    facts = {name: spark.createDataFrame(found, "a string, b string") for name, found in FACTS.items()}
    with pytest.raises(ValueError, match="not connected"):
        network.match_patterns(facts, [("isA", "?X", "unit"), ("isA", "?Y", "beat")])
    with pytest.raises(ValueError, match="unknown relation"):
        network.match_patterns(facts, [("likes", "?X", "?Y")])
