"""Shapes of the physical plans: what is read, shuffled and joined how."""

import pytest
from pyspark.sql import functions as F

from blotterlake.catalog import fixture
from blotterlake.config import Settings
from blotterlake.operators import hourly, lookups
from blotterlake.operators.fuzzy import fuzzy_match
from blotterlake.plans.prepare import prepare
from blotterlake.session import materialize

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Prepared table with a police flag, as it lies on disk."""
    df = prepare(fixture.incidents(spark, SF), fixture.unit_beats(spark, SF))
    return materialize(df.withColumn(Settings().police(1), F.col("arrest_id") % 2 == 0), "plans")


def test_prepare_does_not_shuffle_the_fact_table(spark, stored):
    raw = materialize(fixture.incidents(spark, SF), "raw")
    text = plan(prepare(raw, fixture.unit_beats(spark, SF)))
    assert text.count("hashpartitioning") == 1  # the lookup's own grouping
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_hourly_counts_read_only_their_columns(stored):
    text = plan(hourly.hourly_counts(hourly.lead_charge(stored)))
    read = text[text.index("ReadSchema") :]
    for unused in ("beat", "unit", "charge_2_class", "charge_1_description:"):
        assert unused not in read
    assert text.count("hashpartitioning") == 1 and "partial_count" in text


def test_stored_year_partitions_are_pruned(spark, stored, tmp_path):
    path = str(tmp_path / "by_year")
    stored.write.partitionBy("arrest_year").parquet(path)
    text = plan(hourly.filter_year(spark.read.parquet(path), 2024))
    assert "PartitionFilters: [isnotnull(arrest_year" in text


def test_small_results_attach_without_shuffle(spark, stored):
    resolved = materialize(
        spark.createDataFrame(
            [("x", "m", "n", True, 1, 0, 0, 0)],
            "description string, micro string, macro string, police boolean, "
            "n_slot_1 int, n_slot_2 int, n_slot_3 int, n_slot_4 int",
        ),
        "resolved",
    )
    bare = stored.drop(Settings().police(1))
    assert "hashpartitioning" not in plan(lookups.attach_resolved(bare, resolved))
    large = plan(lookups.attach_resolved(bare, resolved, Settings(broadcast_bytes=0)))
    assert "CartesianProduct" not in large and "NestedLoop" not in large


def test_fuzzy_join_is_an_equi_join(spark):
    one = spark.createDataFrame([("retail theft",)], "v string")
    text = plan(fuzzy_match(one, one))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.split("+- == Initial Plan ==")[0].count("ArrowEvalPython") == 1
