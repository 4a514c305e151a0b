"""Counts, outliers, radar series, densities, network, sources."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotterlake.config import Settings
from blotterlake.operators import density, hourly, network
from blotterlake.operators.quality import accuracy
from blotterlake.plans.analyse import time_of_day_tables
from blotterlake.plans.prepare import prepare, run_prepare
from blotterlake.catalog import fixture
from blotterlake.session import scratch_path
from blotterlake.sources import tables

SF = "/root/testdata/sf0.001"
COLUMNS = (
    "arrest_id bigint, lead_charge_police_related boolean, lead_charge_code int, arrest_year int, "
    "arrest_month int, arrest_day int, arrest_hour int"
)


def test_null_keys_vanish_and_are_reported(spark):
    rows = [(1, True, 8, 2020, 1, 1, 5), (2, True, 8, 2020, 1, 1, 5), (3, None, 8, 2020, 1, 1, 6)]
    df = spark.createDataFrame(rows, COLUMNS)
    assert [r.arrest_id_count for r in hourly.hourly_counts(df).collect()] == [2]
    assert hourly.hourly_counts(df, drop_null_keys=False).count() == 2
    assert hourly.null_key_count(hourly.count_groups(df)).first().n_dropped == 1
    assert hourly.total_count(hourly.hourly_counts(df)).first().n_records == 2


def test_zero_variance_removes_the_type(spark):
    df = spark.createDataFrame([("x", 2), ("x", 2), ("y", 1), ("y", 3)], "t string, n bigint")
    scored = hourly.with_zscore(df, "n", by="t")
    assert {(r.t, r.n_zscore) for r in scored.collect()} == {("x", None), ("y", -1.0), ("y", 1.0)}
    assert hourly.remove_outliers(scored, 3.0, zscore_col="n_zscore").count() == 2
    assert hourly.remove_outliers(scored, None, zscore_col="n_zscore").count() == 4


def test_angles_use_observed_hours(spark):
    rows = [(i, True, 8, 2020, 1, 1, h) for i, h in enumerate([0, 1, 1, 5])]
    groups = hourly.store_groups(spark.createDataFrame(rows, COLUMNS))
    angles = {
        r.arrest_hour: r.arrest_time_angle
        for r in hourly.radar_series(groups).where("chart = 'All'").collect()
    }
    assert angles[5] is None and math.isclose(angles[1], 2 * math.pi / 3)  # three hours occur
    fixed = hourly.radar_series(groups, Settings(n_hours=24)).where("arrest_hour = 5").first()
    assert math.isclose(fixed.arrest_time_angle, 5 / 24 * 2 * math.pi)


def test_hours_sort_as_text(spark):
    df = spark.createDataFrame([(h,) for h in (2, 10, 0, 1)], "arrest_hour int")
    assert [r.arrest_hour for r in hourly.distinct_hours(df).collect()] == ["0", "1", "10", "2"]


def test_year_filter_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    rows = hourly.filter_year(orders, 1995, date_col="o_orderdate")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert hourly.filter_year(orders, None, date_col="o_orderdate") is orders


def counts(spark, times, unit="1", kind="Felony"):
    df = spark.createDataFrame(
        [(kind, True, unit, float(x)) for x in times],
        "lead_charge_code_type string, lead_charge_police_related boolean, unit string, x double",
    )
    return df.groupBy("lead_charge_code_type", "lead_charge_police_related", "unit", "x").agg(
        F.count(F.lit(1)).alias("n")
    )


TIMES = [0, 1, 1, 2.25, 2.25, 2.5, 7, 7.75, 12, 12, 12.25, 18, 22.5, 23]


def test_histogram_matches_numpy_auto(spark):
    rows = density.panels_by_flag(counts(spark, TIMES))
    bins = density.unit_histogram(rows, *density.BY_FLAG_AND_UNIT).orderBy("bin").collect()
    heights, edges = np.histogram(TIMES, bins="auto", density=True)
    assert np.allclose([b.density for b in bins], heights)
    assert np.allclose([b.bin_start for b in bins], edges[:-1])


def test_histogram_of_one_value_and_of_fixed_width(spark):
    one = density.panels_by_flag(counts(spark, [5, 5]))
    (only,) = density.unit_histogram(one, *density.BY_FLAG_AND_UNIT).collect()
    assert (only.bin_start, only.density) == (4.5, 1.0)
    fixed = density.unit_histogram(
        density.panels_by_flag(counts(spark, TIMES)), *density.BY_FLAG_AND_UNIT, bin_width=0.25
    )
    assert fixed.count() == 92 and math.isclose(fixed.agg(F.sum("density")).first()[0] * 0.25, 1.0)


def test_kde_matches_definition_and_needs_spread(spark):
    rows = density.panels_by_flag(counts(spark, TIMES).unionByName(counts(spark, [5, 5], unit="2")))
    curve = density.unit_kde(rows, *density.BY_FLAG_AND_UNIT).orderBy("point").collect()
    h = np.std(TIMES, ddof=1) * len(TIMES) ** -0.2
    grid = np.linspace(min(TIMES), max(TIMES), 200)
    want = np.exp(-(((grid[:, None] - np.array(TIMES)) / h) ** 2) / 2).sum(axis=1) / (
        len(TIMES) * h * math.sqrt(2 * math.pi)
    )
    assert {r.unit for r in curve} == {"1"}
    assert np.allclose([r.density for r in curve], want)


def test_common_norm_areas_add_up_to_one(spark):
    both = counts(spark, TIMES).unionByName(counts(spark, [3, 4, 4.5, 9], unit=None)).unionByName(
        counts(spark, [3, 4, 20], unit="2")
    )
    bins = density.unit_histogram(density.panels_by_unit(both), *density.BY_UNIT)
    assert {r.unit for r in bins.select("unit").distinct().collect()} == {"1", "2"}  # null left out
    assert math.isclose(bins.agg(F.sum(F.col("density") * F.col("bin_width"))).first()[0], 1.0)
    assert "000" in {r.unit for r in density.panels_by_flag(both).select("unit").distinct().collect()}


def test_network(spark):
    df = spark.createDataFrame([("001", "0111"), ("001", "0112"), (None, "0112"), ("001", None)], "unit string, beat string")
    edges = network.network_edges(df)
    assert {(r.src, r.dst) for r in edges.collect()} == {
        ("0111", "001"), ("0112", "001"), ("0112", "000"), ("0000", "001"),
    }
    assert network.network_vertices(df).count() == 5
    assert {r.unit: r.n_beats for r in network.beats_per_unit(edges).collect()} == {"001": 3, "000": 1}


def test_read_or_build(spark):
    path = scratch_path(spark, "rob")
    with pytest.raises(FileNotFoundError):
        tables.read_or_build(spark, path, lambda: None)
    nine = lambda: spark.range(9).toDF("x")
    assert tables.read_or_build(spark, path, lambda: spark.range(3).toDF("x")).count() == 3
    assert tables.read_or_build(spark, path, nine).count() == 3
    assert tables.read_or_build(spark, path, nine, overwrite=True).count() == 9
    unfinished = scratch_path(spark, "unfinished")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        spark.range(2).write.parquet(unfinished)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not tables.table_exists(spark, unfinished)


def test_lookup_files_keep_zeros_and_order(spark, tmp_path):
    (tmp_path / "beats.csv").write_text("unit,beat\n001,0111\n2,0112\n009,0111\n0123,12345\n")
    beats = tables.read_unit_beats(spark, str(tmp_path / "beats.csv"))
    assert [(r.unit, r.beat) for r in beats.orderBy("line_no").collect()] == [
        ("001", "0111"), ("002", "0112"), ("009", "0111"), ("0123", "12345"),
    ]


def test_points(spark, tmp_path):
    (tmp_path / "p.geojson").write_text(
        '{\n"type": "FeatureCollection",\n"features": [\n'
        '{"type": "Feature", "properties": {"dist_label": "1ST", "dist_num": "1"}, '
        '"geometry": {"type": "Point", "coordinates": [-87.5, 41.5]}},\n'
        '{"type": "Feature", "properties": {"dist_label": "2ND", "dist_num": "2"}, '
        '"geometry": {"type": "Point", "coordinates": [-87.25, 41.75]}}\n]}'
    )
    points = tables.read_points(spark, str(tmp_path / "p.geojson"), "dist_label string, dist_num string")
    assert [tuple(r) for r in points.orderBy("dist_num").collect()] == [
        ("1ST", "1", -87.5, 41.5), ("2ND", "2", -87.25, 41.75),
    ]


def test_whole_run(spark):
    raw, beats = fixture.incidents(spark, SF), fixture.unit_beats(spark, SF)
    out = scratch_path(spark, "prepared")
    stored = run_prepare(spark, raw, beats, out)
    assert run_prepare(spark, None, beats, out).count() == stored.count() == raw.count()
    assert not {"first_name", "charges_class"} & set(stored.columns)
    profiled = prepare(raw, beats, Settings(profile_types=True))
    assert profiled.select("arrest_id", "unit", "beat").exceptAll(
        stored.select("arrest_id", "unit", "beat")
    ).isEmpty()
    led = stored.withColumn("charge_1_description_police_related", F.col("arrest_id") % 2 == 0)
    result = time_of_day_tables(led, Settings(target_year=2024))
    assert tuple(result["year_span"].first()) == (2024, 2024)
    assert {r.chart for r in result["percent_of_total"].collect()} >= {"All"}
    assert result["total_count"].first().n_records == 1000
    assert result["unit_stats"].where("kind = 'hist' and chart = 'by_unit'").count() > 0


def test_weighted_accuracy_of_large_counts(spark):
    cells = spark.createDataFrame(
        [("a", "a", 100_000), ("b", "b", 35_832), ("a", "b", 5_000), ("b", "a", 589)],
        "label string, prediction string, n bigint",
    )
    row = accuracy(cells, weight_col="n").first()
    assert (row.n_correct, row.n, round(row.accuracy, 5)) == (135832, 141421, 0.96048)
