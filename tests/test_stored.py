"""Stored tables: versions, placement of rows in files, ids, and what a run leaves."""

import os

import pytest
from pyspark.sql import functions as F

from blotterlake.config import Settings
from blotterlake.operators.lookups import coalesce_update
from blotterlake.operators.schema import ensure_id
from blotterlake.plans import classify as cascade
from blotterlake.plans.prepare import prepare
from blotterlake.catalog import fixture
from blotterlake.session import materialize, scratch_path
from blotterlake.sources import tables, versions

SF = "/root/testdata/sf0.001"


def stop(*_, **__):
    raise KeyboardInterrupt


@pytest.mark.parametrize("step", ["write", "announce"])
def test_a_run_that_ends_early_leaves_the_old_table(spark, monkeypatch, step):
    path = scratch_path(spark, "versions")
    tables.publish_table(spark.range(3).toDF("x"), path)
    reader = tables.read_table(spark, path)
    with monkeypatch.context() as broken:
        broken.setattr(*((tables, "write_table") if step == "write" else (versions, "_announce")), stop)
        with pytest.raises(KeyboardInterrupt):
            tables.read_or_build(spark, path, lambda: spark.range(9).toDF("x"), overwrite=True)
    assert tables.read_table(spark, path).count() == 3 and tables.table_exists(spark, path)
    assert tables.read_or_build(spark, path, lambda: spark.range(9).toDF("x"), overwrite=True).count() == 9
    assert reader.count() == 3  # the version before stays for readers that have begun
    for n in (4, 5):
        tables.publish_table(spark.range(n).toDF("x"), path)
    assert tables.read_table(spark, path).count() == 5 and len(versions.published(spark, path)) == 2


def test_a_failed_task_publishes_nothing(spark):
    path = scratch_path(spark, "failing")
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        tables.publish_table(bad, path)
    assert not tables.table_exists(spark, path)


def test_tables_without_versions_are_read_too(spark):
    path = scratch_path(spark, "plain")
    spark.range(5).write.parquet(path)
    assert tables.table_exists(spark, path) and tables.read_table(spark, path).count() == 5


def files_of(spark, path):
    """(year, sorted ids, size) of each file."""
    table = spark.read.parquet(path).withColumn("file", F.input_file_name())
    rows = table.groupBy("file", "arrest_year").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()
    return sorted(((r.arrest_year is None, r.arrest_year or 0), tuple(r.ids), os.path.getsize(r.file.removeprefix("file://"))) for r in rows)


def test_rows_go_to_the_same_files_whatever_order_they_are_read_in(spark):
    rows = spark.range(0, 20_000, 1, 8).selectExpr(
        "id", "case when id % 10 < 7 then 2020 when id % 10 < 9 then 2021 when id > 100 then 2022 end AS arrest_year", "repeat(md5(cast(id as string)), 4) AS t"
    )
    one, other = materialize(rows, "order"), materialize(rows.orderBy(F.desc("t")).repartition(3), "order")
    found = []
    for df in (one, other):
        path = scratch_path(spark, "placed")
        tables.write_table(df, path, partition_by=("arrest_year",), file_bytes=200_000)
        found.append(files_of(spark, path))
    assert [f[:2] for f in found[0]] == [f[:2] for f in found[1]]
    sizes = [size for (_, year), _, size in found[0] if year in (2020, 2021)]
    assert len(sizes) >= 5 and max(sizes) <= 2 * min(sizes)
    assert sum(len(ids) for _, ids, _ in found[0]) == 20_000
    no_rows = scratch_path(spark, "placed")
    tables.write_table(one.limit(0), no_rows, partition_by=("arrest_year",))
    assert spark.read.schema(one.schema).parquet(no_rows).count() == 0


def test_ids_are_assigned_where_absent(spark):
    raw = fixture.incidents(spark, SF)
    given = prepare(raw, fixture.unit_beats(spark, SF))
    numbered = prepare(raw.drop("arrest_id"), fixture.unit_beats(spark, SF))
    assert sorted(numbered.columns) == sorted(given.columns)
    ids = sorted(r.arrest_id for r in numbered.select("arrest_id").collect())
    assert ids == list(range(raw.count()))
    named = ensure_id(spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1), id_col="n")
    assert sorted(map(tuple, named.collect())) == [("a", 0), ("b", 1)]  # in the order they lie in


def test_given_ids_may_be_checked(spark):
    twice = spark.createDataFrame([(1,), (2,), (1,)], "arrest_id long")
    assert ensure_id(twice).count() == 3
    with pytest.raises(ValueError, match="not unique"):
        ensure_id(twice, check=True)
    assert ensure_id(twice.distinct(), check=True).count() == 2


def test_repeated_updates(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "old", None), (None, None, None)], "id int, a string, b string")
    same = spark.createDataFrame([(1, "new", "x"), (1, "new", "x"), (None, "no", "no"), (None, "other", "no")], "id int, a string, b string")
    found = sorted(map(tuple, coalesce_update(df, same, "id", ["a", "b"]).collect()), key=str)
    assert found == [(1, "new", "k"), (2, "old", None), (None, None, None)]
    differ = spark.createDataFrame([(1, "new", "x"), (1, "newer", "x")], "id int, a string, b string")
    with pytest.raises(Exception, match="two values: 1"):
        coalesce_update(df, differ, "id", ["a"]).collect()


def test_a_run_leaves_its_evaluation(spark):
    crosswalk = spark.createDataFrame(
        [(f"charge of {w} number {i}", w, "Any", w == "theft", i) for i, w in enumerate(["theft", "arson", "fraud"] * 8)],
        "description string, micro_category string, macro_category string, police_related boolean, line_no int",
    )
    rows = crosswalk.select(F.col("line_no").cast("long").alias("arrest_id"), F.col("description").alias("charge_1_description"), F.lit(2020).alias("arrest_year"))
    models = scratch_path(spark, "models")
    cascade.run_classify(spark, rows, crosswalk, scratch_path(spark, "run"), Settings(slots=1), model_folder=models)
    found = tables.read_table(spark, f"{models}/evaluation/micro_accuracy").first()
    matrix = spark.read.option("header", True).csv(versions.current(spark, f"{models}/evaluation/micro_confusion"))
    assert 0 < found.n < 24 and matrix.columns[0] == "label"
    assert sum(int(r[c]) for r in matrix.collect() for c in matrix.columns[1:]) == found.n
    counts = tables.read_table(spark, f"{models}/evaluation/police_confusion").first()
    assert sum(counts) == tables.read_table(spark, f"{models}/evaluation/police_accuracy").first().n == found.n


def test_csv_incidents_are_split_unless_lines_are_quoted(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("Arrest-ID,note\n" + "".join(f"{i},\"plain, {i}\"\n" for i in range(40_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        split = tables.read_incidents(spark, str(path), fmt="csv")
        whole = tables.read_incidents(spark, str(path), fmt="csv", multi_line=True)
        assert split.rdd.getNumPartitions() > 3 and whole.rdd.getNumPartitions() == 1
        assert split.columns == ["arrest_id", "note"] and split.exceptAll(whole).count() == 0 and split.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _features(n):
    """One collection, laid out as common writers do: heads with nested objects, a null geometry, braces in values."""
    head = '{\n"type": "FeatureCollection",\n"crs": { "type": "name", "properties": { "name": "x" } },\n"features": [\n'
    rows = [
        f'{{ "type": "Feature", "properties": {{ "label": "a}} {i}, é", "num": "{i}" }}, '
        + ('"geometry": null }' if i == 7 else f'"geometry": {{ "type": "Point", "coordinates": [ {i / 8}, {-i / 4} ] }} }}')
        for i in range(n)
    ]
    return head + ",\n".join(rows) + "\n]\n}\n"


def test_one_large_collection_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "large.geojson").write_text(_features(20_000), encoding="utf-8")
    (tmp_path / "none.geojson").write_text('{ "type": "FeatureCollection", "features": [ ] }\n')
    ddl = "label string, num string"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        found = tables.read_points(spark, str(tmp_path), ddl, feature_start='{ "type": "Feature",')
        assert found.rdd.getNumPartitions() >= 8
        rows = sorted(map(tuple, found.collect()), key=lambda r: int(r[1]))
        whole = sorted(map(tuple, tables.read_points(spark, str(tmp_path), ddl).collect()), key=lambda r: int(r[1]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == whole == [(f"a}} {i}, é", str(i), None if i == 7 else i / 8, None if i == 7 else -i / 4) for i in range(20_000)]


@pytest.mark.parametrize("start", ['{ "type": "Feature", "id"', '{ "type":  "Feature",', '"properties":'])
def test_features_that_begin_otherwise_are_an_error(spark, tmp_path, start):
    (tmp_path / "a.geojson").write_text(_features(5), encoding="utf-8")
    with pytest.raises(Exception, match="not one feature"):
        tables.read_points(spark, str(tmp_path), "label string, num string", feature_start=start).collect()
