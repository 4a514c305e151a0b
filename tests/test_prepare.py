"""Goldens of headers, keys, dates, severity and the type profile."""

from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blotterlake.config import REDACT_COLUMNS, SEVERITY_ORDER
from blotterlake.functions.dates import nearest_quarter, round_quarter_hour, time_of_day
from blotterlake.functions.keys import number_key
from blotterlake.functions.severity import charge_type, severity_code
from blotterlake.functions.text import title_case_name
from blotterlake.operators import schema
from blotterlake.operators.lookups import dedupe_lookup, lookup_unit
from blotterlake.operators.schema import force_types
from blotterlake.plans.prepare import add_severity_codes, class_columns
from blotterlake.session import scratch_path
from blotterlake.sources import tables


def column(df, name):
    return [r[name] for r in df.collect()]


def test_headers_change_case_space_and_hyphen_only(spark):
    df = spark.createDataFrame([(1, 2)], ["Arrest Date", "CB-No.x"])
    assert schema.normalize_columns(df).columns == ["arrest_date", "cb_no.x"]


def test_colliding_headers_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "A-B"])
    with pytest.raises(ValueError, match="a_b"):
        schema.normalize_columns(df)


def test_redact_needs_every_column(spark):
    df = spark.createDataFrame([tuple("12345678")], list(REDACT_COLUMNS))
    with pytest.raises(ValueError, match="street_name"):
        schema.redact(df.drop("street_name"), REDACT_COLUMNS)
    assert schema.redact(df.withColumn("x", F.lit(1)), REDACT_COLUMNS).columns == ["x"]


def test_number_keys_pad_but_never_cut(spark):
    df = spark.createDataFrame([(None,), (7.9,), (-7.9,), (312.0,), (12345.0,)], "n double")
    assert column(df.select(number_key(F.col("n"), 4).alias("k")), "k") == [
        "0000", "0007", "00-7", "0312", "12345",
    ]
    assert column(df.select(number_key(F.col("n")).alias("k")), "k") == [
        "0", "7", "-7", "312", "12345",
    ]


STAMPS = [
    "2024-03-10 02:07:30", "2024-03-10 02:22:30", "2024-03-10 02:37:30", "2024-03-10 02:52:30",
    "2024-01-01 10:53:00", "2024-01-01 23:55:00", "1965-07-04 11:07:30.000001",
    "2024-01-01 00:07:29.999999", "2024-12-31 23:52:30",
]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_quarter_rounding_matches_half_even(spark, kind):
    df = spark.createDataFrame([(s,) for s in STAMPS], "s string").select(
        F.col("s").cast(kind).alias("t")
    )
    got = column(df.select(F.date_format(round_quarter_hour(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("r")), "r")
    want = [str(pd.Timestamp(s).round("15min")) for s in STAMPS]
    assert got == want


def test_hour_is_not_carried_by_default(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 10, 53),), (datetime(2024, 1, 1, 23, 55),), (datetime(2024, 1, 1, 9, 20),)],
        "t timestamp_ntz",
    )
    assert column(df.select(time_of_day(F.col("t")).alias("x")), "x") == [10.0, 23.0, 9.25]
    carried = time_of_day(F.col("t"), carry_hour=True).alias("x")
    assert column(df.select(carried), "x") == [11.0, 0.0, 9.25]
    assert column(df.select(nearest_quarter(F.col("t")).alias("x")), "x") == [4, 4, 1]


def test_severity_codes(spark):
    classes = [*SEVERITY_ORDER, None, "Q"]
    df = spark.createDataFrame([(c,) for c in classes], "c string")
    assert column(df.select(severity_code(F.col("c")).alias("x")), "x") == [*range(14), -1, -1]


def test_class_columns_leave_out_combined_and_coded(spark):
    df = spark.createDataFrame([("M", "X", 3)], ["charges_class", "charge_1_class", "charge_1_class_cat_code"])
    assert class_columns(df) == ["charge_1_class"]
    once = add_severity_codes(df)
    assert add_severity_codes(once).collect() == once.collect()


def test_charge_type_borders(spark):
    codes = [-1, 0, 1, 4, 5, 7, 8, 13]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    assert column(df.select(charge_type(F.col("c")).alias("x")), "x") == [
        "Not Specified", "None", "Petty or Other", "Petty or Other", "Misdemeanor", "Misdemeanor",
        "Felony", "Felony",
    ]


def test_title_case_strips_signs(spark):
    df = spark.createDataFrame([("  o'neil,  JR. ",), ("mary-ann",), (None,)], "n string")
    assert column(df.select(title_case_name(F.col("n")).alias("x")), "x") == ["Oneil Jr", "Mary-Ann", None]


def test_lookup_last_row_wins_and_unmatched_is_null(spark):
    beats = spark.createDataFrame(
        [("001", "0111", 1), ("002", "0112", 2), ("009", "0111", 3), ("003", None, 4)],
        "unit string, beat string, line_no int",
    )
    df = spark.createDataFrame([("0111",), ("0112",), ("0999",), (None,)], "beat string")
    got = {r.beat: r.unit for r in lookup_unit(df, beats).collect()}
    assert got == {"0111": "009", "0112": "002", "0999": None, None: None}


def test_repeated_pair_keeps_its_first_place(spark):
    lookup = spark.createDataFrame([("k", "a", 1), ("k", "b", 2), ("k", "a", 3)], "key string, v string, line_no int")
    assert column(dedupe_lookup(lookup, "key", "v"), "v") == ["b"]
    assert column(dedupe_lookup(lookup, "key", "v", distinct_pairs_first=False), "v") == ["a"]


def test_ambiguous_lookup_without_order_fails(spark):
    lookup = spark.createDataFrame([("k", "a"), ("k", "b"), ("m", "c"), ("m", "c")], "key string, v string")
    assert column(dedupe_lookup(lookup.where("key = 'm'"), "key", "v"), "v") == ["c"]
    with pytest.raises(Exception, match="two values: k"):
        dedupe_lookup(lookup, "key", "v").collect()


def test_profile_bounds_are_strict_and_casts_lossless(spark):
    df = spark.createDataFrame(
        [(-127, 127, 0.1, 0.5, "true", "2024-01-01", "x", "a1"), (126, 5, 0.2, 2049.0, "False", "bad", "x", "a2")],
        "a bigint, b bigint, f double, g double, flag string, the_date string, kind string, name string",
    )
    got = {r.column_name: r.target_type for r in schema.profile_columns(df).collect()}
    assert got == {
        "a": "tinyint", "b": "smallint", "f": "double", "g": "float", "flag": "boolean",
        "the_date": "string", "kind": "category", "name": "category",
    }
    typed = schema.optimize_types(df, special={"string": ["kind"]}, exclude=["b"])
    assert dict(typed.dtypes)["a"] == "tinyint" and dict(typed.dtypes)["b"] == "bigint"
    assert typed.select("a", "b", "f", "g").collect() == df.select("a", "b", "f", "g").collect()
    assert column(typed, "kind") == ["x", "x"] and column(typed, "name") == ["A1", "A2"]


def test_boolean_needs_all_values(spark):
    df = spark.createDataFrame([("true",), ("maybe",)], "flag string")
    assert schema.profile_columns(df).first().target_type == "category"
    nothing = spark.createDataFrame([(None,)], "flag string")
    assert schema.profile_columns(nothing).first().target_type == "category"


def test_profile_counts_are_exact_and_expand_no_rows(spark):
    df = spark.range(3000).selectExpr("cast(id as string) s", "cast(id % 5 as string) t", "if(id % 7 = 0, null, 'one') u", "cast(null as string) v", "id")
    found = {r.column_name: (r.n_distinct, r.n_null, r.target_type) for r in schema.profile_columns(df).collect()}
    assert found == {
        "s": (3000, 0, "string"), "t": (5, 0, "category"), "u": (1, 429, "category"), "v": (0, 3000, "category"), "id": (None, 0, "smallint"),
    }
    plan = schema.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "approx_count_distinct" not in plan and "hyperloglog" not in plan.lower()


def test_counts_near_a_threshold_are_made_exact(spark):
    df = spark.range(1000).selectExpr(
        "concat('v', id % 19) a", "concat('v', id % 20) b", "concat('v', id % 99) c", "concat('v', id % 100) d"
    )
    typed = schema.optimize_types(df)
    changed = [c for c in df.columns if typed.first()[c] != df.first()[c]]
    assert changed == ["a", "b", "c"]  # under 20 values, or under a tenth of the rows


def test_surrogate_ids_are_contiguous_in_order(spark):
    df = spark.range(1000).selectExpr("id % 3 as hot", "1000 - id as k").repartition(7)
    rows = schema.surrogate_id(df, ["hot", "k"]).orderBy("arrest_id").collect()
    assert [r.arrest_id for r in rows] == list(range(1000))
    assert [(r.hot, r.k) for r in rows] == sorted((r.hot, r.k) for r in rows)


def test_missing_numbers_make_the_zero_key(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 7.9)], "i int, x double")
    keys = df.select("i", number_key(F.col("x")).alias("a"), number_key(F.col("x"), 4).alias("b"))
    assert [tuple(r) for r in keys.orderBy("i").collect()] == [(1, "0", "0000"), (2, "0", "0000"), (3, "7", "0007")]


def test_values_of_another_type_are_an_error(spark):
    df = spark.createDataFrame([("5",), (None,), ("x",)], "n string")
    assert [r.n for r in force_types(df, {"bigint": ["n"]}, on_error="null").collect()] == [5, None, None]
    with pytest.raises(Exception, match="n is not of type bigint: x"):
        force_types(df, {"bigint": ["n"]}).collect()
    with pytest.raises(ValueError):
        force_types(df, {"bigint": ["n"]}, on_error="skip")


def test_csv_is_read_by_header(spark, tmp_path):
    path = tmp_path / "xw.csv"
    path.write_text(
        'Note,Police-Related,MACRO category,micro_category,Description\n'
        'n,True,Person,Theft,"POSS ""CRACK"", ROCK"\nn,false,Other,Minor,"two\nlines"\nn,,,,\n'
    )
    rows = tables.read_charge_crosswalk(spark, str(path)).drop("line_no").collect()
    assert {tuple(r) for r in rows} == {
        ('POSS "CRACK", ROCK', "Theft", "Person", True), ("two\nlines", "Minor", "Other", False), (None, None, None, None),
    }
    path.write_text("description,micro_category,macro_category,police_related\na,b,c,Perhaps\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_charge_crosswalk(spark, str(path)).collect()
    path.write_text("description,micro_category,macro_category\na,b,c\n")
    with pytest.raises(ValueError, match="police_related"):
        tables.read_charge_crosswalk(spark, str(path))


def test_shared_csv_keeps_quotes_and_line_ends(spark):
    rows = [(1, 'a\n"b", c', None), (2, "''", "x\\"), (3, "\r\n", '""'), (None, ",", " lead")]
    df = spark.createDataFrame(rows, "i bigint, t string, u string")
    path = scratch_path(spark, "csv")
    tables.write_shared_csv(df, path)
    assert sorted(map(str, tables.read_shared_csv(spark, path, df.schema).collect())) == sorted(map(str, df.collect()))


def test_partitioned_table_has_few_files(spark):
    df = spark.range(0, 5000, 1, 16).selectExpr("id", "cast(id % 3 as int) AS arrest_year")
    path = scratch_path(spark, "years")
    tables.write_table(df, path, partition_by=("arrest_year",))
    assert spark.read.parquet(path).count() == 5000
    files = [f for f in spark.read.parquet(path).inputFiles()]
    assert len(files) == 3
