"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructType, TimestampNTZType, VariantType

from blotterlake.config import DROP_COLUMNS, REDACT_COLUMNS, Settings
from blotterlake.functions.keys import zero_fill
from blotterlake.operators.schema import normalize_columns
from blotterlake.session import input_bytes, materialize
from blotterlake.sources import versions


def incident_schema(settings: Settings = Settings()) -> StructType:
    """Schema of a raw incident table with normalised headers."""
    text = [*REDACT_COLUMNS, *DROP_COLUMNS]
    for slot in settings.slot_numbers:
        text += [settings.description(slot), f"charge_{slot}_class"]
    schema = StructType().add(settings.id_col, LongType(), nullable=False)
    for name in text:
        schema = schema.add(name, StringType())
    schema = schema.add(settings.date_col, TimestampNTZType())
    for name in settings.timestamp_columns:
        schema = schema.add(name, StringType())
    return schema.add(settings.district_col, DoubleType()).add(settings.beat_col, DoubleType())


def _csv(spark: SparkSession, multi_line: bool = True):
    """CSV with a header and doubled quotes; a malformed row is an error.

    With line ends inside quotes (``multi_line``) a file is one task; without, Spark splits it.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return reader.option("mode", "FAILFAST").option("inferSchema", False)


def _by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns of a table of texts, found by normalised header and cast strictly."""
    df = normalize_columns(df)
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns are absent: {absent}; there are {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_incidents(
    spark: SparkSession, path: str, *, schema: StructType | None = None, fmt: str = "parquet", multi_line: bool = False
) -> DataFrame:
    """Scan an incident table.  A given schema saves the inference pass and prunes columns.

    CSV columns are found by header, in any order; a value that is not of its type is an error.  A CSV file is
    read by many tasks; one with line ends inside quotes needs ``multi_line`` and is read by one.
    """
    if fmt == "csv":
        found = _csv(spark, multi_line).csv(path)
        return normalize_columns(found) if schema is None else _by_name(found, schema)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _file_position() -> Column:
    """Order of rows within a text source: file, split start, row within the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_lookup(
    spark: SparkSession, path: str, columns: str, *, order_col: str = "line_no", fmt: str = "csv"
) -> DataFrame:
    """Scan a lookup file: the columns of the DDL ``columns``, by name, plus the row order.

    Headers are normalised as incident headers are; other columns of the file are left out, an
    absent one is an error, as is a value that is not of its type.  Reading keys as strings keeps
    their leading zeros.  The order column is what "the last row wins" refers to when a key is
    repeated.
    """
    schema = StructType.fromDDL(columns)
    found = _csv(spark).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    placed = normalize_columns(found).withColumn(order_col, _file_position())
    order = placed.schema[order_col]
    return _by_name(placed, StructType([*schema.fields, order]))


def read_unit_beats(spark: SparkSession, path: str) -> DataFrame:
    """Unit and beat crosswalk with zero-padded text keys."""
    return read_lookup(spark, path, "unit string, beat string").select(
        zero_fill(F.col("unit"), 3).alias("unit"), zero_fill(F.col("beat"), 4).alias("beat"),
        "line_no",
    )


def read_charge_crosswalk(spark: SparkSession, path: str, *, fmt: str = "csv") -> DataFrame:
    """Charge crosswalk; a flag other than a spelling of true or false is an error."""
    columns = (
        "description string, micro_category string, macro_category string, police_related boolean"
    )
    return read_lookup(spark, path, columns, fmt=fmt)


class CrosswalkLookups(NamedTuple):
    micro: DataFrame
    macro: DataFrame
    police: DataFrame


def crosswalk_lookups(crosswalk: DataFrame) -> CrosswalkLookups:
    """Distinct (description, micro), (micro, macro) and (description, police flag) pairs."""
    return CrosswalkLookups(
        crosswalk.select("description", "micro_category").distinct(),
        crosswalk.select("micro_category", "macro_category").distinct(),
        crosswalk.select("description", "police_related").distinct(),
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a write to ``path`` was completed: a version was published, or the success marker is there."""
    return versions.current(spark, path) is not None or versions.exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table: its current version, or the folder itself if it was written without versions."""
    return spark.read.parquet(versions.current(spark, path) or path)


FILE_BYTES = 256 << 20  # of input that a file of a partitioned table is made from


def _placed(df: DataFrame, partition_by: tuple[str, ...], file_bytes: int) -> DataFrame:
    """Deal rows to one task for each file to write.

    A partition value gets as many files as its share of the input's bytes needs.  Which of them a row goes to
    follows from a hash of its content, so a task that is run again deals its rows as before, whatever order it reads them
    in.  (Equal rows go to the same file.)  Reads ``df`` once more to count the rows of each value.
    """
    total = input_bytes(df)
    sizes = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("__rows"))
    share = F.col("__rows") / F.sum("__rows").over(Window.partitionBy())
    sizes = sizes.withColumn("__files", F.greatest(F.ceil(share * total / file_bytes), F.lit(1)))
    before = Window.orderBy(*partition_by).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("__files").over(before), F.lit(0))
    names = [F.col(c).alias(f"__value_{i}") for i, c in enumerate(partition_by)]
    places = materialize(sizes.select(*names, "__files", first.alias("__first")), "file-places")  # a row for each value
    files = places.agg(F.sum("__files")).first()[0]
    if not files:
        return df
    same = [F.col(c).eqNullSafe(F.col(f"__value_{i}")) for i, c in enumerate(partition_by)]
    content = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
    at = F.col("__first") + F.pmod(F.xxhash64(*content), F.col("__files"))
    return df.join(places, same).repartitionById(int(files), at.cast("int")).select(*[F.col(f"`{c}`") for c in df.columns])


def write_table(
    df: DataFrame, path: str, *, partition_by: tuple[str, ...] = (), file_bytes: int = FILE_BYTES
) -> None:
    """Write Parquet, replacing what is there.

    For a partitioned table rows are first dealt by partition value, so that a value's rows end in
    about one file per ``file_bytes`` of the input, not in one per task.
    """
    if partition_by:
        df = _placed(df, partition_by, file_bytes)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def publish_table(
    df: DataFrame, path: str, *, partition_by: tuple[str, ...] = (), file_bytes: int = FILE_BYTES
) -> None:
    """Write a new version of a stored table and make it the current one when it is whole (``versions``)."""
    write = lambda folder: write_table(df, folder, partition_by=partition_by, file_bytes=file_bytes)
    versions.publish(df.sparkSession, path, write)


def read_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame | None],
    *,
    overwrite: bool = False,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """The stored table if it is complete, else what ``build`` makes, published and read back."""
    if overwrite or not table_exists(spark, path):
        df = build()
        if df is None:
            raise FileNotFoundError(f"no table at {path} and nothing to build it from")
        publish_table(df, path, partition_by=partition_by)
    return read_table(spark, path)


def write_shared_csv(df: DataFrame, path: str, *, max_rows_per_file: int = 5_000_000) -> None:
    """Write gzip CSV parts with headers; parts are bounded because gzip cannot be split."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_rows_per_file)
        .csv(path)
    )


def read_shared_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The shared table, columns by name; quotes, spaces and line ends inside values are kept.

    An empty text comes back as null: CSV has one spelling for both.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return _by_name(_csv(spark).csv(path), schema)


def write_matrix_csv(matrix: DataFrame, path: str) -> None:
    """Write a confusion matrix (labels by labels, so small) as one CSV file."""
    writer = matrix.coalesce(1).write.mode("overwrite").option("header", True)
    writer.option("escape", '"').csv(path)


COLLECTION_HEAD = r'(?s)^\s*(\{.*"features"\s*:\s*\[\s*(\].*)?)?$'
GEOMETRY_KEY = r'"geometry"\s*:'


def read_points(spark: SparkSession, path: str, properties: str, *, feature_start: str | None = None) -> DataFrame:
    """Point features of GeoJSON collections; null ``lon`` and ``lat`` where a feature has no geometry.

    ``properties`` is the DDL of the feature properties to keep.  With ``feature_start``, the text every feature
    begins with (say ``{ "type": "Feature",``), Spark splits the files there and features are parsed one by one
    by many tasks; text that is neither a feature nor a collection's head, and features that begin otherwise, are
    an error.  Without it a file is one collection and one task.
    """
    feature = f"struct<properties:struct<{properties}>,geometry:struct<coordinates:array<double>>>"
    if feature_start is None:
        documents = spark.read.schema(f"features array<{feature}>").option("multiLine", True).json(path)
        point = documents.select(F.explode("features").alias("f"))
    else:
        pieces = spark.read.option("lineSep", feature_start).text(path)
        # What follows a feature in its piece (a comma, the collection's end) is not parsed.
        parsed = pieces.select("value", F.from_json(F.concat(F.lit(feature_start), "value"), feature).alias("f"))
        is_feature = F.col("f.properties").isNotNull() | F.col("f.geometry").isNotNull()
        whole = is_feature & (F.regexp_count("value", F.lit(GEOMETRY_KEY)) <= 1)
        error = F.raise_error(F.concat(F.lit("not one feature: "), F.substring("value", 1, 200)))
        kept = F.when(whole, True).when(~is_feature & F.col("value").rlike(COLLECTION_HEAD), False).otherwise(error.cast("boolean"))
        point = parsed.where(kept)
    return point.select(
        "f.properties.*",
        F.col("f.geometry.coordinates")[0].alias("lon"),
        F.col("f.geometry.coordinates")[1].alias("lat"),
    )
