"""Headers, projections, type profiling and row ids."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DoubleType, FloatType, IntegralType, StringType,
    TimestampNTZType, TimestampType,
)

from blotterlake.functions.text import title_case, title_case_name
from blotterlake.session import materialize

# ---- fixed values -------------------------------------------------------------------------
DATE_NAME_PARTS = ("_date", "date_")
BOOLEAN_TEXTS = ("true", "True", "False", "false")
CATEGORY_RATIO = 0.1
CATEGORY_MAX_DISTINCT = 20
INTEGER_TYPES = (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64))
# ---- end of fixed values ------------------------------------------------------------------


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case headers with ``_`` for space and hyphen; two equal results are an error."""
    names = [c.lower().replace(" ", "_").replace("-", "_") for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns collide after normalising: {twice}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns, all of which must exist: a misspelt personal column must not stay in."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns to drop are absent: {missing}")
    return df.drop(*columns)


redact = drop_columns


def titlecase_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: title_case_name(F.col(c)) for c in columns})


def category_domain(df: DataFrame, column: str) -> DataFrame:
    """Observed non-null values of a column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def fill_keys(df: DataFrame, *, unit_col: str = "unit", beat_col: str = "beat") -> DataFrame:
    return df.fillna({unit_col: "000", beat_col: "0000"})


def force_types(
    df: DataFrame, types: Mapping[str, Iterable[str]], *, on_error: str = "fail"
) -> DataFrame:
    """Cast the listed columns (type name to column names).

    A value that is not of the type ends the job, or becomes null with ``on_error="null"``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"unknown on_error {on_error!r}")

    def cast(name: str, target: str) -> Column:
        value = F.col(name).try_cast(target)
        if on_error == "null":
            return value
        shown = F.substring(F.col(name).cast("string"), 1, 100)
        failed = F.raise_error(F.concat(F.lit(f"{name} is not of type {target}: "), shown))
        return F.when(F.col(name).isNull() | value.isNotNull(), value).otherwise(failed)

    return df.withColumns({c: cast(c, t) for t, cols in types.items() for c in cols})


def preview(df: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    return df.orderBy(order_by).limit(n)


# ---- type profile -------------------------------------------------------------------------


def _is_date_name(name: str) -> bool:
    return any(part in name.lower() for part in DATE_NAME_PARTS)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(place, n_distinct): how many different non-null values each of the columns has, by its place in the list.

    A row becomes one narrow row for each of the columns: its place and a 128-bit hash of the value.  Repeats are dropped
    in the task, so what is shuffled are the distinct values of each task, without their texts.
    """
    values = [
        F.when(col.isNotNull(), F.struct(F.lit(i).alias("place"), F.xxhash64(col).alias("a"), F.xxhash64(F.lit(i), col).alias("b")))
        for i, col in ((i, F.col(f"`{c}`")) for i, c in enumerate(columns))
    ]
    seen = df.select(F.explode(F.array_compact(F.array(*values))).alias("v")).select("v.*").distinct()
    return seen.groupBy("place").agg(F.count(F.lit(1)).alias("n_distinct"))


def _statistics(name: str, dtype: DataType) -> dict[str, Column]:
    """Aggregates the type choice for one column needs, besides its number of distinct values."""
    col = F.col(f"`{name}`")
    stats = {"n_null": F.count_if(col.isNull())}
    if isinstance(dtype, IntegralType):
        stats |= {"lo": F.min(col).cast("double"), "hi": F.max(col).cast("double")}
        for type_name, bits in INTEGER_TYPES[:3]:
            low, high = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
            stats[type_name] = (F.min(col) > low) & (F.max(col) < high)
    elif isinstance(dtype, (FloatType, DoubleType)):
        same = col.cast("float").cast("double").eqNullSafe(col.cast("double"))
        stats |= {"lo": F.min(col).cast("double"), "hi": F.max(col).cast("double")}
        stats["float"] = F.bool_and(same)
    elif isinstance(dtype, StringType):
        if _is_date_name(name):
            failed = col.isNotNull() & F.try_to_timestamp(col).isNull()
            stats["is_date"] = F.count_if(failed) == 0
        else:
            stats["is_boolean"] = (F.count(col) > 0) & F.bool_and(col.isin(*BOOLEAN_TEXTS))
    return stats


def _choice(dtype: DataType, name: str, s: Mapping[str, Column]) -> Column:
    """Type name chosen from the statistics, in the order int, float, date, boolean, category."""
    if isinstance(dtype, IntegralType):
        choice = F.when(s["tinyint"], "tinyint").when(s["smallint"], "smallint")
        return choice.when(s["int"], "int").otherwise("bigint")
    if isinstance(dtype, (FloatType, DoubleType)):
        return F.when(s["float"], "float").otherwise("double")
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return F.lit(dtype.simpleString())
    if isinstance(dtype, BooleanType):
        return F.lit("boolean")
    if not isinstance(dtype, StringType):
        return F.lit(dtype.simpleString())
    if _is_date_name(name):
        return F.when(s["is_date"], "timestamp").otherwise("string")
    few = (s["n_distinct"] < CATEGORY_MAX_DISTINCT) | (
        s["n_distinct"] < s["n_records"] * CATEGORY_RATIO
    )
    return F.when(s["is_boolean"], "boolean").when(few, "category").otherwise("string")


def profile_columns(df: DataFrame, *, exclude: Iterable[str] = ()) -> DataFrame:
    """One row per column: counts, range and the narrowest type that holds all its values.

    One aggregate pass for the statistics and, if there are text columns, one for their distinct values
    (``distinct_counts``); all counts are exact.
    """
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    texts = [f.name for f in fields if isinstance(f.dataType, StringType)]
    if texts:
        entries = F.collect_list(F.struct("place", "n_distinct"))
        counts = distinct_counts(df, texts).agg(F.map_from_entries(entries)).scalar()
    aggregates, per_field = [F.count(F.lit(1)).alias("n_records")], []
    for i, field in enumerate(fields):
        stats = _statistics(field.name, field.dataType)
        aggregates += [value.alias(f"c{i}_{key}") for key, value in stats.items()]
        named = {key: F.col(f"c{i}_{key}") for key in stats} | {"n_records": F.col("n_records")}
        named["n_distinct"] = F.lit(None).cast("bigint")
        if field.name in texts:
            found = F.try_element_at(counts, F.lit(texts.index(field.name)))
            named["n_distinct"] = F.coalesce(found, F.lit(0).cast("bigint"))
        null = F.lit(None).cast("double")
        per_field.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("source_type"),
                named["n_records"].alias("n_records"),
                named["n_null"].alias("n_null"),
                named["n_distinct"].alias("n_distinct"),
                named.get("lo", null).alias("min_value"),
                named.get("hi", null).alias("max_value"),
                _choice(field.dataType, field.name, named).alias("target_type"),
            )
        )
    row = df.agg(*aggregates)
    return row.select(F.explode(F.array(*per_field)).alias("p")).select("p.*")


def apply_profile(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Cast columns to the profiled types; categories are title-cased text."""
    out = {}
    for name, target in targets.items():
        col = F.col(f"`{name}`")
        if target == "category":
            out[name] = title_case(col)
        elif target == "timestamp":
            out[name] = F.try_to_timestamp(col)
        else:
            out[name] = col.cast(target)
    return df.withColumns(out)


def optimize_types(
    df: DataFrame,
    *,
    special: Mapping[str, Iterable[str]] | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Force the ``special`` types, then narrow every other column by its profile.

    Runs the profile, whose counts are exact; only one row per column comes to the driver.
    """
    special = special or {}
    forced = force_types(df, special)
    skip = {*exclude, *(c for cols in special.values() for c in cols)}
    rows = profile_columns(forced, exclude=skip).collect()
    changes = {r.column_name: r.target_type for r in rows if r.target_type != r.source_type}
    return apply_profile(forced, changes)


# ---- row ids ------------------------------------------------------------------------------


def _numbered(df: DataFrame, id_col: str) -> DataFrame:
    """Number rows in the order they lie in, from 0 without gaps: stored once with their partition and
    place, and shifted by the sizes of earlier partitions (a table of one row per partition)."""
    place = F.monotonically_increasing_id()  # partition number * 2^33 + place in the partition
    placed = df.withColumns({"__part": F.shiftright(place, 33), "__place": place.bitwiseAND((1 << 33) - 1)})
    placed = materialize(placed, "row-ids")
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    numbered = placed.join(F.broadcast(offsets), "__part")
    numbered = numbered.withColumn(id_col, F.col("__offset") + F.col("__place"))
    return numbered.drop("__part", "__place", "__offset")


def surrogate_id(df: DataFrame, order_by: list[str], *, id_col: str = "arrest_id") -> DataFrame:
    """Number rows 0, 1, 2 ... in the order of ``order_by``, which must be unique as a whole.

    A global ``row_number`` would pull all rows into one task.  Instead rows are range-sorted and numbered
    by place.  Runs one write job.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _numbered(df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by), id_col)


def ensure_id(df: DataFrame, *, id_col: str = "arrest_id", check: bool = False) -> DataFrame:
    """The table with a row id: its own, or if it has none the place of each row in the source, from 0.

    With ``check`` a given id that is null or repeats is an error; that groups the ids once.
    """
    if id_col not in df.columns:
        return _numbered(df, id_col)
    if check:
        twice = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col(id_col).isNull() | (F.col("n") > 1))
        found = [r[0] for r in twice.select(id_col).limit(5).collect()]
        if found:
            raise ValueError(f"{id_col} is not unique: {found}")
    return df
