"""Lookup joins, the charge-slot reshaping, and writing resolved values back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from blotterlake.config import Settings
from blotterlake.session import materialize, plan_bytes


def _has_order(columns: Sequence[str], order_col: str | None) -> bool:
    return order_col is not None and order_col in columns


def _only_value(value: str, key: str, what: str) -> Column:
    """Aggregate: the one value of a group, which may be null; an error if there are two."""
    first, last = F.min(value), F.max(value)
    nulls = F.count_if(F.col(value).isNull())
    clear = first.eqNullSafe(last) & ((nulls == 0) | (nulls == F.count(F.lit(1))))
    message = F.concat(F.lit(f"{what} key has two values: "), F.col(key).cast("string"))
    return F.when(clear, first).otherwise(F.raise_error(message))


def dedupe_lookup(
    lookup: DataFrame,
    key: str,
    value: str,
    *,
    order_col: str | None = "line_no",
    distinct_pairs_first: bool = True,
) -> DataFrame:
    """One value per non-null key.

    With an order column the last row wins.  ``distinct_pairs_first`` keeps the first place of
    each repeated (key, value) pair before that, as the charge lookups do.  Without an order
    column a key with two values is an error when the query runs.
    """
    rows = lookup.where(F.col(key).isNotNull())
    if not _has_order(lookup.columns, order_col):
        return rows.groupBy(key).agg(_only_value(value, key, "lookup").alias(value))
    if distinct_pairs_first:
        rows = rows.groupBy(key, value).agg(F.min(order_col).alias(order_col))
    return rows.groupBy(key).agg(F.max_by(value, order_col).alias(value))


def lookup_value(df: DataFrame, lookup: DataFrame, key: str, *, lookup_key: str | None = None) -> DataFrame:
    """Left join on a lookup with unique keys; rows without a match get null.

    No hint: Spark broadcasts the lookup when its size is under the session's threshold, and
    otherwise sort-merges, where adaptive execution splits a hot key's rows.
    """
    if lookup_key and lookup_key != key:
        lookup = lookup.withColumnRenamed(lookup_key, key)
    return df.join(lookup, key, "left")


def lookup_unit(
    df: DataFrame, crosswalk: DataFrame, *, beat_col: str = "beat", unit_col: str = "unit"
) -> DataFrame:
    """Unit of each row's beat; where a beat is listed twice the last row counts."""
    units = dedupe_lookup(crosswalk, "beat", "unit", distinct_pairs_first=False)
    units = units.toDF(beat_col, unit_col)
    return lookup_value(df.drop(unit_col), units, beat_col)


def unmapped(description: Column, target: Column) -> Column:
    """True where there is a description but no mapped value."""
    return description.isNotNull() & target.isNull()


def coalesce_update(df: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill nulls of ``columns`` from ``updates`` rows with the same key; values present stay.

    A key that ``updates`` repeats with the same values counts once; with different values it is an error
    when the query runs.  Updates without a key are left out.
    """
    fresh = updates.where(F.col(key).isNotNull()).groupBy(key).agg(*[_only_value(c, key, "update").alias(f"__{c}") for c in columns])
    joined = df.join(fresh, key, "left")
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in columns})
    return filled.drop(*[f"__{c}" for c in columns])


def unpivot_charges(
    df: DataFrame, settings: Settings = Settings(), *, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per non-null charge description: the id, ``slot`` and ``description``."""
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.col(settings.description(i)).alias("description"))
            for i in settings.slot_numbers
        ]
    )
    long = df.select(settings.id_col, *keep, F.explode(slots).alias("charge"))
    return long.select(settings.id_col, *keep, "charge.*").where("description is not null")


def pivot_charges(
    long: DataFrame, values: Sequence[str], settings: Settings = Settings()
) -> DataFrame:
    """Back to one row per id, with ``charge_{slot}_{value}`` columns."""
    aggregates = [
        F.max(F.when(F.col("slot") == i, F.col(v))).alias(f"charge_{i}_{v}")
        for i in settings.slot_numbers
        for v in values
    ]
    return long.groupBy(settings.id_col).agg(*aggregates)


RESOLVED_COLUMNS = {
    "micro": "description_category_micro",
    "macro": "description_category_macro",
    "police": "description_police_related",
}


HOT_KEYS = 1000  # most frequent keys joined by broadcast; every other holds under 1/1000 of rows


def join_spread(
    df: DataFrame, lookup: DataFrame, key: str, frequency: Column, *, spread_by: str
) -> DataFrame:
    """Left join on a large lookup with unique keys, without a task per hot key.

    Rows of the ``HOT_KEYS`` keys of highest ``frequency`` (a column of the lookup) are joined by
    broadcast and not shuffled; only the others go through the shuffle join.  Rows with a null key
    go there under many different keys that match nothing.  ``df`` is read twice.
    """
    values = [c for c in lookup.columns if c != key]
    hot = F.broadcast(lookup.orderBy(frequency.desc(), key).limit(HOT_KEYS))
    found = df.join(hot, key)
    filler = F.concat(F.lit("\0"), F.pmod(F.xxhash64(spread_by), F.lit(10_000)).cast("string"))
    rest = df.join(hot.select(key), key, "left_anti").withColumn("__key", F.coalesce(key, filler))
    joined = rest.join(lookup.withColumnRenamed(key, "__key"), "__key", "left").drop("__key")
    return found.select(*df.columns, *values).unionByName(joined.select(*df.columns, *values))


def attach_resolved(df: DataFrame, resolved: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add micro, macro and police columns for every charge slot from a description table.

    Every row gets the values of its own descriptions, whatever its id.  ``resolved`` must be stored:
    its files' size decides how.  Up to ``broadcast_bytes`` it is broadcast once per slot and the
    fact table is not shuffled.  Above that the fact table is stored with a number for each row; the
    non-null slots are unpivoted, joined by description, folded by number and joined by number: two
    narrow shuffles and one wide one, however many slots there are.
    """
    names = {c: f"charge_{{}}_{suffix}" for c, suffix in RESOLVED_COLUMNS.items()}
    if plan_bytes(resolved) <= settings.broadcast_bytes:
        for i in settings.slot_numbers:
            side = resolved.select(
                F.col("description").alias(settings.description(i)),
                *[F.col(c).alias(name.format(i)) for c, name in names.items()],
            )
            df = df.join(F.broadcast(side), settings.description(i), "left")
        return df
    counts = [F.col(c) for c in resolved.columns if c.startswith("n_slot_")]
    lookup = resolved.select("description", *RESOLVED_COLUMNS, sum(counts, F.lit(0)).alias("__n"))
    numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    by_row = replace(settings, id_col="__row")
    long = join_spread(
        unpivot_charges(numbered, by_row), lookup, "description", F.col("__n"), spread_by="__row"
    )
    for column, suffix in RESOLVED_COLUMNS.items():
        long = long.withColumnRenamed(column, suffix)
    folded = pivot_charges(long, list(RESOLVED_COLUMNS.values()), by_row)
    return numbered.join(folded, "__row", "left").drop("__row")
