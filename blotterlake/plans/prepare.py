"""Data preparation: raw incident table to prepared table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotterlake.config import Settings
from blotterlake.functions.dates import rounded_minute_fraction, time_of_day
from blotterlake.functions.keys import number_key
from blotterlake.functions.severity import severity_code
from blotterlake.operators.lookups import lookup_unit
from blotterlake.operators.schema import (
    drop_columns, ensure_id, force_types, normalize_columns, optimize_types, redact,
)
from blotterlake.sources.tables import read_or_build


def class_columns(df: DataFrame) -> list[str]:
    """Charge class columns; the combined column and codes already made are not among them."""
    return [
        c for c in df.columns
        if "_class" in c and c != "charges_class" and not c.endswith("_cat_code")
    ]


def add_severity_codes(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}_cat_code": severity_code(F.col(c)) for c in class_columns(df)})


def add_date_parts(df: DataFrame, *, date_col: str = "arrest_date") -> DataFrame:
    """Year, month, day of month and hour."""
    date = F.col(date_col)
    return df.withColumns(
        {
            "arrest_year": F.year(date),
            "arrest_month": F.month(date),
            "arrest_day": F.dayofmonth(date),
            "arrest_hour": F.hour(date),
        }
    )


def add_time_of_day(
    df: DataFrame, *, date_col: str = "arrest_date", carry_hour: bool = False
) -> DataFrame:
    date = F.col(date_col)
    return df.withColumns(
        {
            "arrest_minute": rounded_minute_fraction(date),
            "arrest_time": time_of_day(date, carry_hour=carry_hour),
        }
    )


def key_columns(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """District and beat as text keys: districts unpadded, beats four wide."""
    return df.withColumns(
        {
            settings.district_col: number_key(F.col(settings.district_col)),
            settings.beat_col: number_key(F.col(settings.beat_col), 4),
        }
    )


def prepare(df: DataFrame, unit_beats: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Raw to prepared in one pass: narrow steps and one lookup join, no job of its own if rows have ids.

    Rows of a source without ids are stored once to number them.  Types beyond the forced ones come from the source schema; ``profile_types`` infers them for a
    source that has none.
    """
    descriptions = [settings.description(i) for i in settings.slot_numbers]
    types = {"string": descriptions, "timestamp_ntz": list(settings.timestamp_columns)}
    df = df.transform(normalize_columns).transform(redact, settings.redact)
    df = ensure_id(df, id_col=settings.id_col, check=settings.check_ids)
    if settings.profile_types:
        df = optimize_types(df, special=types, exclude=[settings.id_col, *settings.drop])
    else:
        df = force_types(df, types)
    return (
        df.transform(drop_columns, settings.drop)
        .transform(add_date_parts, date_col=settings.date_col)
        .transform(add_severity_codes)
        .transform(key_columns, settings)
        .transform(lookup_unit, unit_beats, beat_col=settings.beat_col, unit_col=settings.unit_col)
        .transform(add_time_of_day, date_col=settings.date_col, carry_hour=settings.carry_hour)
    )


def run_prepare(
    spark: SparkSession,
    source: DataFrame | None,
    unit_beats: DataFrame,
    output: str,
    settings: Settings = Settings(),
    *,
    overwrite: bool = False,
) -> DataFrame:
    """The stored prepared table, or prepare ``source`` and store it by year."""
    build = lambda: None if source is None else prepare(source, unit_beats, settings)
    return read_or_build(
        spark, output, build, overwrite=overwrite, partition_by=("arrest_year",)
    )
