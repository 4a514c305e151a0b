"""Time-of-day analysis of the classified table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from blotterlake.config import Settings
from blotterlake.operators.density import unit_stats
from blotterlake.operators.hourly import (
    filter_year, group_year_span, lead_charge, null_key_count, percent_of_total, radar_series, store_groups,
    total_count,
)


def time_of_day_tables(df: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Year span, radar chart rows with their totals and shares, and unit densities.

    Runs two jobs: the fact table is grouped once by hour and once by unit and time.
    """
    df = filter_year(df, settings.target_year, date_col=settings.date_col)
    led = lead_charge(df, settings)
    groups = store_groups(led, settings)
    series = radar_series(groups, settings)
    total = total_count(groups.dropna())
    return {
        "year_span": group_year_span(groups),
        "radar_series": series,
        "percent_of_total": percent_of_total(series, total.scalar()),
        "total_count": total,
        "null_key_count": null_key_count(groups),
        "unit_stats": unit_stats(led),
    }
