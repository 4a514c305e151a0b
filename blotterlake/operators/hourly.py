"""Counts by time of day, outlier removal and the radar-chart series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blotterlake.config import CHARGE_TYPES, Settings
from blotterlake.functions.severity import charge_type, severity_code
from blotterlake.session import materialize

COUNT_KEYS = (
    "lead_charge_police_related", "lead_charge_code",
    "arrest_year", "arrest_month", "arrest_day", "arrest_hour",
)


def lead_charge(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Class, severity code and police flag of the first charge."""
    return df.withColumns(
        {
            "lead_charge": F.col(settings.lead_class_col),
            "lead_charge_code": severity_code(F.col(settings.lead_class_col)),
            "lead_charge_police_related": F.col(settings.police(1)),
        }
    )


def filter_year(
    df: DataFrame, year: int | None, *, date_col: str = "arrest_date", year_col: str = "arrest_year"
) -> DataFrame:
    """Rows of one year; ``None`` keeps all.

    The year column, when there, is the partition column of a stored table, so the filter
    prunes.  Otherwise a range on the timestamp is used, which reaches the Parquet statistics.
    """
    if year is None:
        return df
    if year_col in df.columns:
        return df.where(F.col(year_col) == year)
    kind = df.schema[date_col].dataType.simpleString()
    start, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast(kind) for y in (year, year + 1))
    return df.where((F.col(date_col) >= start) & (F.col(date_col) < end))


def year_span(df: DataFrame, date_col: str = "arrest_date") -> DataFrame:
    year = F.year(date_col)
    return df.agg(F.min(year).alias("min_year"), F.max(year).alias("max_year"))


def group_year_span(groups: DataFrame) -> DataFrame:
    """``year_span`` of the table that ``count_groups`` made it of: the fact table is not read again."""
    return groups.agg(F.min("arrest_year").alias("min_year"), F.max("arrest_year").alias("max_year"))


def distinct_hours(df: DataFrame, hour_col: str = "arrest_hour") -> DataFrame:
    """Hours that occur, as text in text order."""
    hours = df.where(F.col(hour_col).isNotNull()).select(F.col(hour_col).cast("string"))
    return hours.distinct().orderBy(hour_col)


def count_distinct_hours(df: DataFrame, hour_col: str = "arrest_hour") -> DataFrame:
    return df.agg(F.count_distinct(hour_col).alias("n_hours"))


def hour_angle(hour: Column, n_hours: Column) -> Column:
    """Place of the hour on a circle of ``n_hours``; null for an hour beyond them."""
    return F.when(hour < n_hours, hour / n_hours * 2 * F.pi())


def count_groups(df: DataFrame, *, id_col: str = "arrest_id") -> DataFrame:
    """Arrests per flag, code, year, month, day and hour, null keys included."""
    return df.groupBy(*COUNT_KEYS).agg(F.count(id_col).alias("arrest_id_count"))


def hourly_counts(
    df: DataFrame, *, id_col: str = "arrest_id", drop_null_keys: bool = True
) -> DataFrame:
    """As ``count_groups``, by default without the groups that have a null key."""
    if drop_null_keys:
        df = df.dropna(subset=list(COUNT_KEYS))
    return count_groups(df, id_col=id_col)


def null_key_count(groups: DataFrame, n_col: str = "arrest_id_count") -> DataFrame:
    """Arrests that ``hourly_counts`` leaves out because a key is null."""
    missing = F.greatest(*[F.col(c).isNull() for c in COUNT_KEYS])
    return groups.agg(F.coalesce(F.sum(F.when(missing, F.col(n_col))), F.lit(0)).alias("n_dropped"))


def total_count(hourly: DataFrame, n_col: str = "arrest_id_count") -> DataFrame:
    return hourly.agg(F.sum(n_col).alias("n_records"))


def with_charge_type(df: DataFrame, code_col: str = "lead_charge_code") -> DataFrame:
    return df.withColumn(f"{code_col}_type", charge_type(F.col(code_col)))


def with_zscore(
    df: DataFrame,
    value_col: str = "arrest_id_count",
    *,
    by: str = "lead_charge_code_type",
    zscore_col: str | None = None,
) -> DataFrame:
    """Distance of a value from its group's mean in population standard deviations.

    Null where the group does not vary.  Means are aggregated and joined back, because a window
    would put a whole group into one task.
    """
    name = zscore_col or f"{value_col}_zscore"
    moments = df.groupBy(by).agg(
        F.avg(value_col).alias("__mean"), F.stddev_pop(value_col).alias("__spread")
    )
    moments = moments.withColumn("__spread", F.nullif(F.col("__spread"), F.lit(0.0)))
    z = (F.col(value_col) - F.col("__mean")) / F.col("__spread")
    return df.join(moments, by).withColumn(name, z).drop("__mean", "__spread")


def remove_outliers(df: DataFrame, limit: float | None = 3.0, *, zscore_col: str) -> DataFrame:
    """Keep rows within ``limit`` deviations; rows without a z-score go.  ``None`` keeps all."""
    return df if limit is None else df.where(F.abs(F.col(zscore_col)) <= limit)


def store_groups(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``count_groups``, run once and stored: all a chart needs of the fact table."""
    return materialize(count_groups(df, id_col=settings.id_col), "hourly")


def radar_series(groups: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of the five charts: all arrests, and each charge type without outliers.

    ``groups`` comes from ``store_groups``; it is read several times.  Its null keys are left out
    of the charts, but their hours count towards the number of angles.
    """
    if settings.n_hours is None:
        n_hours = count_distinct_hours(groups).scalar()
    else:
        n_hours = F.lit(settings.n_hours)
    counts = with_charge_type(groups.dropna(subset=list(COUNT_KEYS)))
    scored = with_zscore(counts)
    z_col = "arrest_id_count_zscore"
    scored = scored.withColumn(z_col, F.abs(F.col(z_col)))
    typed = remove_outliers(scored, settings.outlier_z, zscore_col=z_col)
    typed = typed.where(F.col("lead_charge_code_type").isin(*CHARGE_TYPES))
    everything = scored.withColumn(z_col, F.lit(None).cast("double")).withColumn("chart", F.lit("All"))
    charts = typed.withColumn("chart", F.col("lead_charge_code_type")).unionByName(everything)
    angle = hour_angle(F.col("arrest_hour"), n_hours)
    return charts.withColumn("arrest_time_angle", angle)


def percent_of_total(
    series: DataFrame, total: Column, *, by: str = "chart", n_col: str = "arrest_id_count"
) -> DataFrame:
    """Share of each chart in all arrests, in percent to one decimal, half to even."""
    share = F.bround(F.lit(100.0) * F.sum(n_col) / total, 1)
    return series.groupBy(by).agg(F.sum(n_col).alias("n_records"), share.alias("pct_of_total"))
