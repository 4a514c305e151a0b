"""Histogram and kernel density of the time of day per unit.

Times are quarter hours, so a curve has at most 96 distinct values.  The fact table is grouped to
(type, flag, unit, time) counts once; everything else works on those.

``panel`` columns say which rows share one set of bins and one grid, and which total the areas
are divided by; ``curve`` columns say which rows make one curve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from blotterlake.operators.hourly import with_charge_type
from blotterlake.session import materialize

TYPE, FLAG, UNIT = "lead_charge_code_type", "lead_charge_police_related", "unit"
BY_UNIT = ((TYPE,), (TYPE, UNIT))
BY_FLAG_AND_UNIT = ((TYPE, FLAG, UNIT), (TYPE, FLAG, UNIT))
GRID_POINTS = 200


def unit_time_counts(df: DataFrame, *, time_col: str = "arrest_time") -> DataFrame:
    """Arrests per charge type, police flag, unit and time of day."""
    typed = with_charge_type(df).select(TYPE, FLAG, UNIT, F.col(time_col).alias("x"))
    return typed.where("x is not null").groupBy(TYPE, FLAG, UNIT, "x").agg(
        F.count(F.lit(1)).alias("n")
    )


def panels_by_unit(counts: DataFrame) -> DataFrame:
    """Input of the per-type charts: both flags together, rows without a unit left out."""
    known = counts.where(F.col(UNIT).isNotNull())
    return known.groupBy(TYPE, UNIT, "x").agg(F.sum("n").alias("n"))


def panels_by_flag(counts: DataFrame) -> DataFrame:
    """Input of the charts split by police flag: a missing unit is ``'000'``."""
    flagged = counts.where(F.col(FLAG).isNotNull()).fillna({UNIT: "000"})
    return flagged.groupBy(TYPE, FLAG, UNIT, "x").agg(F.sum("n").alias("n"))


def _panel_bins(counts: DataFrame, panel: Sequence[str], bin_width: float | None) -> DataFrame:
    """Low edge, number of bins and total of each panel.

    Without a width it is the smaller of the Sturges and Freedman-Diaconis widths, stretched so
    that whole bins cover the range.  A panel with one value gets one bin of width 1 around it.
    """
    quartile = lambda q: F.percentile("x", F.lit(q), F.col("n"))
    stats = counts.groupBy(*panel).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("total"),
        quartile(0.25).alias("q1"), quartile(0.75).alias("q3"),
    )
    span, total = F.col("hi") - F.col("lo"), F.col("total")
    if bin_width is None:
        sturges = span / (F.log2(total.cast("double")) + 1)
        spread = F.lit(2.0) * (F.col("q3") - F.col("q1")) * F.pow(total, F.lit(-1.0 / 3.0))
        width = F.when(spread > 0, F.least(spread, sturges)).otherwise(sturges)
        bins = F.when(span > 0, F.ceil(span / F.nullif(width, F.lit(0.0)))).otherwise(1)
        width = F.when(span > 0, span / bins).otherwise(1.0)
        low = F.when(span > 0, F.col("lo")).otherwise(F.col("lo") - 0.5)
    else:
        bins, width, low = F.greatest(F.ceil(span / bin_width), F.lit(1)), F.lit(bin_width), F.col("lo")
    return stats.select(
        *panel, low.alias("lo"), width.alias("bin_width"), bins.cast("int").alias("n_bins"), "total"
    )


def unit_histogram(
    counts: DataFrame, panel: Sequence[str], curve: Sequence[str], *, bin_width: float | None = None
) -> DataFrame:
    """Density of every bin of every curve, empty bins included.

    Areas of a panel's curves add up to 1.
    """
    edges = _panel_bins(counts, panel, bin_width)
    at = F.floor((F.col("x") - F.col("lo")) / F.col("bin_width")).cast("int")
    filled = (
        counts.join(edges, list(panel))
        .withColumn("bin", F.least(at, F.col("n_bins") - 1))
        .groupBy(*curve, "bin")
        .agg(F.sum("n").alias("n"))
    )
    curves = counts.select(*curve).distinct().join(edges, list(panel))
    every_bin = curves.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)))
    n = F.coalesce("n", F.lit(0))
    return every_bin.join(filled, [*curve, "bin"], "left").select(
        *curve,
        "bin",
        (F.col("lo") + F.col("bin") * F.col("bin_width")).alias("bin_start"),
        "bin_width",
        n.alias("n"),
        (n / (F.col("total") * F.col("bin_width"))).alias("density"),
    )


def _bandwidth(values: Column) -> Column:
    """Scott's bandwidth: sample deviation times n^(-1/5); null for fewer than two values.

    Deviations are taken about the mean, so equal values in any number have none.
    """
    add = lambda part: F.aggregate(values, F.lit(0.0), lambda total, v: total + part(v))
    n = add(lambda v: v["n"])
    mean = add(lambda v: v["n"] * v["x"]) / n
    variance = add(lambda v: v["n"] * (v["x"] - mean) * (v["x"] - mean)) / (n - 1)
    return F.when(F.size(values) > 1, F.sqrt(variance) * F.pow(n, F.lit(-0.2)))


def unit_kde(
    counts: DataFrame, panel: Sequence[str], curve: Sequence[str], *, points: int = GRID_POINTS
) -> DataFrame:
    """Gaussian kernel density on an even grid over the panel's range.

    Curves with one row or one value have none.  A curve's area is its share of its panel.
    """
    panels = counts.groupBy(*panel).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("total")
    )
    # One entry per value: a caller's counts may hold a value twice.
    merged = counts.groupBy(*curve, "x").agg(F.sum("n").alias("n"))
    curves = merged.groupBy(*curve).agg(
        F.array_sort(F.collect_list(F.struct("x", "n"))).alias("values")  # at most 96 quarter hours
    ).withColumn("h", _bandwidth(F.col("values")))
    grid = curves.where("h is not null").join(panels, list(panel)).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    )
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (points - 1)
    bump = lambda v: v["n"] * F.exp(
        -F.pow((F.col("at") - v["x"]) / F.col("h"), F.lit(2.0)) / 2
    )
    height = F.aggregate(
        F.col("values"), F.lit(0.0), lambda total, v: total + bump(v)
    )
    scale = F.col("total") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    return grid.withColumn("at", at).select(
        *curve, "point", F.col("at").alias("x"), (height / scale).alias("density")
    )


def unit_stats(
    df: DataFrame, *, bin_width: float | None = None
) -> DataFrame:
    """Both charts of every charge type, curves and bins, as one long table.

    Runs one job, which groups the fact table and stores the counts that all charts read.
    """
    counts = materialize(unit_time_counts(df), "unit-times")
    views = {
        "by_unit": (panels_by_unit(counts), *BY_UNIT),
        "by_flag_and_unit": (panels_by_flag(counts), *BY_FLAG_AND_UNIT),
    }
    tables = []
    for view, (rows, panel, curve) in views.items():
        flag = F.col(FLAG) if FLAG in curve else F.lit(None).cast("boolean")
        hist = unit_histogram(rows, panel, curve, bin_width=bin_width).select(
            F.lit(view).alias("chart"), F.lit("hist").alias("kind"), TYPE, flag.alias(FLAG), UNIT,
            F.col("bin").alias("position"), F.col("bin_start").alias("x"), "density",
        )
        kde = unit_kde(rows, panel, curve).select(
            F.lit(view).alias("chart"), F.lit("kde").alias("kind"), TYPE, flag.alias(FLAG), UNIT,
            F.col("point").alias("position"), "x", "density",
        )
        tables += [hist, kde]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
