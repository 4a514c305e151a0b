"""Coverage and classification quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blotterlake.config import Settings


def coverage_report(resolved: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Descriptions mapped by each method, per slot, and those still unmapped.

    Works on the description table, whose ``n_slot_{i}`` columns carry the fact-table counts.
    """
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.col(f"n_slot_{i}").alias("n"))
            for i in settings.slot_numbers
        ]
    )
    targets = F.array(
        F.struct(F.lit("micro").alias("target"), F.col("micro_method").alias("method")),
        F.struct(F.lit("police").alias("target"), F.col("police_method").alias("method")),
    )
    rows = resolved.select(F.explode(slots).alias("s"), targets.alias("targets"))
    rows = rows.select("s.*", F.explode("targets").alias("t")).where("n > 0")
    method = F.coalesce("t.method", F.lit("unmapped"))
    return rows.groupBy("slot", F.col("t.target").alias("target"), method.alias("method")).agg(
        F.sum("n").alias("n")
    )


def _weight(weight_col: str | None) -> Column:
    return F.col(weight_col) if weight_col else F.lit(1)


def accuracy(
    df: DataFrame, label: str = "label", prediction: str = "prediction", *, weight_col: str | None = None
) -> DataFrame:
    """Share of (weighted) rows whose prediction is the label."""
    weight = _weight(weight_col)
    right = F.sum(F.when(F.col(label) == F.col(prediction), weight).otherwise(0))
    return df.agg(
        right.cast("bigint").alias("n_correct"),
        F.sum(weight).cast("bigint").alias("n"),
        (right / F.sum(weight)).alias("accuracy"),
    )


def confusion_pairs(
    df: DataFrame, label: str = "label", prediction: str = "prediction", *, weight_col: str | None = None
) -> DataFrame:
    """Long form: (label, prediction, n), cells that occur."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.sum(_weight(weight_col)).cast("bigint").alias("n")
    )


def confusion_cells(pairs: DataFrame) -> DataFrame:
    """Long form of the full matrix: a cell for every two labels observed, zeros included.

    A label is observed as a label or as a prediction, so no row of ``pairs`` is left out.
    """
    labels = pairs.select(F.explode(F.array("label", "prediction")).alias("label")).distinct()
    every = labels.agg(F.collect_set("label").alias("labels"))
    cells = every.select(F.explode("labels").alias("label"), "labels").select(
        "label", F.explode("labels").alias("prediction")
    )
    filled = cells.join(pairs, ["label", "prediction"], "left")
    return filled.select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_matrix(cells: DataFrame) -> DataFrame:
    """Wide form of ``confusion_cells``: a row and a column for every label."""
    return cells.groupBy("label").pivot("prediction").agg(F.first("n")).orderBy("label")


def binary_confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", *, weight_col: str | None = None
) -> DataFrame:
    """tn, fp, fn and tp of two 0/1 columns."""
    weight = _weight(weight_col)

    def cell(truth: int, said: int) -> Column:
        hit = (F.col(label) == truth) & (F.col(prediction) == said)
        return F.coalesce(F.sum(F.when(hit, weight)), F.lit(0)).cast("bigint")

    return df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )
