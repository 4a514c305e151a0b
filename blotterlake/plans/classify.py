"""Charge classification: exact lookup, fuzzy lookup, prefix rules, Naive Bayes.

All stages work on the table of *distinct* descriptions with their row counts, stored once.  A
description that fills a third of the fact table is one row there, so no stage sees its skew.
The fact table is read twice: to count descriptions and to write the results back.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotterlake.config import Settings
from blotterlake.functions.keys import holdout_bucket
from blotterlake.operators import bayes
from blotterlake.operators.fuzzy import fuzzy_match
from blotterlake.operators.lookups import attach_resolved, dedupe_lookup, unmapped, unpivot_charges
from blotterlake.operators.quality import (
    accuracy, binary_confusion, confusion_cells, confusion_matrix, confusion_pairs,
)
from blotterlake.operators.rules import apply_rules
from blotterlake.operators.stemming import clean_texts
from blotterlake.session import materialize
from blotterlake.sources.tables import (
    publish_table, read_or_build, read_table, write_matrix_csv, write_shared_csv,
)
from blotterlake.sources.versions import publish


def describe(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(description, n_slot_1.., n_train, n_test): distinct descriptions and their row counts.

    Training counts are of slot 1 only.
    """
    split_key = settings.id_col if settings.split_on == "row" else "description"
    train = holdout_bucket(F.col(split_key), seed=settings.split_seed) < 7
    first = F.col("slot") == 1
    slots = [F.count_if(F.col("slot") == i).alias(f"n_slot_{i}") for i in settings.slot_numbers]
    return unpivot_charges(df, settings).groupBy("description").agg(
        *slots,
        F.count_if(first & train).alias("n_train"),
        F.count_if(first & ~train).alias("n_test"),
    )


def crosswalk_values(crosswalk: DataFrame) -> DataFrame:
    """(description, micro, police), one row per crosswalk description."""
    micro = dedupe_lookup(crosswalk, "description", "micro_category")
    police = dedupe_lookup(crosswalk, "description", "police_related")
    return micro.join(police, "description").toDF("description", "micro", "police")


def macro_values(crosswalk: DataFrame) -> DataFrame:
    """(micro, macro), one row per micro category."""
    return dedupe_lookup(crosswalk, "micro_category", "macro_category").toDF("micro", "macro")


def direct_stage(descriptions: DataFrame, values: DataFrame) -> DataFrame:
    """Exact match of the description."""
    return descriptions.join(values, "description", "left")


def fuzzy_stage(matched: DataFrame, values: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fill what is still null from the nearest crosswalk description; adds the match itself.

    One match serves both values: the two maps have the same keys.
    """
    open_rows = matched.where(
        unmapped(F.col("description"), F.col("micro")) | unmapped(F.col("description"), F.col("police"))
    )
    near = fuzzy_match(
        open_rows.select("description"),
        values.select("description"),
        max_distance=settings.max_edit_distance,
        metric=settings.edit_metric,
    ).toDF("description", "proxy", "distance")
    proxy_values = values.toDF("proxy", "proxy_micro", "proxy_police")
    near = near.join(proxy_values, "proxy", "left")
    return matched.join(near, "description", "left").withColumns(
        {
            "micro_method": F.when(F.col("micro").isNotNull(), "direct").when(
                F.col("proxy_micro").isNotNull(), "fuzzy"
            ),
            "police_method": F.when(F.col("police").isNotNull(), "direct").when(
                F.col("proxy_police").isNotNull(), "fuzzy"
            ),
            "micro": F.coalesce("micro", "proxy_micro"),
            "police": F.coalesce("police", "proxy_police"),
        }
    ).drop("proxy_micro", "proxy_police")


def rule_stage(matched: DataFrame, macros: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Prefix rules where micro is null.  Macro is looked up from micro before the rules."""
    ruled = apply_rules(matched.join(macros, "micro", "left"), settings.rules)
    method = F.when(F.col("micro_method").isNull() & F.col("micro").isNotNull(), "rule")
    return ruled.withColumn("micro_method", F.coalesce("micro_method", method))


class Evaluation(NamedTuple):
    """Hold-out quality of one classifier."""

    accuracy: DataFrame
    confusion: DataFrame


class Classification(NamedTuple):
    resolved: DataFrame
    micro_model: bayes.NaiveBayesModel
    police_model: bayes.NaiveBayesModel
    micro_evaluation: Evaluation
    police_evaluation: Evaluation


def _train(known: DataFrame, label: str, settings: Settings, model_path: str | None, overwrite: bool):
    """Stored model if there is one, else fit; then hold-out predictions of the known rows."""
    spark = known.sparkSession
    weight = "n_train + n_test" if settings.refit_full else "n_train"

    def build(weights: str) -> bayes.NaiveBayesModel:
        rows = known.withColumn("__n", F.expr(weights)).where("__n > 0")
        return bayes.fit(rows, "text", label, weight_col="__n", alpha=settings.nb_alpha)

    if model_path is None:
        model = build(weight)
    else:
        if overwrite or not bayes.is_saved(spark, model_path):
            bayes.save(build(weight), model_path)
        model = bayes.load(spark, model_path)
    judged = build("n_train") if settings.refit_full else model
    holdout = known.where("n_test > 0").select("description", "text", "n_test", F.col(label).alias("label"))
    said = bayes.predict(judged, holdout, "description", "text")
    tested = holdout.join(said, "description")
    return model, tested


def resolve(
    descriptions: DataFrame,
    crosswalk: DataFrame,
    settings: Settings = Settings(),
    *,
    model_folder: str | None = None,
    overwrite: bool = False,
) -> Classification:
    """Resolve every description to micro, macro and police flag, with the method of each.

    ``descriptions`` comes from ``describe`` and should be stored.  Runs jobs: the cascade up to
    the rules is stored, and each classifier is fitted.
    """
    folder = lambda name: f"{model_folder}/{name}" if model_folder else None
    values = crosswalk_values(crosswalk)
    macros = macro_values(crosswalk)
    matched = fuzzy_stage(direct_stage(descriptions, values), values, settings)
    matched = rule_stage(matched, macros, settings).drop("macro")
    texts = clean_texts(matched, "description", stem=settings.stem, broadcast_bytes=settings.broadcast_bytes)
    matched = materialize(texts, "cascade")

    def fill(table: DataFrame, label: str, model: bayes.NaiveBayesModel, as_value) -> DataFrame:
        open_rows = table.where(F.col(label).isNull()).select("description", "text")
        said = bayes.predict(model, open_rows, "description", "text", output_col="said")
        filled = table.join(said.select("description", "said"), "description", "left")
        value = as_value(F.col("said"))
        method = F.when(F.col(label).isNull() & value.isNotNull(), "nlp")
        return filled.withColumns(
            {
                f"{label}_method": F.coalesce(f"{label}_method", method),
                label: F.coalesce(F.col(label), value),
            }
        ).drop("said")

    trained = matched.where("n_train + n_test > 0 and micro is not null")
    micro_model, micro_tested = _train(trained, "micro", settings, folder("micro"), overwrite)
    # The flag classifier learns from exact and fuzzy matches: rules set no flag.
    flagged = matched.where("n_train + n_test > 0 and police is not null")
    flagged = flagged.withColumn("police", F.col("police").cast("int"))
    police_model, police_tested = _train(flagged, "police", settings, folder("police"), overwrite)

    resolved = fill(matched, "micro", micro_model, lambda said: said)
    resolved = fill(resolved, "police", police_model, lambda said: said != 0)
    resolved = resolved.join(macros, "micro", "left").drop("text")
    counts = [c for c in resolved.columns if c.startswith("n_")]
    resolved = resolved.select(
        "description", "micro", "macro", "police", "micro_method", "police_method",
        "proxy", "distance", *counts,
    )

    def evaluation(tested: DataFrame, matrix) -> Evaluation:
        return Evaluation(accuracy(tested, weight_col="n_test"), matrix(tested, weight_col="n_test"))

    return Classification(
        resolved,
        micro_model,
        police_model,
        evaluation(micro_tested, confusion_pairs),
        evaluation(police_tested, binary_confusion),
    )


def classify(
    df: DataFrame,
    crosswalk: DataFrame,
    settings: Settings = Settings(),
    *,
    model_folder: str | None = None,
    overwrite: bool = False,
) -> tuple[DataFrame, Classification]:
    """Add micro, macro and police columns for every charge slot."""
    descriptions = materialize(describe(df, settings), "descriptions")
    result = resolve(descriptions, crosswalk, settings, model_folder=model_folder, overwrite=overwrite)
    result = result._replace(resolved=materialize(result.resolved, "resolved"))
    return attach_resolved(df, result.resolved, settings), result


def store_evaluation(result: Classification, folder: str) -> None:
    """Hold-out quality of both classifiers below ``folder``: accuracies as tables, the micro matrix as a
    labelled CSV, the police matrix as a table of four counts.  Each replaces the earlier one when it is whole."""
    spark = result.resolved.sparkSession
    for name, found in (("micro", result.micro_evaluation), ("police", result.police_evaluation)):
        publish_table(found.accuracy, f"{folder}/{name}_accuracy")
    matrix = confusion_matrix(confusion_cells(materialize(result.micro_evaluation.confusion, "confusion")))
    publish(spark, f"{folder}/micro_confusion", lambda path: write_matrix_csv(matrix, path))
    publish_table(result.police_evaluation.confusion, f"{folder}/police_confusion")


def run_classify(
    spark: SparkSession,
    prepared: DataFrame | str,
    crosswalk: DataFrame,
    output: str,
    settings: Settings = Settings(),
    *,
    shared_csv: str | None = None,
    model_folder: str | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """The stored classified table, or classify the prepared table (or its path) and store it.

    With a ``model_folder`` the models and their hold-out quality (``store_evaluation``) are stored there.
    """

    def build() -> DataFrame:
        df = read_table(spark, prepared) if isinstance(prepared, str) else prepared
        table, result = classify(df, crosswalk, settings, model_folder=model_folder, overwrite=overwrite)
        if model_folder is not None:
            store_evaluation(result, f"{model_folder}/evaluation")
        return table

    classified = read_or_build(
        spark, output, build, overwrite=overwrite, partition_by=("arrest_year",)
    )
    if shared_csv is not None:
        write_shared_csv(classified, shared_csv)
    return classified
