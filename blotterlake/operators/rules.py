"""Manual prefix rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def rule_value(description: Column, rules: Sequence[tuple[str, str, str]], part: int) -> Column:
    """Micro (``part=1``) or macro (``part=2``) of the first rule whose prefix matches."""
    value = F.lit(None).cast("string")
    for rule in reversed(rules):
        value = F.when(description.startswith(rule[0]), rule[part]).otherwise(value)
    return value


def apply_rules(
    df,
    rules: Sequence[tuple[str, str, str]],
    *,
    description_col: str = "description",
    micro_col: str = "micro",
    macro_col: str = "macro",
):
    """Fill micro and macro, each where still null, from the first matching rule."""
    text = F.col(description_col)
    return df.withColumns(
        {
            micro_col: F.coalesce(F.col(micro_col), rule_value(text, rules, 1)),
            macro_col: F.coalesce(F.col(macro_col), rule_value(text, rules, 2)),
        }
    )
