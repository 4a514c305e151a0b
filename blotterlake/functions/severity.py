"""Charge severity codes and charge types."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from blotterlake.config import SEVERITY_ORDER, UNKNOWN_SEVERITY


def severity_code(charge_class: Column) -> Column:
    """0 for the least severe class up to 13; -1 when missing or unknown."""
    pairs = [F.lit(x) for x in chain(*[(c, i) for i, c in enumerate(SEVERITY_ORDER)])]
    code = F.element_at(F.create_map(*pairs), charge_class)
    return F.coalesce(code, F.lit(UNKNOWN_SEVERITY))


def charge_type(code: Column) -> Column:
    """Bucket a severity code.  Code 0 (the class ``"None"``) has a bucket of its own name."""
    return (
        F.when(code > 7, "Felony")
        .when(code > 4, "Misdemeanor")
        .when(code > 0, "Petty or Other")
        .when(code < 0, "Not Specified")
        .otherwise("None")
    )
