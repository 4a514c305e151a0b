"""Text keys made from numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zero_fill(text: Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer text is kept whole (bare ``lpad`` cuts it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def number_key(number: Column, width: int = 0) -> Column:
    """Nullable number to text key: null and NaN become 0, fractions are cut, then zero-filled."""
    known = F.when(~F.isnan(number.cast("double")), number)
    text = F.coalesce(known, F.lit(0)).cast("bigint").cast("string")
    return zero_fill(text, width) if width else text


def holdout_bucket(*keys: Column, seed: int = 0) -> Column:
    """Bucket 0 to 9 from a hash of the key: the same in every layout and on every run."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10).cast("int")
