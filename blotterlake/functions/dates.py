"""Time-of-day columns.

The arithmetic uses only the minute and second fields, so it gives the same answer for
``timestamp`` and ``timestamp_ntz`` in every session zone whose offset is whole quarter hours.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

QUARTER_US = 15 * 60 * 1_000_000


def _micros_in_hour(ts: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), ts)
    return F.minute(ts).cast("bigint") * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def nearest_quarter(ts: Column) -> Column:
    """Quarter of the hour, 0 to 4, nearest to ``ts``; a tie goes to the even quarter.

    An hour has four quarters, so even within the hour is even since the epoch.
    """
    micros = _micros_in_hour(ts)
    quarter = F.floor(micros / QUARTER_US).cast("int")
    rest = micros % QUARTER_US
    half = QUARTER_US // 2
    up = (rest > half) | ((rest == half) & (quarter % 2 == 1))
    return quarter + F.when(up, 1).otherwise(0)


def round_quarter_hour(ts: Column) -> Column:
    """Timestamp rounded to the nearest 15 minutes, ties to the even quarter."""
    shift = nearest_quarter(ts).cast("bigint") * QUARTER_US - _micros_in_hour(ts)
    seconds = (shift / F.lit(1_000_000)).cast("decimal(18,6)")
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def rounded_minute_fraction(ts: Column) -> Column:
    """Rounded minute as a part of an hour: 0, .25, .5 or .75."""
    return (nearest_quarter(ts) % 4) / F.lit(4.0)


def time_of_day(ts: Column, *, carry_hour: bool = False) -> Column:
    """Hour plus rounded minute fraction.

    By default the hour is the unrounded one, so 10:53 gives 10.0; ``carry_hour`` gives 11.0
    (and 0.0 just before midnight).
    """
    if carry_hour:
        return (F.hour(ts) + nearest_quarter(ts) / F.lit(4.0)) % F.lit(24.0)
    return F.hour(ts) + rounded_minute_fraction(ts)
