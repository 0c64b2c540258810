"""Casts from the all-text bronze layer. Column in, Column out, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atmolake.fixed_values import MISSING_TEXTS

# A cast that fails costs an exception inside the task, some ten times the cast itself. So the
# texts that are known to fail often are told apart first; the result is the same.


def safe_double(text: Column) -> Column:
    """Text to DOUBLE; bad text and the text "nan" give NULL."""
    # A NaN would pass every lower bound and then poison each average it meets.
    number = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    return F.when(~text.isin(MISSING_TEXTS), number)


def safe_bigint(text: Column) -> Column:
    """Text to BIGINT; anything that is not a whole number in text gives NULL, also "3.7"."""
    return F.when(~(text.isin(MISSING_TEXTS) | text.contains(".")), text.try_cast("bigint"))


def round_bigint(text: Column) -> Column:
    """Text to BIGINT by way of DOUBLE, rounding half away from zero."""
    return F.round(safe_double(text)).try_cast("bigint")


def apart(value: Column) -> Column:
    """The same value by way of a higher-order function, for one column of a wide projection.

    Spark compiles such a projection column by column. Without it all columns become one method, which from some twenty on
    is too long for the JIT compiler and stays interpreted, whatever the settings of the session that runs the plan.
    """
    return F.get(F.transform(F.array(value), lambda x: x), F.lit(0))


def to_datetime(text: Column) -> Column:
    """Text to a zone-less timestamp; bad text raises under ANSI mode."""
    return text.cast("timestamp_ntz")


def numeric(text: Column) -> Column:
    """Text to a fixed-point number with nine decimals; bad text raises under ANSI mode."""
    return text.cast("decimal(38,9)")


def none_text_to_null(text: Column) -> Column:
    """NULL where the text is the word "none" in any case."""
    return F.when(F.lower(text) != "none", text)


def round_exact(value: Column, places: int) -> Column:
    """Round the exact binary value of a DOUBLE, ties to even.

    `F.round` rounds the shortest decimal text of a double instead, so that 8.0925, in binary a
    little less than that, would become 8.093. The scaled value and the error of scaling it are
    exact here, and the error decides what looks like a tie.
    """
    scale = 10.0**places
    scaled = value * scale
    high = value * 134217729.0 - (value * 134217729.0 - value)
    error = (high * scale - scaled) + (value - high) * scale
    below = F.floor(scaled)
    tie = F.when(error > 0, below + 1).when(error < 0, below).otherwise(F.rint(scaled))
    nearest = F.when(scaled - below == 0.5, tie).otherwise(F.rint(scaled))
    return nearest.cast("double") / scale
