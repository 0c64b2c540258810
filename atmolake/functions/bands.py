"""Band labels and validity ranges as CASE expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from atmolake.fixed_values import AQI_BANDS, AQI_TOP_BAND, UV_BANDS, ValidRange


def aqi_band(value: Column) -> Column:
    """Air-quality label of a reading. NULL is not below any bound, so it takes the top band."""
    ladder = reduce(
        lambda case, band: case.when(value < band[0], band[1]),
        AQI_BANDS[1:],
        F.when(value < AQI_BANDS[0][0], AQI_BANDS[0][1]),
    )
    return ladder.otherwise(AQI_TOP_BAND)


def uv_band(value: Column) -> Column:
    """UV exposure category; NULL below zero and above the last band."""
    (first, label), rest = UV_BANDS[0], UV_BANDS[1:]
    return reduce(
        lambda case, band: case.when((value >= 0) & (value <= band[0]), band[1]),
        rest,
        F.when((value >= 0) & (value <= first), label),
    )


def in_range(value: Column, valid: ValidRange) -> Column:
    """Whether a value lies in its valid range; NULL for NULL."""
    test = value > valid.low if valid.low_open else value >= valid.low
    if valid.high is not None:
        test = test & (value < valid.high if valid.high_open else value <= valid.high)
    return test


def keep_valid(value: Column, valid: ValidRange) -> Column:
    """The value if it is valid, else NULL."""
    return F.when(in_range(value, valid), value)


def blend(first: Column, second: Column) -> Column:
    """Mean of two sources; the one that is there if the other is NULL."""
    return F.coalesce((first + second) / 2, first, second)
