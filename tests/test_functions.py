from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from atmolake.fixed_values import MATRIX_HEADER
from atmolake.functions import bands, casts, text, times


@pytest.mark.parametrize(
    "label, expected",
    [
        ("12:00AM", datetime(2021, 5, 2, 0)),
        ("12:00PM", datetime(2021, 5, 1, 12)),
        ("1:00PM", datetime(2021, 5, 1, 13)),
        ("11:00PM", datetime(2021, 5, 1, 23)),
        ("11:00AM", datetime(2021, 5, 1, 11)),
        ("1:00AM", datetime(2021, 5, 1, 1)),
    ],
)
def test_legacy_hour(one, label, expected):
    day = F.lit(date(2021, 5, 2))
    assert one(times.legacy_hour_to_datetime(day, F.lit(label))) == (expected,)


def test_matrix_header_runs_from_one_to_midnight():
    assert len(MATRIX_HEADER) == 26
    assert MATRIX_HEADER[2] == "1:00AM" and MATRIX_HEADER[13] == "12:00PM" and MATRIX_HEADER[-1] == "12:00AM"


@pytest.mark.parametrize(
    "hhmm, expected", [("0000", "0000"), ("0001", "0100"), ("2300", "2300"), ("2301", "0000"), ("930", None), ("ab00", None)]
)
def test_ceil_to_hour(one, hhmm, expected):
    assert one(times.ceil_to_hour_hhmm(F.lit(hhmm))) == (expected,)


def test_ceil_to_hour_strict_raises(one):
    with pytest.raises(Exception, match="not in HHMM format"):
        one(times.ceil_to_hour_hhmm(F.lit("9:30"), strict=True))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epoch_does_not_depend_on_the_session_zone(spark, one, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(
            times.epoch_to_local(F.lit(1704067200)).cast("string"),
            times.epoch_to_local(F.lit(1704067200500)).cast("string"),
            times.epoch_to_local(F.lit(1704067200), "UTC").cast("string"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ("2024-01-01 08:00:00", "2024-01-01 08:00:00.5", "2024-01-01 00:00:00")


def test_dates(one):
    assert one(
        times.yyyymmdd_to_iso(F.lit("20240229")),
        times.parse_yyyymmdd(F.lit("20240229")),
        times.parse_iso_datetime(F.lit("2024-11-01T05:06:07")),
        times.local_day(datetime(2024, 1, 1, 15, 59), 1),
        times.local_day(datetime(2024, 1, 1, 16, 0), 1),
        times.local_day(datetime(2024, 1, 1, 16, 0), 0),
    ) == (
        "2024-02-29", date(2024, 2, 29), datetime(2024, 11, 1, 5, 6, 7), date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 2),
    )


@pytest.mark.parametrize(
    "raw, as_double, as_bigint, rounded",
    [
        ("12", 12.0, 12, 12), (" 12 ", 12.0, 12, 12), ("3.7", 3.7, None, 4), ("2.5", 2.5, None, 3), ("-2.5", -2.5, None, -3),
        ("nan", None, None, None), ("NaN", None, None, None), ("nAn", None, None, None), ("None", None, None, None),
        ("", None, None, None), ("x", None, None, None), (None, None, None, None), ("180.0", 180.0, None, 180),
        ("-7", -7.0, -7, -7), ("1e3", 1000.0, None, 1000),
    ],
)
def test_safe_casts(one, raw, as_double, as_bigint, rounded):
    column = F.lit(raw).cast("string")
    assert one(casts.safe_double(column), casts.safe_bigint(column), casts.round_bigint(column)) == (
        as_double, as_bigint, rounded,
    )


def test_strict_casts_raise(one):
    for bad in (casts.to_datetime(F.lit("at noon")), casts.numeric(F.lit("1a"))):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            one(bad)


def test_round_exact_is_rounding_of_the_binary_value(spark):
    draw = random.Random(7)
    values = [draw.randrange(-(10**7), 10**7) / 8000 for _ in range(3000)]
    values += [draw.uniform(-2000, 2000) for _ in range(1000)] + [0.0005, 0.0625, 2.5, 8.0925, -0.0625]
    df = spark.createDataFrame([(v, round(v, 3)) for v in values], "v double, expected double")
    assert df.filter(casts.round_exact(F.col("v"), 3) != F.col("expected")).count() == 0


@pytest.mark.parametrize(
    "value, label",
    [
        (0, "Good"), (49.999, "Good"), (50, "Moderate"), (99, "Moderate"), (100, "Unhealthy for sensitive groups"),
        (149, "Unhealthy for sensitive groups"), (150, "Unhealthy"), (199, "Unhealthy"), (200, "Very unhealthy"),
        (299, "Very unhealthy"), (300, "Hazardous"), (9999, "Hazardous"), (None, "Hazardous"), (-1, "Good"),
    ],
)
def test_aqi_band(one, value, label):
    assert one(bands.aqi_band(F.lit(value).cast("decimal(38,9)"))) == (label,)


@pytest.mark.parametrize(
    "value, label",
    [
        (-0.1, None), (0, "low"), (2, "low"), (2.1, "moderate"), (5, "moderate"), (5.5, "high"), (7, "high"),
        (7.1, "very high"), (10, "very high"), (10.5, "extreme"), (20, "extreme"), (20.1, None), (None, None),
    ],
)
def test_uv_band(one, value, label):
    assert one(bands.uv_band(F.lit(value).cast("double"))) == (label,)


def test_blend(one):
    def number(value):
        return F.lit(value).cast("double")

    assert one(*[bands.blend(number(a), number(b)) for a, b in [(1, 4), (None, 4), (1, None), (None, None)]]) == (
        2.5, 4.0, 1.0, None,
    )


@pytest.mark.parametrize(
    "token, expected",
    [
        ("58**", ("PM2.5", "ug/m3", 58)), ("7*", ("PM10", "ug/m3", 7)), ("12a", ("SO2", "ppm", 12)), ("1b", ("NO2", "ppm", 1)),
        ("2c", ("O3", "ppm", 2)), ("3d", ("CO", "ppm", 3)), ("101&", ("multi-pollutant", None, 101)),
        ("44", ("unknown", None, 44)), ("N/A", (None, None, None)),
    ],
)
def test_pollutant_token(one, token, expected):
    assert tuple(one(text.pollutant_token(F.lit(token)))[0]) == expected


def test_text(one):
    assert one(
        text.first_segment(F.lit("Kota, Negeri, X"), ","),
        text.first_segment(F.lit("Kota"), ","),
        text.strip_trailing_digits_and_brackets(F.lit("Airport 2[12]")),
        text.strip_trailing_digits_and_brackets(F.lit("Airport[a]")),
        text.digits_only(F.lit("58.0**")),
        text.without_digits(F.lit("58.0**")),
        text.default_symbol(F.lit("")),
        text.default_symbol(F.lit(None).cast("string")),
        text.same_text(F.lit("NoNe"), "none"),
        text.plain_spaces(F.lit("a b")),
        text.plain_primes(F.lit("3°5′")),
    ) == ("Kota", "Kota", "Airport ", "Airport[a", "580", ".**", "-", None, True, "a b", "3°5'")
