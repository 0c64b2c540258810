from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from atmolake.fixed_values import PWS_DENIED, PWS_RANGES, WEATHER_RANGES
from atmolake.operators import staging
from atmolake.schemas import BRONZE_PWS, BRONZE_WEATHER
from tests.conftest import rows

OPEN_45 = {"-1": None, "0": None, "0.1": 0.1, "44.9": 44.9, "45": None}
OPEN_42 = {"0": None, "0.1": 0.1, "41.9": 41.9, "42": None}
PRESSURE = {"849.9": None, "850": 850.0, "1090": 1090.0, "1090.1": None}
NOT_NEGATIVE = {"-0.1": None, "0": 0.0, "5000": 5000.0}
NOT_NEGATIVE_INT = {"-1": None, "0": 0, "5000": 5000, "3.7": None}
HUNDRED = {"-1": None, "0": 0.0, "100": 100.0, "101": None}
DEGREES = {"-1": None, "0": 0, "359": 359, "360": None}

WEATHER_CASES = {
    "dew_point": ("dew_point", OPEN_45),
    "min_temperature": ("min_temperature", OPEN_42),
    "max_temperature": ("max_temperature", OPEN_42),
    "feels_like_temperature": ("feels_like_temperature", OPEN_45),
    "temperature": ("temperature", OPEN_42),
    "pressure_tend": ("pressure_tend", NOT_NEGATIVE),
    "pressure": ("pressure", PRESSURE),
    "wind_speed": ("wind_speed", NOT_NEGATIVE_INT),
    "gust": ("gust", NOT_NEGATIVE_INT),
    "relative_humidity": ("relative_humidity", {"-1": None, "0": 0, "100": 100, "101": None}),
    "heat_index": ("heat_index", {"0": None, "1": 1, "44": 44, "45": None}),
    "wind_direction_deg": ("wind_direction_degree", DEGREES),
    "wind_chill": ("wind_chill", OPEN_45),
    "uv_index": ("uv_index", NOT_NEGATIVE_INT),
}
PWS_CASES = {
    "solar_radiation_high": ("solar_radiation", NOT_NEGATIVE),
    "humidity": ("humidity", HUNDRED),
    "dew_point": ("dew_point", OPEN_45),
    "temperature": ("temperature", OPEN_42),
    "pressure_trend": ("pressure_tend", NOT_NEGATIVE),
    "pressure": ("pressure", PRESSURE),
    "wind_speed": ("wind_speed", NOT_NEGATIVE),
    "gust": ("gust", NOT_NEGATIVE),
    "heat_index": ("heat_index", OPEN_45),
    "wind_direction": ("wind_direction_degree", DEGREES),
    "wind_chill": ("wind_chill", OPEN_45),
    "uv": ("uv_index", {"-1": None, "-0.4": 0, "0": 0, "2.5": 3, "7.4": 7}),
    "precipitation_rate": ("precipitation_rate", NOT_NEGATIVE),
    "precipitation_total": ("precipitation_total", NOT_NEGATIVE),
}


def bronze(spark, columns, given: list[dict]):
    schema = ", ".join(f"`{name}` string" for name in ["n", *columns])
    base = {"datetime": "2024-01-01 05:00:00", "weather_station": "S1"}
    return spark.createDataFrame(
        [tuple((base | row | {"n": str(i)}).get(name) for name in ["n", *columns]) for i, row in enumerate(given)], schema
    )


def boundary_check(spark, columns, cases, stage):
    """All boundary values of all columns in one run."""
    given = [{column: raw} for column, (_, values) in cases.items() for raw in values]
    expected = [(staged, value) for staged, values in cases.values() for value in values.values()]
    staged = stage(bronze(spark, columns, [row | {"datetime": f"2024-01-01 {i // 60:02}:{i % 60:02}:00"} for i, row in enumerate(given)]))
    result = staged.orderBy("datetime").collect()
    assert len(result) == len(given)
    for row, (column, value), source in zip(result, expected, given):
        assert row[column] == value, (source, row[column])


def test_weather_boundaries(spark):
    assert {staged for staged, _ in WEATHER_CASES.values()} == set(WEATHER_RANGES)
    boundary_check(spark, list(BRONZE_WEATHER), WEATHER_CASES, staging.stage_weather)


def test_pws_boundaries(spark):
    assert {staged for staged, _ in PWS_CASES.values()} == set(PWS_RANGES)
    boundary_check(spark, list(BRONZE_PWS), PWS_CASES, staging.stage_pws)


def test_none_text_and_passthrough(spark):
    df = bronze(
        spark,
        list(BRONZE_WEATHER),
        [{"clouds": "NONE", "pressure_desc": "none", "weather_phrase": "Fair", "uv_description": None,
          "wind_direction_dir": "nOnE", "observation_place": "None", "day_indicator": "D", "visibility": "9"}],
    )
    row = staging.stage_weather(df).first()
    assert (row.clouds, row.pressure_desc, row.weather_phrase, row.uv_description, row.wind_direction_dir) == (
        None, None, "Fair", None, None,
    )
    assert (row.observation_place, row.day_indicator, row.visibility) == ("None", "D", 9)
    assert row.datetime == datetime(2024, 1, 1, 5)
    assert len(row) == 24


def test_rows_without_time_or_station_go(spark):
    given = [{"datetime": None}, {"weather_station": None}, {"weather_station": "Unidentified"}, {}]
    for columns, stage in ((BRONZE_WEATHER, staging.stage_weather), (BRONZE_PWS, staging.stage_pws)):
        assert stage(bronze(spark, list(columns), given)).count() == 1


@pytest.mark.parametrize("station", ["ISELAN1", "ISELANGO11", "ISELANGO6", "IPETAL1", "IPEKAN1", "IOTHER1"])
def test_denied_stations(spark, station):
    df = bronze(
        spark,
        list(BRONZE_PWS),
        [{"weather_station": station, "humidity": "50", "wind_speed": "5", "gust": "6", "uv": "3", "temperature": "30"}],
    )
    row = staging.stage_pws(df).first()
    assert row.temperature == 30
    for column, value in {"humidity": 50, "wind_speed": 5, "gust": 6, "uv_index": 3}.items():
        assert row[column] == (None if station in PWS_DENIED[column] else value)


def test_denied_mask_keeps_rows_without_station(spark):
    df = spark.createDataFrame([(None, 5.0), ("ISELANGO6", 6.0)], "weather_station string, gust double")
    assert rows(staging.mask_denied_stations(df, {"gust": ["ISELANGO6"]})) == [("ISELANGO6", None), (None, 5.0)]


def test_air_quality(spark):
    given = [
        ("2024-01-01 00:00:00", "A", "58**"), ("2024-01-01 00:00:00", "A", "58**"), ("2024-01-01 00:00:00", "A", "60"),
        ("2024-01-01 01:00:00", "B", "N/A"), ("2024-01-01 01:00:00", "B", None), ("2024-01-01 01:00:00", "B", ""),
        ("2024-01-01 02:00:00", "B", "58.0"),
    ]
    staged = staging.stage_air_quality(spark.createDataFrame(given, "datetime string, location string, value string"))
    assert staged.schema["pollutant_value"].dataType.simpleString() == "decimal(38,9)"
    assert rows(staged) == sorted(
        [
            (datetime(2024, 1, 1, 0), "A", Decimal("58.000000000"), "**"),
            (datetime(2024, 1, 1, 0), "A", Decimal("60.000000000"), "-"),
            # Dots are no digits: a decimal reading loses its point. Readings are landed as whole numbers.
            (datetime(2024, 1, 1, 2), "B", Decimal("580.000000000"), "."),
        ],
        key=repr,
    )


def test_staging_has_no_shuffle_and_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, list(BRONZE_WEATHER), [{}]).write.parquet(path)
    df = staging.stage_weather(spark.read.parquet(path)).select("datetime", "weather_station", "temperature")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<datetime:string,weather_station:string,temperature:string>" in plan
    assert "PushedFilters" in plan and "Not(EqualTo(weather_station,Unidentified))" in plan
    assert df.filter(F.col("temperature").isNull()).count() == 1
