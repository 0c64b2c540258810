"""Bronze text to typed, masked rows. Each model is one narrow projection over the scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.fixed_values import PWS_DENIED, PWS_RANGES, UNIDENTIFIED, WEATHER_NONE_TEXT, WEATHER_RANGES, ValidRange
from atmolake.functions.bands import keep_valid
from atmolake.functions.casts import (
    apart,
    none_text_to_null,
    numeric,
    round_bigint,
    safe_bigint,
    safe_double,
    to_datetime,
)
from atmolake.functions.text import default_symbol, digits_only, without_digits


def mask_ranges(df: DataFrame, ranges: Mapping[str, ValidRange]) -> DataFrame:
    """NULL for measures outside their valid range; the row stays."""
    return df.withColumns({name: keep_valid(F.col(name), valid) for name, valid in ranges.items()})


def mask_denied_stations(df: DataFrame, denied: Mapping[str, list[str]], station: str = "weather_station") -> DataFrame:
    """NULL for a measure of the stations whose sensor for it is broken."""
    return df.withColumns(
        {
            name: F.when(F.col(station).isin(stations), None).otherwise(F.col(name))
            for name, stations in denied.items()
        }
    )


def none_texts_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({name: none_text_to_null(F.col(name)) for name in columns})


def valid_rows(df: DataFrame, datetime: str = "datetime", station: str = "weather_station") -> DataFrame:
    """Rows with a time and an identified station."""
    return df.filter(F.col(datetime).isNotNull() & (F.col(station) != UNIDENTIFIED))


def split_reading(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the digits of a reading as `pollutant_value` and the rest as `pollutant_symbol`."""
    return df.withColumns(
        {"pollutant_value": digits_only(F.col(value)), "pollutant_symbol": without_digits(F.col(value))}
    )


def stage_air_quality(bronze: DataFrame, rows: int | None = None) -> DataFrame:
    """Distinct readings with a number, as `(datetime, location, pollutant_value, pollutant_symbol)`.

    A test run takes so many `rows` of the distinct readings.
    """
    # Rows without digits go before the shuffle of the DISTINCT; copies are combined map-side.
    readings = bronze.select("datetime", "location", "value").filter(F.col("value").rlike("[0-9]")).distinct()
    if rows is not None:
        readings = readings.limit(rows)
    return split_reading(readings).select(
        to_datetime(F.col("datetime")).alias("datetime"),
        "location",
        numeric(F.col("pollutant_value")).alias("pollutant_value"),
        default_symbol(F.col("pollutant_symbol")).alias("pollutant_symbol"),
    )


_WEATHER_DOUBLES = [
    "dew_point", "min_temperature", "max_temperature", "feels_like_temperature", "temperature",
    "pressure_tend", "pressure", "wind_chill",
]
_WEATHER_BIGINTS = ["visibility", "wind_speed", "gust", "relative_humidity", "heat_index", "uv_index"]
STAGED_WEATHER = [
    "datetime", "weather_station", "observation_place", "visibility", "day_indicator", "dew_point",
    "min_temperature", "max_temperature", "feels_like_temperature", "temperature", "pressure_desc",
    "pressure_tend", "pressure", "wind_speed", "gust", "relative_humidity", "heat_index",
    "wind_direction_dir", "wind_direction_degree", "wind_chill", "clouds", "weather_phrase", "uv_index",
    "uv_description",
]
_PWS_DOUBLES = {
    "solar_radiation": "solar_radiation_high",
    "humidity": "humidity",
    "dew_point": "dew_point",
    "temperature": "temperature",
    "pressure_tend": "pressure_trend",
    "pressure": "pressure",
    "wind_speed": "wind_speed",
    "gust": "gust",
    "heat_index": "heat_index",
    "wind_chill": "wind_chill",
    "precipitation_rate": "precipitation_rate",
    "precipitation_total": "precipitation_total",
}
STAGED_PWS = [
    "datetime", "weather_station", "solar_radiation", "humidity", "dew_point", "temperature", "pressure_tend",
    "pressure", "wind_speed", "gust", "heat_index", "wind_direction_degree", "wind_chill", "uv_index",
    "precipitation_rate", "precipitation_total",
]


def _number(text: Column, name: str) -> Column:
    """A measure as a number. Temperature, which all models read, keeps the wide projections in short methods."""
    return (apart(safe_double(text)) if name == "temperature" else safe_double(text)).alias(name)


def stage_weather(bronze: DataFrame) -> DataFrame:
    """Station weather, 24 columns."""
    typed = bronze.select(
        to_datetime(F.col("datetime")).alias("datetime"),
        "weather_station",
        "observation_place",
        "day_indicator",
        *WEATHER_NONE_TEXT,
        *[_number(F.col(name), name) for name in _WEATHER_DOUBLES],
        *[safe_bigint(F.col(name)).alias(name) for name in _WEATHER_BIGINTS],
        safe_bigint(F.col("wind_direction_deg")).alias("wind_direction_degree"),
    )
    return none_texts_to_null(mask_ranges(valid_rows(typed), WEATHER_RANGES), WEATHER_NONE_TEXT).select(
        *STAGED_WEATHER
    )


def stage_pws(bronze: DataFrame) -> DataFrame:
    """Personal-station weather, 16 columns."""
    typed = bronze.select(
        to_datetime(F.col("datetime")).alias("datetime"),
        "weather_station",
        *[_number(F.col(text), name) for name, text in _PWS_DOUBLES.items()],
        safe_bigint(F.col("wind_direction")).alias("wind_direction_degree"),
        round_bigint(F.col("uv")).alias("uv_index"),
    )
    return mask_denied_stations(mask_ranges(valid_rows(typed), PWS_RANGES), PWS_DENIED).select(*STAGED_PWS)
