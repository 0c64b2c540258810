"""Queries of the staging models and of their building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from atmolake.fixed_values import PWS_DENIED, PWS_RANGES, WEATHER_NONE_TEXT
from atmolake.functions import casts, text
from atmolake.operators import staging
from atmolake.registry import inputs
from atmolake.registry.base import CTES, query, read
from atmolake.sources.tables import test_run_limit as first_rows_for_test_run


def _double(column: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({column} AS DOUBLE)) THEN TRY_CAST({column} AS DOUBLE) END"


def _bigint(column: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({column}), '[+-]?[0-9]+') THEN TRY_CAST({column} AS BIGINT) END"


CTES["stg_air_quality_rows"] = """
SELECT CAST(datetime AS TIMESTAMP) AS datetime, location,
       CAST(regexp_replace(value, '[^0-9]', '', 'g') AS DOUBLE) AS pollutant_value,
       CASE regexp_replace(value, '[0-9]', '', 'g') WHEN '' THEN '-' ELSE regexp_replace(value, '[0-9]', '', 'g')
       END AS pollutant_symbol
FROM (SELECT DISTINCT datetime, location, value FROM hourly_air_quality)
WHERE regexp_replace(value, '[^0-9]', '', 'g') <> ''"""

# Column, lowest and highest value (None: no bound), and whether the bounds themselves are outside.
_WEATHER_VALID = [
    ("dew_point", 0, 45, True), ("feels_like_temperature", 0, 45, True), ("gust", 0, None, False), ("heat_index", 0, 45, True),
    ("max_temperature", 0, 42, True), ("min_temperature", 0, 42, True), ("pressure", 850, 1090, False), ("pressure_tend", 0, None, False),
    ("relative_humidity", 0, 100, False), ("temperature", 0, 42, True), ("uv_index", 0, None, False), ("wind_chill", 0, 45, True),
    ("wind_direction_degree", 0, 359, False), ("wind_speed", 0, None, False),
]
_PWS_VALID = [
    ("dew_point", 0, 45, True), ("gust", 0, None, False), ("heat_index", 0, 45, True), ("humidity", 0, 100, False),
    ("precipitation_rate", 0, None, False), ("precipitation_total", 0, None, False), ("pressure", 850, 1090, False),
    ("pressure_tend", 0, None, False), ("solar_radiation", 0, None, False), ("temperature", 0, 42, True), ("uv_index", 0, None, False),
    ("wind_chill", 0, 45, True), ("wind_direction_degree", 0, 359, False), ("wind_speed", 0, None, False),
]
# Stations whose sensor is broken.
_BROKEN = [
    ("gust", "ISELANGO11"), ("gust", "ISELANGO6"), ("humidity", "ISELAN1"), ("uv_index", "IPEKAN1"), ("uv_index", "IPETAL1"),
    ("uv_index", "ISELANGO11"), ("wind_speed", "IPETAL1"), ("wind_speed", "ISELANGO11"), ("wind_speed", "ISELANGO6"),
]
_WORDS = ["clouds", "pressure_desc", "uv_description", "weather_phrase", "wind_direction_dir"]
_WHOLE = {"gust", "heat_index", "relative_humidity", "uv_index", "visibility", "wind_direction_degree", "wind_speed"}
_RENAMED = {"wind_direction_degree": "wind_direction_deg"}
_PWS_RENAMED = {"solar_radiation": "solar_radiation_high", "pressure_tend": "pressure_trend"}


def _kept(column: str, low: float, high: float | None, outside: bool, given: str = "") -> str:
    """A measure where it is valid, else NULL."""
    low_sign, high_sign = (">", "<") if outside else (">=", "<=")
    valid = f"{column} {low_sign} {low}" + (f" AND {column} {high_sign} {high}" if high is not None else "")
    return f"CASE WHEN {given}{valid} THEN {column} END AS {column}"


def _given(column: str) -> str:
    stations = [f"'{station}'" for name, station in _BROKEN if name == column]
    return f"weather_station NOT IN ({', '.join(stations)}) AND " if stations else ""


def _typed(names: list[str], renamed: dict[str, str]) -> str:
    return ", ".join(f"{(_bigint if name in _WHOLE else _double)(renamed.get(name, name))} AS {name}" for name in names)


CTES["typed_weather"] = f"""
SELECT CAST(datetime AS TIMESTAMP) AS datetime, weather_station, observation_place, day_indicator, {", ".join(_WORDS)},
       {_typed(["visibility", *[rule[0] for rule in _WEATHER_VALID]], _RENAMED)}
FROM hourly_weather"""

CTES["stg_weather_rows"] = f"""
SELECT datetime, weather_station, observation_place, visibility, day_indicator,
       {", ".join(_kept(*rule) for rule in _WEATHER_VALID)},
       {", ".join(f"CASE WHEN lower({name}) <> 'none' THEN {name} END AS {name}" for name in _WORDS)}
FROM typed_weather WHERE datetime IS NOT NULL AND weather_station <> 'Unidentified'"""

CTES["typed_pws"] = f"""
SELECT CAST(datetime AS TIMESTAMP) AS datetime, weather_station, {_bigint("wind_direction")} AS wind_direction_degree,
       TRY_CAST(round({_double("uv")}) AS BIGINT) AS uv_index,
       {", ".join(f"{_double(_PWS_RENAMED.get(name, name))} AS {name}" for name, *_ in _PWS_VALID if name not in ("uv_index", "wind_direction_degree"))}
FROM hourly_pws_weather"""

CTES["stg_pws_rows"] = f"""
SELECT datetime, weather_station, {", ".join(_kept(*rule, _given(rule[0])) for rule in _PWS_VALID)}
FROM typed_pws WHERE datetime IS NOT NULL AND weather_station <> 'Unidentified'"""


@query("SELECT * FROM stg_air_quality_rows")
def stg_air_quality(spark, sf_dir):
    staged = staging.stage_air_quality(inputs.hourly_air_quality(spark, sf_dir))
    return staged.withColumn("pollutant_value", F.col("pollutant_value").cast("double"))


@query("SELECT * FROM stg_weather_rows")
def stg_weather(spark, sf_dir):
    return staging.stage_weather(inputs.hourly_weather(spark, sf_dir))


@query("SELECT * FROM stg_pws_rows")
def stg_pws(spark, sf_dir):
    return staging.stage_pws(inputs.hourly_pws_weather(spark, sf_dir))


# --- building blocks: air-quality readings ------------------------------------------------------


@query("SELECT location, value, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM hourly_air_quality")
def extract_digits(spark, sf_dir):
    aq = inputs.hourly_air_quality(spark, sf_dir)
    return aq.select("location", "value", text.digits_only(F.col("value")).alias("digits"))


@query("SELECT location, value, regexp_replace(value, '[0-9]', '', 'g') AS symbol FROM hourly_air_quality")
def extract_symbol(spark, sf_dir):
    aq = inputs.hourly_air_quality(spark, sf_dir)
    return aq.select("location", "value", text.without_digits(F.col("value")).alias("symbol"))


@query("""
SELECT location, digits FROM (SELECT location, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM hourly_air_quality)
WHERE digits IS NOT NULL AND digits <> ''""")
def filter_nonempty(spark, sf_dir):
    aq = inputs.hourly_air_quality(spark, sf_dir)
    return aq.select("location", text.digits_only(F.col("value")).alias("digits")).filter(F.col("digits") != "")


@query("""
SELECT location, CASE WHEN symbol = '' THEN '-' ELSE symbol END AS symbol
FROM (SELECT location, regexp_replace(value, '[0-9]', '', 'g') AS symbol FROM hourly_air_quality)""")
def default_symbol(spark, sf_dir):
    aq = inputs.hourly_air_quality(spark, sf_dir)
    return aq.select("location", text.default_symbol(text.without_digits(F.col("value"))).alias("symbol"))


@query("SELECT event_id, CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(38, 9)) AS VARCHAR) AS amount FROM events")
def numeric_cast(spark, sf_dir):
    amount = casts.numeric(F.col("value").cast("string"))
    return read(spark, sf_dir, "events").select("event_id", amount.cast("string").alias("amount"))


@query("SELECT DISTINCT datetime, location, value FROM hourly_air_quality")
def distinct_rows(spark, sf_dir):
    return inputs.hourly_air_quality(spark, sf_dir).select("datetime", "location", "value").distinct()


# --- building blocks: casts ---------------------------------------------------------------------


@query(f"""
SELECT weather_station, temperature AS raw, {_double("temperature")} AS temperature,
       {_double("pressure_desc")} AS not_a_number FROM hourly_weather""")
def safe_cast_double(spark, sf_dir):
    return inputs.hourly_weather(spark, sf_dir).select(
        "weather_station",
        F.col("temperature").alias("raw"),
        casts.safe_double(F.col("temperature")).alias("temperature"),
        casts.safe_double(F.col("pressure_desc")).alias("not_a_number"),
    )


@query(f"""
SELECT weather_station, wind_speed AS raw, {_bigint("wind_speed")} AS wind_speed, {_bigint("gust")} AS gust
FROM hourly_weather""")
def safe_cast_int(spark, sf_dir):
    return inputs.hourly_weather(spark, sf_dir).select(
        "weather_station",
        F.col("wind_speed").alias("raw"),
        casts.safe_bigint(F.col("wind_speed")).alias("wind_speed"),
        casts.safe_bigint(F.col("gust")).alias("gust"),
    )


@query(f"SELECT weather_station, uv AS raw, TRY_CAST(round({_double('uv')}) AS BIGINT) AS uv_index FROM hourly_pws_weather")
def safe_cast_double_then_int(spark, sf_dir):
    return inputs.hourly_pws_weather(spark, sf_dir).select(
        "weather_station", F.col("uv").alias("raw"), casts.round_bigint(F.col("uv")).alias("uv_index")
    )


@query("SELECT weather_station, CAST(datetime AS TIMESTAMP) AS datetime FROM hourly_weather")
def to_datetime(spark, sf_dir):
    return inputs.hourly_weather(spark, sf_dir).select(
        "weather_station", casts.to_datetime(F.col("datetime")).alias("datetime")
    )


# --- building blocks: masks and filters ---------------------------------------------------------


@query(f"""
SELECT weather_station, {", ".join(f"CASE WHEN lower({name}) <> 'none' THEN {name} END AS {name}" for name in _WORDS)}
FROM hourly_weather""")
def none_text_to_null(spark, sf_dir):
    weather = inputs.hourly_weather(spark, sf_dir).select("weather_station", *WEATHER_NONE_TEXT)
    return staging.none_texts_to_null(weather, WEATHER_NONE_TEXT)


_MASKED = ["humidity", "pressure", "solar_radiation", "temperature", "wind_direction_degree"]


@query(f"""SELECT weather_station, {", ".join(_kept(*rule) for rule in _PWS_VALID if rule[0] in _MASKED)} FROM typed_pws""")
def range_mask(spark, sf_dir):
    pws = inputs.hourly_pws_weather(spark, sf_dir).select(
        "weather_station",
        casts.safe_double(F.col("solar_radiation_high")).alias("solar_radiation"),
        casts.safe_double(F.col("humidity")).alias("humidity"),
        casts.safe_double(F.col("temperature")).alias("temperature"),
        casts.safe_double(F.col("pressure")).alias("pressure"),
        casts.safe_bigint(F.col("wind_direction")).alias("wind_direction_degree"),
    )
    measures = ["solar_radiation", "humidity", "temperature", "pressure", "wind_direction_degree"]
    return staging.mask_ranges(pws, {name: PWS_RANGES[name] for name in measures})


@query(f"""
SELECT weather_station, {", ".join(f"CASE WHEN {_given(name)}true THEN {name} END AS {name}" for name in ("gust", "humidity", "uv_index", "wind_speed"))}
FROM (SELECT weather_station, humidity, wind_speed, gust, uv AS uv_index FROM hourly_pws_weather)""")
def station_denylist_mask(spark, sf_dir):
    pws = inputs.hourly_pws_weather(spark, sf_dir).select(
        "weather_station", "humidity", "wind_speed", "gust", F.col("uv").alias("uv_index")
    )
    return staging.mask_denied_stations(pws, PWS_DENIED)


@query("""
SELECT datetime, weather_station, temperature FROM hourly_weather
WHERE datetime IS NOT NULL AND weather_station <> 'Unidentified'""")
def row_validity_filter(spark, sf_dir):
    weather = inputs.hourly_weather(spark, sf_dir).select("datetime", "weather_station", "temperature")
    return staging.valid_rows(weather)


@query("SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 1000")
def test_run_limit(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "ts", "value")
    return first_rows_for_test_run(events, "ts", "event_id")
