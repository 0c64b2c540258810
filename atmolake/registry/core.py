"""Queries of the core models, their blocks and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from atmolake.functions.bands import aqi_band as aqi_label
from atmolake.functions.bands import blend
from atmolake.functions.bands import uv_band as uv_label
from atmolake.operators.lookups import lookup_left
from atmolake.plans import core, marts
from atmolake.plans.models import Models
from atmolake.registry import inputs
from atmolake.registry.base import CTES, query, read
from atmolake.session import scratch_path
from atmolake.sinks import catalog
from atmolake.sinks.materialize import materialize_table

# The SQL of the models, put together from lists of their columns.

# Bands as (from, to, name); the air-quality ones begin at `from`, the UV ones end at `to`.
CTES["aqi_bands"] = """
SELECT * FROM (VALUES (-1e9, 50, 'Good'), (50, 100, 'Moderate'), (100, 150, 'Unhealthy for sensitive groups'),
  (150, 200, 'Unhealthy'), (200, 300, 'Very unhealthy'), (300, 1e9, 'Hazardous')) AS t(from_value, to_value, label)"""
CTES["uv_bands"] = """
SELECT * FROM (VALUES (-1e-9, 2, 'low'), (2, 5, 'moderate'), (5, 7, 'high'), (7, 10, 'very high'), (10, 20, 'extreme'))
  AS t(from_value, to_value, exposure_category)"""

_KEYS = ["datetime", "place", "city", "state"]
_BLENDED = ["dew_point", "gust", "humidity", "pressure", "temperature", "uv_index", "wind_chill", "wind_speed"]
# Measures of one source only, and where each comes from.
_OWN = {
    "feels_like_temperature": "w",
    "pollutant_value": "a",
    "precipitation_rate": "p",
    "precipitation_total": "p",
    "solar_radiation": "p",
    "visibility": "w",
}
_SINGLE = list(_OWN)
_WEATHER = [
    "clouds", "day_indicator", "dew_point", "feels_like_temperature", "gust", "pressure", "relative_humidity", "temperature",
    "uv_index", "visibility", "wind_chill", "wind_direction_degree", "wind_direction_dir", "wind_speed",
]
_PERSONAL = [
    "dew_point", "gust", "heat_index", "humidity", "precipitation_rate", "precipitation_total", "pressure", "solar_radiation",
    "temperature", "uv_index", "wind_chill", "wind_direction_degree", "wind_speed",
]

CTES["locations"] = """
SELECT s.Identifying_Location AS identifying_location, s.Place AS place, cities.City AS city, states.State AS state,
       s.Latitude AS latitude, s.Longitude AS longitude, s.ICAO, s.PWStation
FROM state_locations s LEFT JOIN city_places cities USING (Place) LEFT JOIN city_states states USING (City)"""

CTES["air_quality_rows"] = """
WITH named AS (SELECT r.*, pollutant FROM stg_air_quality_rows r LEFT JOIN indicators ON symbol = pollutant_symbol),
     labelled AS (SELECT named.*, label FROM named LEFT JOIN aqi_bands ON pollutant_value >= from_value AND pollutant_value < to_value)
SELECT datetime, location, place, city, state, pollutant, pollutant_value, label, warning_message AS message
FROM labelled LEFT JOIN warnings USING (pollutant, label) LEFT JOIN locations ON location = identifying_location"""

CTES["weather_rows"] = f"""
SELECT DISTINCT identifying_location AS location, {", ".join(_KEYS + _WEATHER)}
FROM stg_weather_rows LEFT JOIN locations ON ICAO = weather_station"""

CTES["personal_weather_rows"] = f"""
SELECT {", ".join(_KEYS + _PERSONAL)} FROM stg_pws_rows LEFT JOIN locations ON PWStation = weather_station"""


def _averages_sql() -> str:
    """The model as it is defined: two full joins, the second on the keys of air quality, then one grouping."""
    averages = {name: f"{source}.{name}" for name, source in _OWN.items()}
    for name in _BLENDED:
        averages[f"pws_{name}"] = f"p.{name}"
        averages[f"weather_{name}"] = "w.relative_humidity" if name == "humidity" else f"w.{name}"
    keys = [f"coalesce(w.{key}, a.{key}, p.{key}) AS {key}" for key in _KEYS]
    return f"""
SELECT {", ".join(keys)}, {", ".join(f"avg({column}) AS {name}" for name, column in averages.items())}
FROM weather_rows w FULL JOIN air_quality_rows a ON (a.datetime, a.place) = (w.datetime, w.place)
FULL JOIN personal_weather_rows p ON (p.datetime, p.place) = (a.datetime, a.place)
GROUP BY ALL"""


CTES["joined_averages"] = _averages_sql()
CTES["places"] = (
    f"SELECT {', '.join(_KEYS + _SINGLE)}, "
    + ", ".join(f"coalesce((pws_{m} + weather_{m}) / 2, pws_{m}, weather_{m}) AS {m}" for m in _BLENDED)
    + " FROM joined_averages"
)
CTES["uv_rows"] = f"""
SELECT {", ".join(_KEYS)}, uv_index, b.exposure_category, short_description, long_description
FROM places LEFT JOIN uv_bands b ON uv_index > from_value AND uv_index <= to_value LEFT JOIN uv_info USING (exposure_category)"""
CTES["livability_rows"] = """
SELECT CAST(datetime AS DATE) AS day, city, state, avg(pollutant_value) AS pollutant_value, avg(temperature) AS temperature,
       max(uv_index) AS uv_index
FROM places GROUP BY ALL"""

_AVERAGES = [f"pws_{m}" for m in _BLENDED] + [f"weather_{m}" for m in _BLENDED] + _SINGLE


def rounded(df, columns):
    """Round averages for the comparison: engines add up doubles in different orders."""
    return df.withColumns({name: F.round(name, 6) for name in columns})


def rounded_sql(columns):
    return ", ".join(f"round({name}, 6) AS {name}" for name in columns)


def built(spark, sf_dir):
    return Models(inputs.bronze(spark, sf_dir), inputs.seeds(spark, sf_dir))


# --- models -------------------------------------------------------------------------------------


@query("SELECT * FROM locations", "full_locations", "left_join_chain")
def full_locations(spark, sf_dir):
    return built(spark, sf_dir).full_locations


@query("SELECT * FROM air_quality_rows")
def air_quality(spark, sf_dir):
    df = built(spark, sf_dir).air_quality
    return df.withColumn("pollutant_value", F.col("pollutant_value").cast("double"))


@query("SELECT * FROM weather_rows")
def weather(spark, sf_dir):
    return built(spark, sf_dir).weather


@query("SELECT * FROM personal_weather_rows")
def personal_weather(spark, sf_dir):
    return built(spark, sf_dir).personal_weather


@query(f"SELECT datetime, place, city, state, {rounded_sql(_BLENDED + _SINGLE)} FROM places")
def full_weather_places(spark, sf_dir):
    return rounded(built(spark, sf_dir).full_weather_places, _BLENDED + _SINGLE)


@query("SELECT * REPLACE (round(uv_index, 6) AS uv_index) FROM uv_rows")
def uv(spark, sf_dir):
    return rounded(built(spark, sf_dir).uv, ["uv_index"])


@query(f"SELECT day, city, state, {rounded_sql(['pollutant_value', 'temperature', 'uv_index'])} FROM livability_rows")
def livability_score(spark, sf_dir):
    return rounded(built(spark, sf_dir).livability_score, ["pollutant_value", "temperature", "uv_index"])


# --- blocks -------------------------------------------------------------------------------------


@query("SELECT event_id, value, label FROM events LEFT JOIN aqi_bands ON value >= from_value AND value < to_value")
def aqi_band(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", "value", aqi_label(F.col("value")).alias("label"))


@query("""
SELECT event_id, value - 2 AS uv_index, exposure_category
FROM events LEFT JOIN uv_bands ON value - 2 > from_value AND value - 2 <= to_value""")
def uv_band(spark, sf_dir):
    index = F.col("value") - 2
    return read(spark, sf_dir, "events").select(
        "event_id", index.alias("uv_index"), uv_label(index).alias("exposure_category")
    )


@query("""
SELECT day, user_id, round(coalesce((error + click) / 2, error, click), 6) AS blended
FROM (SELECT date_trunc('day', ts) AS day, user_id, avg(value) FILTER (event_type IN ('click', 'signup')) AS click,
             avg(value) FILTER (event_type = 'error') AS error
      FROM events GROUP BY ALL)""")
def blend_two_sources(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    kinds = events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "user_id").agg(
        F.avg(F.when(F.col("event_type") == "error", F.col("value"))).alias("error"),
        F.avg(F.when(F.col("event_type").isin("click", "signup"), F.col("value"))).alias("click"),
    )
    return kinds.select("day", "user_id", F.round(blend(F.col("error"), F.col("click")), 6).alias("blended"))


@query("""
SELECT event_id, CASE WHEN event_type = 'click' THEN user_id WHEN event_type = 'view' THEN event_id
                      WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) END AS merged_key FROM events""")
def coalesce_keys(spark, sf_dir):
    kind = F.col("event_type")
    sources = read(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", F.col("user_id")).alias("w"),
        F.when(kind == "view", F.col("event_id")).alias("aq"),
        F.when(kind == "error", inputs.whole(F.col("value"))).alias("pws"),
    )
    return sources.select("event_id", F.coalesce("w", "aq", "pws").alias("merged_key"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def date_of_datetime(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))


# --- joins --------------------------------------------------------------------------------------


@query("""
SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment FROM events e LEFT JOIN customer c
ON 'L' || e.user_id = CASE WHEN c.c_acctbal >= 0 THEN 'L' || c.c_custkey END""")
def left_join_broadcast(spark, sf_dir):
    # Customers in debt have no code, so that some events find no partner.
    code = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("L"), "c_custkey"))
    dim = read(spark, sf_dir, "customer").select(code.alias("code"), "c_name", "c_mktsegment")
    fact = read(spark, sf_dir, "events").select("event_id", "user_id", F.concat(F.lit("L"), "user_id").alias("station"))
    return lookup_left(fact, dim, {"station": "code"}, ["c_name", "c_mktsegment"]).drop("station")


@query("""
SELECT datetime, location, a.pollutant, a.label, warning_message
FROM (SELECT datetime, location, pollutant, label FROM air_quality_rows) a
LEFT JOIN warnings w ON a.pollutant = w.pollutant AND a.label = w.label""")
def left_join_composite(spark, sf_dir):
    staged = built(spark, sf_dir).stg_hourly_air_quality
    named = lookup_left(staged, inputs.indicators(spark), {"pollutant_symbol": "symbol"}, ["pollutant"])
    labelled = named.select("datetime", "location", "pollutant", aqi_label(F.col("pollutant_value")).alias("label"))
    return lookup_left(
        labelled, inputs.warnings(spark), {"pollutant": "pollutant", "label": "label"}, ["warning_message"]
    )


@query(f"SELECT datetime, place, city, state, {rounded_sql(_AVERAGES)} FROM joined_averages")
def full_outer_join_3way(spark, sf_dir):
    m = built(spark, sf_dir)
    save = lambda df: materialize_table(df, scratch_path(spark, "averages"))
    joined = core.full_join_sources(m.weather, m.air_quality, m.personal_weather, save)
    return rounded(joined, _AVERAGES).select("datetime", "place", "city", "state", *_AVERAGES)


@query(f"SELECT datetime, place, city, state, {rounded_sql(_AVERAGES)} FROM joined_averages")
def bucketed_marts(spark, sf_dir):
    """The sources as tables in the same buckets of hour and place, which meet without a shuffle."""
    catalog.ensure_environments(spark, scratch_path(spark, "marts"))
    models = built(spark, sf_dir)
    weather, air, personal = marts.write_marts(models, "dev", marts.buckets_for(models), f"marts_{uuid.uuid4().hex}_")
    joined = core.full_join_sources(weather, air, personal)
    return rounded(joined, _AVERAGES).select("datetime", "place", "city", "state", *_AVERAGES)


@query("""
SELECT event_id, CASE WHEN w THEN 'w ' || user_id WHEN a THEN 'a ' || user_id WHEN p THEN 'p ' || user_id END AS place,
       CASE WHEN w AND value < 20 THEN CASE WHEN a THEN event_id + 1 WHEN p THEN event_id + 2 END WHEN w THEN event_id
            WHEN a THEN event_id + 1 WHEN p THEN event_id + 2 END AS hour
FROM (SELECT *, event_type IN ('click', 'view', 'error') AS w, event_type IN ('view', 'error', 'purchase') AS a,
             event_type IN ('error', 'purchase', 'signup') OR value > 70 AS p FROM events)""")
def coalesce_join_keys(spark, sf_dir):
    """Rows with keys of one, two and three sources, some with one key column of a source missing: weather comes before air
    quality, that before personal stations, each column by itself."""
    kind = F.col("event_type")
    given = {
        "w": kind.isin("click", "view", "error"),
        "a": kind.isin("view", "error", "purchase"),
        "p": kind.isin("error", "purchase", "signup") | (F.col("value") > 70),
    }
    columns = []
    for shift, (tag, is_given) in enumerate(given.items()):
        has_hour = is_given & (F.col("value") >= 20) if tag == "w" else is_given
        columns += [
            F.when(has_hour, F.col("event_id") + shift).alias(f"{tag}_hour"),
            F.when(is_given, F.concat(F.lit(f"{tag} "), "user_id")).alias(f"{tag}_place"),
        ]
    joined = read(spark, sf_dir, "events").select("event_id", *columns)
    return joined.select("event_id", *core.coalesced_keys(["hour", "place"]))
