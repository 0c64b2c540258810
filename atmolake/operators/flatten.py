"""Nested responses to flat bronze rows. Every bronze column is text.

A flatten returns `(rows, rejected)`. Rows whose station is not the requested one are rejected, or
raise with `strict=True`. All steps are narrow: no shuffle between the landed text and the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.fixed_values import (
    ACCEPTED_LANGUAGE,
    ACCEPTED_STATUS,
    ACCEPTED_UNITS,
    CITY_KEYS,
    LOCAL_TIME_ZONE,
    STATION_SUFFIX,
    TOWN_KEYS,
    UNIDENTIFIED,
    UNIDENTIFIED_STATION_ID,
)
from atmolake.functions.casts import round_exact, safe_double
from atmolake.functions.text import first_segment
from atmolake.functions.times import epoch_to_local, parse_iso_datetime
from atmolake.schemas import BRONZE_PWS, BRONZE_WEATHER


def variant_text(value: Column) -> Column:
    """A VARIANT scalar as text; NULL for both SQL NULL and JSON null."""
    return F.try_variant_get(value, "$", "string")


# --- responses ----------------------------------------------------------------------------------


def is_accepted(metadata: Column) -> Column:
    """Whether a response has the status, language and units that a load takes. Never NULL."""
    return F.coalesce(
        (metadata["status_code"] == ACCEPTED_STATUS)
        & (metadata["language"] == ACCEPTED_LANGUAGE)
        & (metadata["units"] == ACCEPTED_UNITS),
        F.lit(False),
    )


def split_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected responses; those without any observation are in neither."""
    given = responses.filter(F.size("observations") > 0)
    accepted = is_accepted(F.col("metadata"))
    return given.filter(accepted), given.filter(~accepted)


def split_pws_responses(responses: DataFrame) -> DataFrame:
    """Personal-station responses carry no metadata; keep those with observations."""
    return responses.filter(F.size("observations") > 0)


def stamp_station(responses: DataFrame) -> DataFrame:
    """Write the requested station into each response."""
    return responses.withColumn("weather_station", F.col("station"))


def merge_last_wins(responses: DataFrame, key: str, order_by: list[str], narrow: DataFrame | None = None) -> DataFrame:
    """One response per key, the last one by `order_by`, which must be a total order within a key.

    Which one is last is found on the key and the order alone, combined on the map side: each task sends one short row
    per key, however hot the key. The responses then meet their last orders; a key and an order are one row, so a hot
    key spreads over the tasks. `narrow` has the key and the order of every response; it is cheaper where the responses
    are parsed for their payload only (`sources.landing.response_names`).
    """
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    last = (responses if narrow is None else narrow).groupBy(F.col(key).alias("_last_key")).agg(F.max(order).alias("_last_order"))
    is_last = F.col(key).eqNullSafe(F.col("_last_key")) & order.eqNullSafe(F.col("_last_order"))
    return responses.join(last, is_last, "left_semi").select(key, *[name for name in responses.columns if name != key])


def requested_stations(requested: DataFrame, responses: DataFrame, station: str = "station") -> DataFrame:
    """Requested stations with their response; `found` is false for those without any."""
    marked = responses.withColumn("found", F.lit(True))
    return requested.join(marked, station, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def icao_station_list(locations: DataFrame, suffix: str = STATION_SUFFIX) -> DataFrame:
    """Request names of the airport stations."""
    return locations.filter(F.col("ICAO").isNotNull()).select(F.concat("ICAO", F.lit(suffix)).alias("station"))


def pws_station_list(locations: DataFrame) -> DataFrame:
    """Distinct personal stations."""
    return locations.filter(F.col("PWStation").isNotNull()).select(F.col("PWStation").alias("station")).distinct()


def station_count(responses: DataFrame) -> DataFrame:
    """Responses and observations per requested station."""
    return responses.groupBy("station").agg(
        F.count(F.lit(1)).alias("responses"), F.sum(F.size("observations")).alias("observations")
    )


# --- station identity ---------------------------------------------------------------------------


def weather_station_id(obs_id: Column, key: Column) -> Column:
    """`obs_id`, else `key`, else Unidentified; the stand-in id counts as Unidentified.

    The inputs are VARIANT: only a missing key falls through, a JSON null gives NULL.
    """
    station = (
        F.when(obs_id.isNotNull(), variant_text(obs_id))
        .when(key.isNotNull(), variant_text(key))
        .otherwise(UNIDENTIFIED)
    )
    return F.when(station == UNIDENTIFIED_STATION_ID, UNIDENTIFIED).otherwise(station)


def pws_station_id(station_id: Column) -> Column:
    return F.when(station_id.isNotNull(), variant_text(station_id)).otherwise(UNIDENTIFIED)


def station_matches(requested: Column, observed: Column) -> Column:
    """Whether an observation belongs to the requested station, or is Unidentified. Never NULL."""
    return F.coalesce((observed == first_segment(requested, ":")) | (observed == UNIDENTIFIED), F.lit(False))


def _guard(rows: DataFrame, strict: bool) -> tuple[DataFrame, DataFrame]:
    matches = station_matches(F.col("station"), F.col("weather_station"))
    if strict:
        message = F.concat(
            F.lit("station "), F.col("station"), F.lit(" does not match observation "),
            F.coalesce("weather_station", F.lit("null")),
        )
        kept = rows.withColumn(
            "weather_station",
            F.when(matches, F.col("weather_station")).otherwise(F.raise_error(message).cast("string")),
        )
    else:
        kept = rows.filter(matches)
    return kept.drop("station"), rows.filter(~matches)


# --- observations -------------------------------------------------------------------------------


def pws_pressure(high: Column, low: Column, places: int | None = None) -> Column:
    """Mean of both, else the one that is there. Zero counts as missing."""
    high, low = F.nullif(high, F.lit(0.0)), F.nullif(low, F.lit(0.0))
    mean = (high + low) / 2
    return F.coalesce(mean if places is None else round_exact(mean, places), high, low)


def weather_columns(tz: str = LOCAL_TIME_ZONE) -> list[Column]:
    """The 35 bronze columns, all text, of an observation in `obs`. Times are wall-clock times of `tz`."""
    computed = {
        "datetime": epoch_to_local(F.col("obs.valid_time_gmt"), tz).cast("string"),
        "expire_time_gmt": epoch_to_local(F.col("obs.expire_time_gmt"), tz).cast("string"),
        "weather_station": weather_station_id(F.col("obs.obs_id"), F.col("obs.key")),
    }
    return [(F.col(f"obs.`{field}`") if field else computed[name]).alias(name) for name, field in BRONZE_WEATHER.items()]


def pws_columns(tz: str = LOCAL_TIME_ZONE) -> list[Column]:
    """The 21 bronze columns, all text, of a personal station's observation in `obs`."""
    pressure = pws_pressure(
        safe_double(F.col("obs.metric.pressureMax")), safe_double(F.col("obs.metric.pressureMin"))
    )
    computed = {
        "datetime": epoch_to_local(F.col("obs.epoch"), tz).cast("string"),
        "weather_station": pws_station_id(F.col("obs.stationID")),
        "pressure": pressure.cast("string"),
    }
    return [(F.col(f"obs.{field}") if field else computed[name]).alias(name) for name, field in BRONZE_PWS.items()]


def flatten_weather(
    responses: DataFrame, tz: str = LOCAL_TIME_ZONE, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Bronze station weather, 35 text columns. Times are wall-clock times of `tz`."""
    rows = responses.select("station", F.explode("observations").alias("obs")).filter("obs IS NOT NULL")
    return _guard(rows.select("station", *weather_columns(tz)), strict)


def flatten_pws(responses: DataFrame, tz: str = LOCAL_TIME_ZONE, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Bronze personal-station weather, 21 text columns."""
    rows = responses.select("station", F.explode("observations").alias("obs")).filter("obs IS NOT NULL")
    return _guard(rows.select("station", *pws_columns(tz)), strict)


def aq_columns(time: Column) -> list[Column]:
    """The bronze columns of a reading whose time is parsed."""
    return [
        first_segment(F.col("STATION_LOCATION"), ",").alias("location"),
        time.cast("string").alias("datetime"),
        F.col("API").alias("value"),
    ]


def flatten_aq(readings: DataFrame, strict: bool = False) -> DataFrame:
    """Bronze air quality `(location, datetime, value)` from parsed readings; incomplete ones dropped.

    A reading whose time is no time is dropped too, or raises with `strict`; one such reading must not end a load.
    """
    time = parse_iso_datetime(F.col("DATETIME"), strict)
    return readings.filter(time.isNotNull() & F.col("API").isNotNull()).select(*aq_columns(time))


def aq_readings(readings: DataFrame) -> DataFrame:
    """Typed air-quality readings with their station and state."""
    return readings.select(
        F.col("STATION_ID").alias("station_id"),
        F.col("STATE_ID").alias("state_id"),
        F.col("STATION_NAME").alias("station_name"),
        F.col("STATION_LOCATION").alias("station_location"),
        parse_iso_datetime(F.col("DATETIME")).alias("datetime"),
        F.col("API").try_cast("bigint").alias("api"),
    )


def typed_projection(bronze: DataFrame) -> DataFrame:
    """Ten bronze weather columns with types; bad text raises under ANSI mode."""
    types = {
        "datetime": "timestamp_ntz",
        "weather_station": "string",
        "observation_place": "string",
        "temperature": "double",
        "pressure": "double",
        "wind_speed": "double",
        "weather_phrase": "string",
        "dew_point": "double",
        "relative_humidity": "double",
        "heat_index": "double",
    }
    return bronze.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])


# --- addresses ----------------------------------------------------------------------------------


def first_filled(address: Column, keys: list[str]) -> Column:
    """The first part of an address map that is there and not empty."""
    return F.coalesce(*[F.nullif(F.try_element_at(address, F.lit(key)), F.lit("")) for key in keys])


def address_parts(df: DataFrame, address: str = "address") -> DataFrame:
    """Add town, city, state and postcode of an address map."""
    part = F.col(address)
    return df.withColumns(
        {
            "town": first_filled(part, TOWN_KEYS),
            "city": first_filled(part, CITY_KEYS),
            "state": F.try_element_at(part, F.lit("state")),
            "postcode": F.try_element_at(part, F.lit("postcode")),
        }
    )
