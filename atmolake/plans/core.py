"""The core models: enrich the staged readings, combine the three sources per place, roll up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.functions.bands import aqi_band, blend, uv_band
from atmolake.operators.lookups import lookup_left
from atmolake.operators.quality import conflicting_dependants
from atmolake.operators.reshape import union_all

PLACE = ["place", "city", "state"]
PLACE_HOUR = ["datetime", *PLACE]

# Measures that both weather sources have, and the name of each one on the weather side.
BLENDED = {
    "temperature": "temperature",
    "pressure": "pressure",
    "dew_point": "dew_point",
    "humidity": "relative_humidity",
    "wind_speed": "wind_speed",
    "gust": "gust",
    "wind_chill": "wind_chill",
    "uv_index": "uv_index",
}
WEATHER_ONLY = ["feels_like_temperature", "visibility"]
PWS_ONLY = ["solar_radiation", "precipitation_rate", "precipitation_total"]
SINGLE = [
    "feels_like_temperature", "visibility", "solar_radiation", "pollutant_value", "precipitation_rate",
    "precipitation_total",
]


class PlaceConflict(ValueError):
    """A place with more than one city or state."""


def require_one_city(locations: DataFrame) -> None:
    """Raise if a place has more than one city or state: the averages of `source_averages` rest on there being one."""
    if conflicts := conflicting_dependants(locations, ["place"], ["city", "state"]).orderBy("place").limit(20).collect():
        named = [f"{row['place']}: {tuple(row['least'])} and {tuple(row['greatest'])}" for row in conflicts]
        raise PlaceConflict("; ".join(named))


def full_locations(state_locations: DataFrame, city_places: DataFrame, city_states: DataFrame) -> DataFrame:
    """Locations with the city of their place and the state of their city."""
    with_city = lookup_left(state_locations, city_places, {"Place": "Place"}, ["City"])
    with_state = lookup_left(with_city, city_states, {"City": "City"}, ["State"])
    return with_state.select(
        F.col("Identifying_Location").alias("identifying_location"),
        F.col("Place").alias("place"),
        F.col("City").alias("city"),
        F.col("State").alias("state"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
        "ICAO",
        "PWStation",
    )


def air_quality(staged: DataFrame, indicators: DataFrame, warnings: DataFrame, locations: DataFrame) -> DataFrame:
    """Readings with pollutant, label, warning and place."""
    labelled = lookup_left(staged, indicators, {"pollutant_symbol": "symbol"}, ["pollutant"]).withColumn(
        "label", aqi_band(F.col("pollutant_value"))
    )
    warned = lookup_left(
        labelled, warnings, {"pollutant": "pollutant", "label": "label"}, ["warning_message"]
    )
    placed = lookup_left(warned, locations, {"location": "identifying_location"}, PLACE)
    return placed.select(
        "datetime",
        "location",
        *PLACE,
        "pollutant",
        "pollutant_value",
        "label",
        F.col("warning_message").alias("message"),
    )


def weather(staged: DataFrame, locations: DataFrame) -> DataFrame:
    """Distinct station weather with its place."""
    placed = lookup_left(staged, locations, {"weather_station": "ICAO"}, ["identifying_location", *PLACE])
    return placed.select(
        "datetime",
        F.col("identifying_location").alias("location"),
        *PLACE,
        "temperature",
        "feels_like_temperature",
        "pressure",
        "dew_point",
        "relative_humidity",
        "gust",
        "wind_speed",
        "wind_chill",
        "wind_direction_degree",
        "wind_direction_dir",
        "uv_index",
        "clouds",
        "visibility",
        "day_indicator",
    ).distinct()


def personal_weather(staged: DataFrame, locations: DataFrame) -> DataFrame:
    """Personal-station weather with its place."""
    placed = lookup_left(staged, locations, {"weather_station": "PWStation"}, PLACE)
    return placed.select(
        *PLACE_HOUR,
        "solar_radiation",
        "uv_index",
        "humidity",
        "temperature",
        "precipitation_rate",
        "precipitation_total",
        "pressure",
        "wind_speed",
        "gust",
        "dew_point",
        "heat_index",
        "wind_direction_degree",
        "wind_chill",
    )


def _averaged(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Averages per hour and place under new names."""
    return df.groupBy(*PLACE_HOUR).agg(*[F.avg(F.col(theirs).cast("double")).alias(name) for name, theirs in measures.items()])


def source_averages(weather: DataFrame, air_quality: DataFrame, personal_weather: DataFrame) -> DataFrame:
    """22 averages per hour and place.

    The model is two FULL JOINs on hour and place, then a GROUP BY. Inside one group a join
    repeats every row of a source equally often, and repeating all rows equally often keeps an
    average. So each source is averaged by itself, and a last grouping brings the averages of an
    hour and place together, one row of each source at most: no products of rows within a busy
    group, and the rows that are shuffled have the sums of their own source only. It needs that a
    place has one city and state, which `require_one_city` ensures before a run.
    """
    stacked = union_all(
        _averaged(weather, {f"weather_{name}": theirs for name, theirs in BLENDED.items()} | {name: name for name in WEATHER_ONLY}),
        _averaged(air_quality, {"pollutant_value": "pollutant_value"}),
        _averaged(personal_weather, {f"pws_{name}": name for name in BLENDED} | {name: name for name in PWS_ONLY}),
    )
    averaged = [f"pws_{name}" for name in BLENDED] + [f"weather_{name}" for name in BLENDED] + SINGLE
    return stacked.groupBy(*PLACE_HOUR).agg(*[F.max(name).alias(name) for name in averaged])


def full_weather_places(weather: DataFrame, air_quality: DataFrame, personal_weather: DataFrame) -> DataFrame:
    """All factors per hour and place, the two weather sources blended."""
    averages = source_averages(weather, air_quality, personal_weather)
    return averages.select(
        *PLACE_HOUR,
        *[blend(F.col(f"pws_{name}"), F.col(f"weather_{name}")).alias(name) for name in BLENDED],
        *SINGLE,
    )


def coalesced_keys(keys: list[str], tags: tuple[str, ...] = ("w", "a", "p")) -> list[Column]:
    """Each key from the first source that has it, in the order weather, air quality, personal."""
    return [F.coalesce(*[f"{tag}_{key}" for tag in tags]).alias(key) for key in keys]


def full_join_sources(
    weather: DataFrame, air_quality: DataFrame, personal_weather: DataFrame, save: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """The same averages by full joins, as a cross-check of `source_averages`.

    Each source is averaged per hour and place *before* the joins, so a join never pairs the rows
    of a group. The last grouping brings together weather and personal stations where no air
    quality reading links them. It coalesces the keys in the order weather, air quality, personal.

    Weather and air quality are read by two joins each. `save` may write a table and read it back, so that the averages
    of sources that are dear to compute are not computed for each of the joins.
    """

    def averaged(df: DataFrame, columns: dict[str, str], tag: str) -> DataFrame:
        return _averaged(df, columns).withColumnsRenamed({key: f"{tag}_{key}" for key in PLACE_HOUR})

    w = averaged(
        weather,
        {f"weather_{name}": theirs for name, theirs in BLENDED.items()} | {name: name for name in WEATHER_ONLY},
        "w",
    )
    w, a = save(w), save(averaged(air_quality, {"pollutant_value": "pollutant_value"}, "a"))
    p = averaged(personal_weather, {f"pws_{name}": name for name in BLENDED} | {name: name for name in PWS_ONLY}, "p")
    same_wa = (F.col("w_datetime") == F.col("a_datetime")) & (F.col("w_place") == F.col("a_place"))
    same_pa = (F.col("p_datetime") == F.col("a_datetime")) & (F.col("p_place") == F.col("a_place"))
    # Weather without air quality has no key for the second join. It goes past it, else all of it would wait
    # in the task of the NULL key.
    linked = a.join(w, same_wa, "left").join(p, same_pa, "full")
    joined = linked.unionByName(w.join(a, same_wa, "left_anti"), allowMissingColumns=True)
    measures = [name for name in (*w.columns, *a.columns, *p.columns) if name[:2] not in ("w_", "a_", "p_")]
    return joined.select(*coalesced_keys(PLACE_HOUR), *measures).groupBy(*PLACE_HOUR).agg(*[F.avg(name).alias(name) for name in measures])


def uv(places: DataFrame, uv_info: DataFrame) -> DataFrame:
    """UV index with exposure category and advice."""
    banded = places.select(*PLACE_HOUR, "uv_index").withColumn("exposure_category", uv_band(F.col("uv_index")))
    return lookup_left(
        banded, uv_info, {"exposure_category": "exposure_category"}, ["short_description", "long_description"]
    )


def livability_score(places: DataFrame) -> DataFrame:
    """Daily pollutant and temperature means and UV maximum per city."""
    return places.groupBy(F.to_date("datetime").alias("day"), "city", "state").agg(
        F.avg("pollutant_value").alias("pollutant_value"),
        F.avg("temperature").alias("temperature"),
        F.max("uv_index").alias("uv_index"),
    )
