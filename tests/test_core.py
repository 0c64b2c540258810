from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from atmolake.operators import aggregates, lookups
from atmolake.plans import core
from tests.conftest import rows

START = datetime(2024, 1, 1)
PLACES = [("p1", "c1", "s1"), ("p2", "c1", "s1"), ("p3", "c2", "s2"), (None, None, None)]
KEYS = "datetime timestamp_ntz, place string, city string, state string"
W = ["temperature", "feels_like_temperature", "pressure", "dew_point", "relative_humidity", "gust", "wind_speed",
     "wind_chill", "uv_index", "visibility"]
P = ["solar_radiation", "uv_index", "humidity", "temperature", "precipitation_rate", "precipitation_total", "pressure",
     "wind_speed", "gust", "dew_point", "wind_chill"]


def readings(spark, draw, n, measures, hot=False):
    """Random rows with repeated keys, NULL places and NULL measures; `hot` puts half of them at one key."""

    def row(i):
        place = PLACES[0] if hot and i % 2 else draw.choice(PLACES)
        hour = START if hot and i % 2 else START + timedelta(hours=draw.randrange(4))
        return (hour, *place, *[draw.choice([None, float(draw.randrange(40))]) for _ in measures])

    schema = KEYS + "".join(f", {name} double" for name in measures)
    return spark.createDataFrame([row(i) for i in range(n)], schema)


def literal_full_joins(spark, w, a, p):
    """The model as defined: two full joins and one GROUP BY."""
    w.createOrReplaceTempView("w"), a.createOrReplaceTempView("aq"), p.createOrReplaceTempView("pws")
    pairs = {**{f"pws_{n}": f"pws.{n}" for n in core.BLENDED}, **{f"weather_{n}": f"w.{t}" for n, t in core.BLENDED.items()}}
    pairs |= {n: n for n in core.SINGLE}
    return spark.sql(f"""
        SELECT COALESCE(w.datetime, aq.datetime, pws.datetime) AS datetime, COALESCE(w.place, aq.place, pws.place) AS place,
               COALESCE(w.city, aq.city, pws.city) AS city, COALESCE(w.state, aq.state, pws.state) AS state,
               {", ".join(f"AVG({source}) AS {name}" for name, source in pairs.items())}
        FROM w FULL JOIN aq ON w.datetime = aq.datetime AND w.place = aq.place
        FULL JOIN pws ON pws.datetime = aq.datetime AND pws.place = aq.place
        GROUP BY 1, 2, 3, 4""")


def comparable(df):
    names = sorted(df.columns)
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in (row[n] for n in names)) for row in df.collect()), key=repr
    )


@pytest.mark.parametrize(
    "seed, sizes, hot",
    [(1, (20, 20, 20), False), (2, (25, 0, 25), False), (3, (0, 20, 5), False), (4, (5, 25, 0), False),
     (5, (0, 0, 9), False), (6, (40, 40, 40), True)],
)
def test_union_form_equals_full_joins(spark, seed, sizes, hot):
    draw = random.Random(seed)
    w = readings(spark, draw, sizes[0], W, hot)
    a = readings(spark, draw, sizes[1], ["pollutant_value"], hot)
    p = readings(spark, draw, sizes[2], P, hot)
    expected = comparable(literal_full_joins(spark, w, a, p))
    assert comparable(core.source_averages(w, a, p)) == expected
    assert comparable(core.full_join_sources(w, a, p)) == expected


def test_combined_places_and_rollups(spark):
    schema_w = KEYS + "".join(f", {n} double" for n in W)
    noon = START + timedelta(hours=12)
    place = ("p1", "c1", "s1")
    w = spark.createDataFrame([(START, *place, *[10.0] * len(W)), (noon, *place, *[30.0] * len(W))], schema_w)
    a = spark.createDataFrame([(START, *place, 50.0), (START, *place, 70.0)], KEYS + ", pollutant_value double")
    p = spark.createDataFrame([(START, *place, *[20.0] * len(P))], KEYS + "".join(f", {n} double" for n in P))
    places = core.full_weather_places(w, a, p)
    assert len(places.columns) == 18
    midnight = places.filter(F.col("datetime") == F.lit(START).cast("timestamp_ntz")).first()
    assert (midnight.temperature, midnight.humidity, midnight.visibility, midnight.solar_radiation) == (15.0, 15.0, 10.0, 20.0)
    assert midnight.pollutant_value == 60.0
    day = core.livability_score(places).first()
    assert (str(day.day), day.city, day.pollutant_value, day.temperature, day.uv_index) == ("2024-01-01", "c1", 60.0, 22.5, 30.0)
    info = spark.createDataFrame([("extreme", "s", "l")], "exposure_category string, short_description string, long_description string")
    assert rows(core.uv(places, info).select("uv_index", "exposure_category", "short_description")) == [
        (15.0, "extreme", "s"), (30.0, None, None),
    ]


def test_locations_and_air_quality(spark):
    sl = spark.createDataFrame(
        [("L1", "p1", 1.0, 2.0, "I1", None), ("L2", "p9", 1.0, 2.0, None, "W2")],
        "Identifying_Location string, Place string, Latitude double, Longitude double, PWStation string, ICAO string",
    )
    cp = spark.createDataFrame([("p1", "c1"), ("p2", "c2")], "Place string, City string")
    cs = spark.createDataFrame([("c1", "s1")], "City string, State string")
    locations = core.full_locations(sl, cp, cs)
    assert locations.columns == ["identifying_location", "place", "city", "state", "latitude", "longitude", "ICAO", "PWStation"]
    assert rows(locations.select("identifying_location", "place", "city", "state")) == [
        ("L1", "p1", "c1", "s1"), ("L2", "p9", None, None),
    ]
    staged = spark.createDataFrame(
        [(START, "L1", 58, "**"), (START, "L7", 500, "?")],
        "datetime timestamp_ntz, location string, pollutant_value int, pollutant_symbol string",
    )
    indicators = spark.createDataFrame([("PM2.5", "**")], "pollutant string, symbol string")
    warnings = spark.createDataFrame([("Moderate", "PM2.5", "slow")], "label string, pollutant string, warning_message string")
    assert rows(core.air_quality(staged, indicators, warnings, locations)) == [
        (START, "L1", "p1", "c1", "s1", "PM2.5", 58, "Moderate", "slow"),
        (START, "L7", None, None, None, None, 500, "Hazardous", None),
    ]


def test_big_dimensions_are_not_broadcast(spark):
    dim = spark.range(1000).withColumn("name", F.col("id").cast("string"))
    fact = spark.range(10).withColumnRenamed("id", "key")

    def plan(side):
        df = lookups.lookup_left(fact, side, {"key": "id"}, ["name"])
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(lookups.broadcast_if_small(dim))
    assert "broadcast" not in plan(lookups.broadcast_if_small(dim, max_bytes=100))
    # An empty dimension is small, and Catalyst then drops the join.
    assert "Join" not in plan(lookups.broadcast_if_small(dim.limit(0), max_bytes=100))


def test_gaps_and_matches(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("a",), (None,)], "name string")
    assert rows(lookups.missing_from(df, known, {"k": "name"})) == [("b",), ("b",), (None,)]
    assert rows(lookups.known_in(df, known, {"k": "name"})) == [("a",)]
    assert rows(lookups.unknown_values(df, "k", known, "name")) == [("b",), (None,)]
    wide = spark.createDataFrame([("t", 1, 2)], "Time string, a int, z int")
    assert rows(lookups.unknown_headers(wide, "Time", known, "name")) == [("z",)]
    scanned = spark.createDataFrame([("I1",), ("I2",)], "station_id string")
    assert rows(lookups.new_stations(scanned, spark.createDataFrame([("I1",)], "PWStation string"))) == [("I2",)]


def test_aggregates(spark):
    df = spark.createDataFrame(
        [(1, "a", 2.0), (2, "a", None), (3, "b", 0.0), (4, None, 5.0), (5, None, 6.0), (6, "a", 4.0)], "n int, k string, v double"
    )
    assert rows(aggregates.duplicate_values(df, "k")) == [("a", 3)]
    assert rows(aggregates.repeated_rows(df, "k", "n").select("n")) == [(2,), (6,)]
    assert rows(aggregates.first_rows(df, ["k"], ["n"])) == [("a", 1, 2.0), ("b", 3, 0.0), (None, 4, 5.0)]
    assert rows(aggregates.null_counts(df)) == [("k", 2), ("n", 0), ("v", 1)]
    assert rows(aggregates.station_stats(df.filter("k is not null"), "k", "v")) == [("a", 2.0, 3.0, 4.0, False), ("b", 0.0, 0.0, 0.0, True)]
    assert rows(aggregates.global_max(df.limit(0), "n")) == [(None,)]
