from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from atmolake.operators import flatten
from atmolake.schemas import BRONZE_PWS, BRONZE_WEATHER
from atmolake.sources import landing
from tests.conftest import rows

GOOD = {"status_code": 200, "language": "en-US", "units": "m"}


def documents(spark, *docs):
    return spark.createDataFrame([(i, json.dumps(doc)) for i, doc in enumerate(docs)], "n int, value string")


def weather(station: str, *observations: dict, metadata=GOOD) -> dict:
    return {station: {"metadata": metadata, "observations": [{"valid_time_gmt": 1704067200} | o for o in observations]}}


def test_station_identity_tells_missing_from_null(spark):
    doc = weather(
        "WMKK:9:MY",
        {"obs_id": "WMKK", "key": "other"},
        {"key": "WMKK"},
        {},
        {"key": "96535"},
        {"obs_id": "96535"},
        {"obs_id": None, "key": "WMKK"},
        {"obs_id": "WMSA"},
    )
    kept, rejected = flatten.flatten_weather(landing.parse_weather(documents(spark, doc)))
    assert [row.weather_station for row in kept.collect()] == ["WMKK", "WMKK", "Unidentified", "Unidentified", "Unidentified"]
    # A JSON null is not a missing key: it does not fall back, and matches no station.
    assert rows(rejected.select("weather_station")) == [("WMSA",), (None,)]


def test_weather_columns_are_text_as_written(spark):
    observation = {"obs_id": "WMKK", "class": "observation", "temp": 30, "dewPt": 24.5, "gust": None, "clds": "FEW",
                   "expire_time_gmt": 1704074400, "wspd": 7, "icon_extd": 3000}
    kept, _ = flatten.flatten_weather(landing.parse_weather(documents(spark, weather("WMKK:9:MY", observation))))
    assert kept.columns == list(BRONZE_WEATHER) and len(kept.columns) == 35
    assert {kind for _, kind in kept.dtypes} == {"string"}
    row = kept.first()
    assert (row.datetime, row.expire_time_gmt) == ("2024-01-01 08:00:00", "2024-01-01 10:00:00")
    assert (row.temperature, row.dew_point, row.gust, row.wind_speed, row.icon_extended) == ("30", "24.5", None, "7", "3000")


def test_strict_mismatch_raises(spark):
    responses = landing.parse_weather(documents(spark, weather("WMKK:9:MY", {"obs_id": "WMSA"})))
    with pytest.raises(Exception, match="station WMKK:9:MY does not match observation WMSA"):
        flatten.flatten_weather(responses, strict=True)[0].collect()


def test_response_guard(spark):
    docs = [
        weather("A:9:MY", {}),
        weather("B:9:MY", {}, metadata=GOOD | {"status_code": 500}),
        weather("C:9:MY", {}, metadata=GOOD | {"language": "ms-MY"}),
        weather("D:9:MY", {}, metadata=GOOD | {"units": "e"}),
        weather("E:9:MY", {}, metadata=None),
        weather("F:9:MY"),
        {"G:9:MY": None},
    ]
    accepted, rejected = flatten.split_responses(landing.parse_weather(documents(spark, *docs)))
    assert rows(accepted.select("station")) == [("A:9:MY",)]
    assert rows(rejected.select("station")) == [("B:9:MY",), ("C:9:MY",), ("D:9:MY",), ("E:9:MY",)]


def pws(station: str, *observations: dict) -> dict:
    return {station: {"observations": [{"epoch": 1704067200, "metric": {}} | o for o in observations]}}


@pytest.mark.parametrize(
    "high, low, expected",
    [(1010.5, 1008.0, "1009.25"), (1010.5, None, "1010.5"), (None, 1008.0, "1008.0"), (None, None, None),
     (0, 1008, "1008.0"), (1010, 0, "1010.0"), (0, 0, None)],
)
def test_pws_pressure(spark, high, low, expected):
    doc = pws("I1", {"stationID": "I1", "metric": {"pressureMax": high, "pressureMin": low}})
    kept, _ = flatten.flatten_pws(landing.parse_pws(documents(spark, doc)))
    assert kept.first().pressure == expected


def test_pws(spark):
    doc = pws(
        "I1",
        {"stationID": "I1", "epoch": 1704067200000, "uvHigh": 3.5, "lat": 3.1, "metric": {"tempAvg": 30}},
        {},
        {"stationID": None},
        {"stationID": "I2"},
    )
    kept, rejected = flatten.flatten_pws(landing.parse_pws(documents(spark, doc)))
    assert kept.columns == list(BRONZE_PWS) and len(kept.columns) == 21
    first, second = kept.collect()
    assert (first.datetime, first.uv, first.lat, first.temperature) == ("2024-01-01 08:00:00", "3.5", "3.1", "30")
    assert second.weather_station == "Unidentified"
    assert rejected.count() == 2


def test_air_quality(spark):
    readings = [
        {"STATION_LOCATION": "Kota, Negeri", "DATETIME": "2024-11-01T00:00:00", "API": 58, "STATION_ID": "S", "STATE_ID": 3},
        {"STATION_LOCATION": "Kota", "DATETIME": "2024-11-01T01:00:00", "API": 60},
        {"STATION_LOCATION": "Kota", "DATETIME": None, "API": 60},
        {"STATION_LOCATION": "Kota", "DATETIME": "2024-11-01T02:00:00", "API": None},
        None,
    ]
    docs = documents(spark, {"api_table_hourly": readings}, {"other": 1}, {"api_table_hourly": []})
    parsed = landing.parse_aq(docs)
    assert rows(flatten.flatten_aq(parsed)) == [("Kota", "2024-11-01 00:00:00", "58"), ("Kota", "2024-11-01 01:00:00", "60")]
    first = flatten.aq_readings(parsed).filter("station_id = 'S'").first()
    assert (first.state_id, first.datetime, first.api) == (3, datetime(2024, 11, 1), 58)


def test_last_response_wins(spark):
    docs = documents(spark, weather("A", {"key": "A", "temp": 1}), weather("B", {"key": "B", "temp": 2}), weather("A", {"key": "A", "temp": 3}))
    merged = flatten.merge_last_wins(landing.parse_weather(docs, "n"), "station", ["n"])
    assert rows(merged.select("station", "n", F.get("observations", F.lit(0))["temp"])) == [("A", 2, "3"), ("B", 1, "2")]


def test_requested_stations(spark):
    responses = landing.parse_weather(documents(spark, weather("A:9:MY", {}, {})))
    requested = spark.createDataFrame([("A:9:MY",), ("B:9:MY",)], "station string")
    found = flatten.requested_stations(requested, responses)
    assert rows(found.select("station", "found")) == [("A:9:MY", True), ("B:9:MY", False)]
    assert rows(flatten.station_count(responses)) == [("A:9:MY", 1, 2)]
    assert flatten.stamp_station(responses).first().weather_station == "A:9:MY"


def test_station_lists(spark):
    locations = spark.createDataFrame([("WMKK", "I1"), (None, "I1"), ("WMSA", None)], "ICAO string, PWStation string")
    assert rows(flatten.icao_station_list(locations)) == [("WMKK:9:MY",), ("WMSA:9:MY",)]
    assert rows(flatten.pws_station_list(locations)) == [("I1",)]


def test_typed_projection_raises_on_bad_text(spark):
    columns = ["datetime", "weather_station", "observation_place", "temperature", "pressure", "wind_speed",
               "weather_phrase", "dew_point", "relative_humidity", "heat_index"]
    schema = ", ".join(f"{name} string" for name in columns)
    good = ("2024-01-01 00:00:00", "A", "a", "30", "1000", "3", "Fair", "20", "80", "33")
    row = flatten.typed_projection(spark.createDataFrame([good], schema)).first()
    assert (row.datetime, row.temperature, row.heat_index) == (datetime(2024, 1, 1), 30.0, 33.0)
    bad = (*good[:3], "hot", *good[4:])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flatten.typed_projection(spark.createDataFrame([bad], schema)).collect()


@pytest.mark.parametrize(
    "address, town, city",
    [
        ({"town": "T", "city": "C"}, "T", "C"),
        ({"town": "", "hamlet": "H", "district": "D"}, "H", "D"),
        ({"county": "K", "state_district": "SD"}, "K", "SD"),
        ({"quarter": "Q", "suburb": "S"}, "S", "S"),
        ({}, None, None),
    ],
)
def test_address_parts(spark, address, town, city):
    df = spark.createDataFrame([(address | {"state": "X", "postcode": "1"},)], "address map<string,string>")
    row = flatten.address_parts(df).first()
    assert (row.town, row.city, row.state, row.postcode) == (town, city, "X", "1")
