from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from atmolake.fixed_values import MATRIX_HEADER
from atmolake.operators import reshape
from atmolake.sources import csv_files, landing, tables
from tests.conftest import rows


def test_one_line_and_pretty_printed_files(spark, tmp_path):
    doc = {"A:9:MY": {"observations": [{"obs_id": "A", "temp": 1}]}, "B:9:MY": {"observations": []}}
    (tmp_path / "line").mkdir()
    (tmp_path / "line" / "a.json").write_text(json.dumps(doc) + "\n" + json.dumps(doc))
    (tmp_path / "pretty").mkdir()
    (tmp_path / "pretty" / "a.json").write_text(json.dumps(doc, indent=2))
    line = landing.scan_weather_json(spark, str(tmp_path / "line"))
    pretty = landing.scan_weather_json(spark, str(tmp_path / "pretty"), whole_file=True)
    assert rows(line.select("station")) == [("A:9:MY",)] * 2 + [("B:9:MY",)] * 2
    assert rows(pretty.select("station", F.size("observations"))) == [("A:9:MY", 1), ("B:9:MY", 0)]


def test_matrix_keys(spark):
    matrix = [MATRIX_HEADER, ["S", "L"] + ["1**"] * 24]
    docs = [
        {"zzz": [["x"]], "24hour_api_apims": matrix, "24hour_api": [["y"]]},
        {"zzz": [["x"]], "24hour_api": matrix},
        {"renamed": matrix, "other": [["x"]]},
        {},
    ]
    df = spark.createDataFrame([(i, json.dumps(doc)) for i, doc in enumerate(docs)], "n int, value string")
    parsed = landing.parse_aq_matrix(df, "n").orderBy("n").collect()
    assert [row.header == MATRIX_HEADER for row in parsed[:3]] == [True] * 3
    assert [len(row.rows) for row in parsed[:3]] == [1, 1, 1]
    assert parsed[3].header is None


def test_matrix_file_and_hours(spark, tmp_path):
    cells = [f"{hour}**" for hour in range(1, 25)]
    doc = {"24hour_api_apims": [MATRIX_HEADER, ["Selangor", "Klang", *cells], ["Selangor", "Kajang", *(["N/A"] * 24)]]}
    (tmp_path / "2021-05-02.json").write_text(json.dumps(doc, indent=1))
    scanned = landing.scan_aq_matrix(spark, str(tmp_path), whole_file=True)
    dated = scanned.withColumn("request_date", F.to_date(F.substring("source_file", 1, 10)))
    long = reshape.unpivot_matrix(dated, "request_date")
    assert long.count() == 48
    klang = {row.time_label: (row.datetime, row.value) for row in long.filter("location = 'Klang'").collect()}
    assert klang["1:00AM"] == (datetime(2021, 5, 1, 1), "1**")
    assert klang["12:00PM"] == (datetime(2021, 5, 1, 12), "12**")
    assert klang["12:00AM"] == (datetime(2021, 5, 2, 0), "24**")


def test_matrix_choice(spark):
    def landed(day, time, header):
        return (day, "1200", time, header, [[day, time]])

    wrong = MATRIX_HEADER[::-1]
    data = [
        landed("d1", "1200", MATRIX_HEADER), landed("d1", "2300", MATRIX_HEADER),
        landed("d2", "1200", wrong), landed("d2", "0100", MATRIX_HEADER), landed("d2", "0000", MATRIX_HEADER),
        landed("d3", "1200", wrong), landed("d3", "2300", wrong),
        landed("d4", "0700", MATRIX_HEADER),
    ]
    df = spark.createDataFrame(
        data, "day string, requested string, landed string, header array<string>, rows array<array<string>>"
    )
    chosen, left = reshape.choose_valid_matrix(df, ["day"], "requested", "landed")
    assert rows(chosen.select("day", "landed")) == [("d1", "1200"), ("d2", "0000")]
    assert rows(left) == [("d3",), ("d4",)]


def feature(station, country="MY", kind="PWS", point="Point", at=(101.5, 3.5)):
    properties = {"neighborhood": "n", "type": kind, "station_name": "s"}
    if country:
        properties["country"] = country
    return {"id": station, "geometry": {"type": point, "coordinates": list(at)}, "properties": properties}


def test_geojson(spark, tmp_path):
    first = {"t1": {"type": "FeatureCollection", "features": [feature("I1"), feature("I2", "SG"), feature("WMKK", None)]}}
    second = {
        "t2": {"type": "FeatureCollection", "features": [feature("I1", at=(9, 9)), feature("I3", kind="METAR")]},
        "t3": {"type": "Other", "features": [feature("I4", at=(1, 2))]},
    }
    (tmp_path / "a.json").write_text(json.dumps(first))
    (tmp_path / "b.json").write_text(json.dumps(second))
    stations = landing.scan_geojson_stations(spark, str(tmp_path))
    assert rows(stations.select("station_id", "longitude", "latitude", "is_expected_type")) == [
        ("I1", 101.5, 3.5, True), ("I3", 101.5, 3.5, False), ("I4", 1.0, 2.0, False),
    ]


def test_pressure_of_many_files(spark, tmp_path):
    for day, (high, low) in {"20240101": (1010.005, 1010.006), "20240102": (None, 999.1234)}.items():
        observation = {"stationID": "I1", "epoch": 1704067200, "metric": {"pressureMax": high, "pressureMin": low}}
        (tmp_path / f"{day}_pws.json").write_text(json.dumps({"I1": {"observations": [observation]}}))
    (tmp_path / "other.txt").write_text("{}")
    df = landing.scan_pws_pressure(spark, str(tmp_path / "*_pws.json"))
    assert rows(df) == [
        (datetime(2024, 1, 1, 8), "I1", round((1010.005 + 1010.006) / 2, 3)), (datetime(2024, 1, 1, 8), "I1", 999.1234),
    ]


def test_wide_csv_to_long(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("Time,Klang,Kota Bharu\n2005-01-01 00:00:00,58,\n2005-01-01 01:00:00,60**,44\n")
    wide = csv_files.scan_wide_csv(spark, str(tmp_path / "wide.csv"))
    assert {kind for _, kind in wide.dtypes} == {"string"}
    assert reshape.melt_locations(wide).count() == 4
    assert rows(reshape.melt_historic(wide)) == [
        ("2005-01-01 00:00:00", "Klang", "58"), ("2005-01-01 01:00:00", "Klang", "60**"),
        ("2005-01-01 01:00:00", "Kota Bharu", "44"),
    ]


def test_seed_with_crlf_and_quoted_commas(spark, tmp_path):
    path = tmp_path / "air_quality_warning.csv"
    path.write_bytes(b'label,pollutant,warning_message,should_report\r\nGood,CO,"calm, clear",FALSE\r\nBad,CO,mask,TRUE\r\n')
    seed = csv_files.scan_seed(spark, str(path), "air_quality_warning")
    assert rows(seed) == [("Bad", "CO", "mask", True), ("Good", "CO", "calm, clear", False)]


def test_airports(spark, tmp_path):
    header = "City served,State,ICAO,IATA,Airport name,Coordinates\n"
    line = "Kota Bharu,Kelantan,WMKC,KBR,Sultan Ismail Airport[2] / RMAF Base,06°10′N 102°E\n"
    (tmp_path / "airports.csv").write_text(header + line)
    row = csv_files.read_airports_csv(spark, str(tmp_path / "airports.csv")).first()
    assert row.asDict() == {
        "City": "Kota Bharu", "State": "Kelantan", "ICAO": "WMKC", "IATA": "KBR",
        "Weather_station_name": "Sultan Ismail Airport", "Coordinates": "06°10'N 102°E",
    }


def test_date_export(spark, tmp_path):
    (tmp_path / "dates.csv").write_text("aq_date\n2024-01-01\n2024-01-01\n2024-01-03\n")
    assert rows(csv_files.read_date_export_csv(spark, str(tmp_path / "dates.csv"), "aq_date")) == [
        (date(2024, 1, 1),), (date(2024, 1, 3),),
    ]


def test_environments(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/prod/t")
    spark.range(2000).write.parquet(f"{tmp_path}/dev/t")
    assert tables.source(spark, "t", str(tmp_path)).count() == 3
    assert tables.source(spark, "t", str(tmp_path), test_run=True).count() == 1000
    try:
        tables.scan_table(spark, "test", "t", str(tmp_path))
    except ValueError as error:
        assert "environment" in str(error)
    else:
        raise AssertionError("an unknown environment was accepted")
