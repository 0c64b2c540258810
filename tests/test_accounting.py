"""Every landed document is accounted for, and loads can be repeated."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from atmolake.operators import accounting
from atmolake.sinks import catalog, writers
from atmolake.sinks.folders import exists
from atmolake.sources import landing, tables
from atmolake.streaming import ingest
from tests.conftest import rows
from tests.test_sinks import aq_line, pws_line, weather_line

ODD = ["[1,2]", "5", "null", '"text"', '{"S2": 5}', "{}", '{"S1": {"observations": "none"}}', weather_line(0, 30)[:70], "", "   "]


def weather(*observations, status=200, station="WMKK:9:MY"):
    metadata = {"status_code": status, "language": "en-US", "units": "m"}
    return json.dumps({station: {"metadata": metadata, "observations": list(observations)}})


GOOD = {"obs_id": "WMKK", "valid_time_gmt": 1704067200, "temp": 30.0}
WEATHER = [
    *ODD,
    weather_line(1, 30),
    weather_line(2, 30) + " trailing",
    weather_line(2, 30) + weather_line(3, 30),
    weather(GOOD, 5, None, "x", [1], GOOD),
    weather(status=404),
    weather(GOOD, status=404),
    json.dumps({"WMKK:9:MY": {"metadata": {"status_code": 500}, "errors": ["no data"]}}),
    weather(),
    json.dumps({"S1": 7, **json.loads(weather(GOOD)), "S2": {"observations": {}}}),
    weather(GOOD, station="WSSS:9:MY"),
    weather({**GOOD, "valid_time_gmt": "noon"}),
]
EXPECTED = {
    # Broken: cut off, trailing text, two in a line. Shape: an array, a number, null, a text. Empty: {}.
    ("document", "broken"): 3, ("document", "shape"): 4, ("document", "empty"): 1, ("document", "opened"): len(WEATHER) - 2 - 8,
    ("response", "shape"): 4, ("response", "refused"): 2, ("response", "empty"): 2, ("response", "opened"): 5,
    ("reading", "shape"): 4, ("reading", "mismatch"): 1, ("reading", "taken"): 5,
}


def documents(spark, lines, file="f"):
    return spark.createDataFrame([(line, file) for line in lines], "value string, file string")


def counts(ledger):
    return {(r["level"], r["outcome"]): r["parts"] for r in ledger.collect()}


def test_every_shape_has_its_outcome(spark):
    parts = accounting.weather_parts(documents(spark, WEATHER), "file")
    assert counts(accounting.ledger(parts)) == EXPECTED
    assert sum(n for (level, _), n in EXPECTED.items() if level == "document") == sum(bool(line.strip()) for line in WEATHER)
    aside = accounting.set_aside(parts, "file").collect()
    assert len(aside) == sum(n for (_, outcome), n in EXPECTED.items() if outcome not in ("opened", "empty", "taken"))
    assert all(r["value"] is not None and r["file"] == "f" for r in aside)
    assert {r["value"] for r in aside if r["reason"] == "shape"} >= {"5", "null", "x", "[1]", "7", "[1,2]", '{"observations":{}}'}
    taken = accounting.bronze_rows(parts)
    assert sorted(r["temperature"] for r in taken.collect()) == ["30", "30.0", "30.0", "30.0", "30.0"]


def test_a_scan_keeps_what_is_beside_an_odd_part(spark):
    stations = [r["station"] for r in landing.parse_weather(documents(spark, WEATHER[-3:-2])).filter("size(observations) > 0").collect()]
    assert stations == ["WMKK:9:MY"]
    assert landing.parse_weather(documents(spark, [WEATHER[13]])).selectExpr("size(observations) AS n").first()["n"] == 2


def test_air_quality_outcomes(spark):
    reading = {"STATION_LOCATION": "L1", "DATETIME": "2024-01-01T08:00:00", "API": 5}
    table = lambda *readings: json.dumps({"api_table_hourly": list(readings)})
    lines = [
        *ODD[:4], '{"message": "none"}', '{"api_table_hourly": 3}', "[]", table(), table(reading, 7, None),
        table({**reading, "DATETIME": "2024-13-01T08:00:00"}, {**reading, "DATETIME": "noon"}, {**reading, "DATETIME": None}, {**reading, "API": None}),
        table(reading)[:40], "",
    ]
    parts = accounting.aq_parts(documents(spark, lines), "file")
    assert counts(accounting.ledger(parts)) == {
        ("document", "shape"): 7, ("document", "empty"): 1, ("document", "broken"): 1, ("document", "opened"): 2,
        ("reading", "taken"): 1, ("reading", "shape"): 2, ("reading", "time"): 2, ("reading", "incomplete"): 2,
    }
    assert rows(accounting.bronze_rows(parts)) == [("L1", "2024-01-01 08:00:00", "5")]


def test_tiles_of_another_shape_do_not_hide_others(spark):
    feature = {"id": "I1", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"country": "MY", "type": "PWS"}}
    line = json.dumps({"t1": 5, "t2": {"type": "FeatureCollection", "features": [7, feature]}, "t3": {"type": "X", "features": "none"}})
    df = spark.createDataFrame([(0, line)], "n int, value string")
    assert rows(landing.parse_geojson_stations(df, "n").select("station_id")) == [("I1",)]
    opened = landing.open_maps(df, landing.TILES, "n").select("name", "odd", "text")
    assert rows(opened) == [("t1", [], "5"), ("t2", ["7"], None), ("t3", [], '{"type":"X","features":"none"}')]


LOADS = {
    ingest.bronze_weather: (WEATHER, "weather_parts"),
    ingest.bronze_pws: ([*ODD, pws_line("I1", 0, 20), pws_line("I2", 1, 20), json.dumps({"I3": {"observations": [4]}})], "pws_parts"),
    ingest.bronze_air_quality: ([*ODD, aq_line(0, "58**"), aq_line(1, "9"), aq_line(2, "5").replace("2024", "2o24")], "aq_parts"),
}


@pytest.mark.parametrize("to_bronze", LOADS)
def test_rows_in_are_rows_out(spark, tmp_path, to_bronze):
    """By file: documents = broken + shape + empty + opened, and the tables have as many rows as the ledger says."""
    lines, _ = LOADS[to_bronze]
    table = str(tmp_path / "table")
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text("\n".join(lines))
    (tmp_path / "landing" / "b.json").write_text("\n".join(lines[5:]))
    for _ in range(2):  # the second load finds nothing new
        ingest.ingest(spark, str(tmp_path / "landing"), table, str(tmp_path / "check"), to_bronze).awaitTermination()
    ledger = spark.read.parquet(f"{table}_loads").withColumn("file", F.substring_index("file", "/", -1))
    levels = Counter()
    for r in ledger.collect():
        levels[r["file"], r["level"], r["outcome"]] += r["parts"]
    for file, landed in (("a.json", lines), ("b.json", lines[5:])):
        assert sum(n for (f, level, _), n in levels.items() if (f, level) == (file, "document")) == sum(bool(x.strip()) for x in landed)
    total = lambda *outcomes: sum(n for (_, level, outcome), n in levels.items() if level != "date" and outcome in outcomes)
    written = spark.read.parquet(table)
    assert written.count() == total("taken") == sum(n for (_, level, _), n in levels.items() if level == "date")
    aside = spark.read.parquet(f"{table}_quarantine")
    assert aside.count() == total("broken", "shape", "refused", "mismatch", "incomplete", "time")
    # Rows appended in another way are seen beside the loaded ones.
    before = written.drop("load")
    writers.append_table(before.limit(1), table, ["date"])
    assert spark.read.parquet(table).count() == written.count() + 1
    assert spark.read.parquet(table).select("load").distinct().count() == 2


def test_a_repeated_batch_writes_nothing(spark, tmp_path, monkeypatch):
    table, batch = str(tmp_path / "t"), documents(spark, WEATHER)
    # The ledger fails, after the rows were written: the batch comes again.
    with monkeypatch.context() as patch:
        patch.setattr(accounting, "ledger", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.load_batch(batch, table, "s-0", accounting.weather_parts)
    assert spark.read.parquet(table).count() == 5 and not exists(spark, f"{table}_loads")
    assert ingest.load_batch(batch, table, "s-0", accounting.weather_parts)
    assert not ingest.load_batch(batch, table, "s-0", accounting.weather_parts)
    assert spark.read.parquet(table).count() == 5
    assert ingest.load_batch(batch, table, "s-1", accounting.weather_parts)
    assert spark.read.parquet(table).count() == 10


def test_documents_are_read_once(spark, tmp_path):
    """All three tables of a batch come from one reading of its files."""
    (tmp_path / "a.json").write_text("\n".join(WEATHER))
    reads = spark.sparkContext.accumulator(0)

    def counted(documents, *keep):
        @F.udf("string")
        def seen(value):
            reads.add(1)
            return value

        return accounting.weather_parts(documents.withColumn("value", seen.asNondeterministic()("value")), *keep)

    batch = spark.read.text(str(tmp_path / "a.json")).withColumn("file", F.lit("a"))
    ingest.load_batch(batch, str(tmp_path / "t"), "s-0", counted)
    assert reads.value == len(WEATHER)


# --- catalog tables -----------------------------------------------------------------------------


def numbers(spark, *values):
    return spark.createDataFrame([(v, f"p{v % 2}") for v in values], "n int, part string")


def failing(df):
    return df.withColumn("n", F.when(F.col("n") > 1, F.raise_error(F.lit("no more"))).otherwise(F.col("n")).cast("int"))


def test_catalog_tables(spark, tmp_path):
    catalog.ensure_environments(spark, str(tmp_path))
    named = lambda env: rows(tables.scan_table(spark, env, "numbers").select("n"))
    catalog.load(numbers(spark, 1, 2), "dev", "numbers", ["part"])
    catalog.load(numbers(spark, 2, 3).select("part", "n"), "dev", "numbers", ["part"])
    catalog.load(numbers(spark, 9), "prod", "numbers", append_rows=False)
    assert named("dev") == [(1,), (2,), (2,), (3,)] and named("prod") == [(9,)]
    catalog.replace(tables.scan_table(spark, "dev", "numbers").filter("n > 1"), "dev", "numbers", ["part"])
    assert named("dev") == [(2,), (2,), (3,)]
    with pytest.raises(Exception, match="no more"):
        catalog.replace(failing(numbers(spark, 1, 2, 3)), "dev", "numbers", ["part"])
    assert named("dev") == [(2,), (2,), (3,)]
    catalog.append(numbers(spark, 4), "dev", "numbers", ["part"])
    assert named("dev") == [(2,), (2,), (3,), (4,)]
    assert rows(spark.sql("SELECT n FROM dev.numbers WHERE part = 'p0'")) == [(2,), (2,), (4,)]
    assert {t.name for t in spark.catalog.listTables("dev")} == {"numbers"}
    for bad in (("test", "numbers"), ("dev", "a b"), ("dev", "x; DROP")):
        with pytest.raises(ValueError):
            catalog.append(numbers(spark, 1), *bad)


def test_a_failing_rebuild_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "warehouse" / "t")
    writers.replace_table(numbers(spark, 1, 2), path, ["part"])
    with pytest.raises(Exception, match="no more"):
        writers.replace_table(failing(numbers(spark, 1, 2, 3)), path, ["part"])
    assert rows(spark.read.parquet(path).select("n")) == [(1,), (2,)]
    writers.replace_table(spark.read.parquet(path).filter("n = 2"), path, ["part"])
    assert rows(spark.read.parquet(path).select("n")) == [(2,)]
    assert [f.name for f in (tmp_path / "warehouse").iterdir()] == ["t"]
