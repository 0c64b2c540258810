"""Daily loads by the dates that they touch, declared checks, and backfills by file."""

from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.errors import AnalysisException

from atmolake.operators import quality
from atmolake.plans import checks, core
from atmolake.plans.models import DATED_MODELS, Bronze, Models, Seeds, new_loads, refresh_dates, run, run_new_loads, slice_dates
from atmolake.schemas import SEEDS
from atmolake.sinks import writers
from atmolake.streaming import backfill, ingest
from tests.conftest import rows
from tests.test_sinks import SEED_ROWS, aq_line, pws_line, weather_line

LOADS = {
    "hourly_weather": ingest.bronze_weather,
    "hourly_pws_weather": ingest.bronze_pws,
    "hourly_air_quality": ingest.bronze_air_quality,
}


@pytest.fixture
def seeds(spark, tmp_path):
    for name, columns in SEEDS.items():
        writers.write_csv(spark.createDataFrame(SEED_ROWS[name], columns), f"{tmp_path}/seeds/{name}.csv")
    return Seeds.read(spark, f"{tmp_path}/seeds")


@pytest.fixture
def land(spark, tmp_path):
    def load(batch, weather, pws, aq):
        for (name, to_bronze), lines in zip(LOADS.items(), (weather, pws, aq)):
            folder = tmp_path / "landing" / name
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{batch}.json").write_text("\n".join(lines))
            ingest.ingest(spark, str(folder), f"{tmp_path}/lake/prod/{name}", f"{tmp_path}/check/{name}", to_bronze).awaitTermination()

    return load


def uv_line(hour, uv):
    line = json.loads(weather_line(hour, 30))
    line["WMKK:9:MY"]["observations"][0]["uv_index"] = uv
    return json.dumps(line)


def same(found, rebuilt):
    for name in found:
        columns = [column for column in rebuilt[name].columns if column != "date"]
        assert rows(found[name].select(columns)) == rows(rebuilt[name].select(columns)), name


def test_new_loads_bring_models_up_to_a_rebuild(spark, tmp_path, seeds, land):
    lake, kept = f"{tmp_path}/lake", f"{tmp_path}/kept"
    land(1, [uv_line(0, 2), uv_line(30, 3)], [pws_line("I1", 0, 20)], [aq_line(0, "58**"), aq_line(60, "9*")])
    run_new_loads(spark, lake, seeds, kept)
    assert run_new_loads(spark, lake, seeds, kept) is None
    # A late UV value of the first day, another station of it, and a day that was not there.
    land(2, [uv_line(0, 6), uv_line(100, 1)], [pws_line("I2", 0, 28)], [aq_line(1, "60**")])
    assert {row["date"] for row in new_loads(spark, lake, kept).collect()} == {date(2024, 1, 1), date(2024, 1, 5)}
    found = run_new_loads(spark, lake, seeds, kept)
    same(found, run(Bronze.read(spark, lake), seeds, f"{tmp_path}/fresh"))
    assert rows(found["uv"].filter("uv_index = 4").select("place", "exposure_category")) == [("p1", "moderate")]


def test_a_failed_run_takes_its_loads_again(spark, tmp_path, seeds, land, monkeypatch):
    lake, kept = f"{tmp_path}/lake", f"{tmp_path}/kept"
    land(1, [uv_line(0, 2)], [pws_line("I1", 0, 20)], [aq_line(0, "58**")])
    with monkeypatch.context() as patch:
        patch.setattr(core, "livability_score", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_new_loads(spark, lake, seeds, kept)
    same(run_new_loads(spark, lake, seeds, kept), run(Bronze.read(spark, lake), seeds, f"{tmp_path}/fresh"))


def test_a_withdrawn_date_is_emptied(spark, tmp_path, seeds):
    def bronze(weather, aq):
        documents = lambda lines: spark.createDataFrame([(line,) for line in lines], "value string")
        return Bronze(ingest.bronze_weather(documents(weather)), ingest.bronze_pws(documents([])), ingest.bronze_air_quality(documents(aq)))

    before, after = bronze([uv_line(0, 2), uv_line(40, 3)], [aq_line(0, "5**"), aq_line(40, "6**")]), bronze([uv_line(0, 2)], [aq_line(0, "5**")])
    run(before, seeds, f"{tmp_path}/kept")
    found = refresh_dates(after, seeds, f"{tmp_path}/kept", [date(2024, 1, 3)])
    same(found, run(after, seeds, f"{tmp_path}/fresh"))
    nothing = refresh_dates(bronze([], []), seeds, f"{tmp_path}/kept", [date(2024, 1, 1)])
    assert all(nothing[name].count() == 0 for name in DATED_MODELS)


def test_a_load_of_one_day_reads_one_day(spark, tmp_path, seeds, land):
    """Every scan of a dated table in the plans of all models is pruned to the touched date."""
    land(1, [uv_line(h, 2) for h in (0, 30, 60)], [pws_line("I1", h, 20) for h in (0, 30, 60)], [aq_line(h, "5**") for h in (0, 30, 60)])
    bronze = Bronze.read(spark, f"{tmp_path}/lake")
    lazy = Models(slice_dates(bronze, [date(2024, 1, 2)]), seeds)
    for name in DATED_MODELS:
        plan = getattr(lazy, name)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert scans and all("PartitionFilters: [" in line and "= 2024-01-02" in line for line in scans), plan
    plain = lambda df: df.drop("date")
    texts = Bronze(*[plain(df) for df in (bronze.hourly_weather, bronze.hourly_pws_weather, bronze.hourly_air_quality)])
    for some in ([], [date(2024, 1, 1), date(2024, 1, 3)]):
        for a, b in zip(vars(slice_dates(bronze, some)).values(), vars(slice_dates(texts, some)).values()):
            if a is not None:
                assert rows(plain(a)) == rows(b)


# --- checks -------------------------------------------------------------------------------------


def test_all_declared_checks():
    assert sum(len(declared) for declared in checks.DECLARED.values()) == 74


def test_each_kind_of_check_sees_a_violation(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "name string")
    child = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (None, "z", None), (2, "z", "y"), (3, None, "q"), (4, "b", "q")], "n int, k string, v string")
    declared = {
        "child": checks.Checks(("n", "k"), ("n", "k"), ("n", "v"), {"v": ["x", "y"]}, {"k": ("parent", "name"), "v": ("parent", "name")}),
        "parent": checks.Checks(("name",), ("name",)),
        "absent": checks.Checks(("n",)),
    }
    found = {tuple(row) for row in checks.report({"child": child, "parent": parent}, declared).collect()}
    assert found == {
        ("child", "not_null", "n", 1), ("child", "not_null", "k", 1), ("child", "unique", "n", 1), ("child", "unique", "k", 2),
        ("child", "accepted_values", "v", 1), ("child", "relationships", "k", 2), ("child", "relationships", "v", 5), ("child", "unique_combination", "n+v", 1),
        ("parent", "not_null", "name", 0), ("parent", "unique", "name", 1),
    }
    empty = checks.report({"child": child.limit(0), "parent": parent.limit(0)}, declared)
    assert {row["failures"] for row in empty.collect()} == {0}
    with pytest.raises(checks.ChecksFailed, match="parent: unique of name, 1 failures"):
        checks.stop_on_failure({"parent": parent}, "parent", declared=declared)
    checks.stop_on_failure({"parent": parent.distinct()}, "parent", declared=declared)


def test_run_stops_at_a_failing_check(spark, tmp_path, seeds, land):
    land(1, [uv_line(0, 2)], [pws_line("I1", 0, 20)], [aq_line(0, "58**")])
    bronze = Bronze.read(spark, f"{tmp_path}/lake")
    run(bronze, seeds, f"{tmp_path}/checked", checked=True)
    land(2, [], [pws_line("IX", 0, 20)], [aq_line(0, "70**")])  # an unknown station; two readings of one hour
    with pytest.raises(checks.ChecksFailed) as raised:
        run(Bronze.read(spark, f"{tmp_path}/lake"), seeds, f"{tmp_path}/other", checked=True)
    assert {(row["table"], row["check"]) for row in raised.value.failed} == {
        ("stg_hourly_air_quality", "unique_combination"), ("stg_hourly_pws_weather", "relationships"),
    }
    assert not (tmp_path / "other").exists()
    run(Bronze.read(spark, f"{tmp_path}/lake"), seeds, f"{tmp_path}/other")


def test_a_place_of_two_cities_stops_a_run(spark, tmp_path, seeds):
    df = spark.createDataFrame([("p", "c"), ("p", "c"), ("q", "c"), ("q", "d"), ("r", None), ("r", "c"), (None, "x"), (None, "y"), ("s", None)], "place string, city string")
    found = quality.conflicting_dependants(df, ["place"], ["city"])
    assert rows(found.select("place", "rows")) == [("q", 2), ("r", 2)]
    two = Seeds(**{**vars(seeds), "city_places": seeds.city_places.union(spark.createDataFrame([("p1", "c9")], "a string, b string"))})
    documents = spark.createDataFrame([], "value string")
    empty = Bronze(ingest.bronze_weather(documents), ingest.bronze_pws(documents), ingest.bronze_air_quality(documents))
    for bring_up in (lambda to: run(empty, two, to), lambda to: refresh_dates(empty, two, to, [date(2024, 1, 1)])):
        with pytest.raises(core.PlaceConflict, match="p1"):
            bring_up(f"{tmp_path}/out")


# --- backfill -----------------------------------------------------------------------------------


def pressure_file(folder, day, *pressures, touched=None):
    path = folder / f"{day}_pws.json"
    observations = [{"stationID": "I1", "epoch": 1704067200 + 3600 * i, "metric": {"pressureMax": p}} for i, p in enumerate(pressures)]
    path.write_text(json.dumps({"I1": {"observations": observations}}))
    if touched:
        os.utime(path, (touched, touched))


def test_each_file_is_loaded_once(spark, tmp_path, monkeypatch):
    table, glob = f"{tmp_path}/pressure", f"{tmp_path}/files/*_pws.json"
    (tmp_path / "files").mkdir()
    pressure_file(tmp_path / "files", 1, 1000.5, 1001.0, touched=1_700_000_000)
    pressures = lambda: rows(backfill.read_loaded(spark, table).select("pressure"))
    assert backfill.load_pws_pressure(spark, glob, table) == 1
    assert backfill.load_pws_pressure(spark, glob, table) == 0
    pressure_file(tmp_path / "files", 2, 1002.0)
    read = []
    scan = lambda session, paths: read.extend(paths) or backfill.scan_pws_pressure(session, paths, keep_file=True)
    assert backfill.load_new_files(spark, glob, table, scan) == 1
    assert [os.path.basename(path) for path in read] == ["2_pws.json"]
    assert pressures() == [(1000.5,), (1001.0,), (1002.0,)]
    # A load whose ledger entry fails leaves nothing to be seen, and is made up for.
    pressure_file(tmp_path / "files", 3, 1003.0)
    with monkeypatch.context() as patch:
        patch.setattr(backfill, "append_table", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            backfill.load_pws_pressure(spark, glob, table)
    assert pressures() == [(1000.5,), (1001.0,), (1002.0,)]
    assert backfill.load_pws_pressure(spark, glob, table) == 1
    # A file that was written anew counts with its new rows.
    pressure_file(tmp_path / "files", 1, 999.0, touched=1_700_000_100)
    assert backfill.load_pws_pressure(spark, glob, table) == 1
    assert pressures() == [(1002.0,), (1003.0,), (999.0,)]


def test_nothing_to_load(spark, tmp_path):
    assert rows(backfill.loaded_files(spark, f"{tmp_path}/t")) == []
    with pytest.raises(AnalysisException):
        backfill.load_pws_pressure(spark, f"{tmp_path}/none-*.json", f"{tmp_path}/t")
