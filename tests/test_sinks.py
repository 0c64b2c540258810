from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest

from atmolake.plans.models import Bronze, Seeds, refresh_days, run
from atmolake.schemas import SEEDS
from atmolake.session import scratch_path
from atmolake.sinks import materialize, writers
from atmolake.streaming import ingest
from tests.conftest import rows

START = datetime(2024, 1, 1)


def readings(spark, *hours, value=1.0):
    return spark.createDataFrame(
        [(START + timedelta(hours=hour), f"s{hour}", value) for hour in hours], "datetime timestamp_ntz, station string, value double"
    )


def test_object_path():
    assert writers.object_path("b", "2024-01-01 0000", "parquet") == "b/2024-01-01.parquet"
    assert writers.object_path("b", "2024-01-01 0000", "json", mobile=True) == "b/2024-01-01 mobile.json"


def test_only_dataframes_are_written():
    with pytest.raises(TypeError):
        writers.write_json({"a": 1}, "nowhere")


def test_replace_dates_is_idempotent_and_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_dates(readings(spark, 0, 1, 30), path)
    for _ in range(2):
        writers.replace_dates(readings(spark, 30, 31, value=9.0), path)
    assert rows(spark.read.parquet(path).select("station", "value")) == [("s0", 1.0), ("s1", 1.0), ("s30", 9.0), ("s31", 9.0)]
    assert {row.date.isoformat() for row in spark.read.parquet(path).select("date").distinct().collect()} == {"2024-01-01", "2024-01-02"}


@pytest.mark.parametrize(
    "mode, expected", [("per_key", [0, 1, 2, 30, 50]), ("per_row", [0, 1, 2, 30, 50]), ("global", [0, 1, 30, 50])]
)
def test_late_rows(spark, tmp_path, mode, expected):
    """The second load has a late row (2), known rows (30) and a new one (50)."""
    path = str(tmp_path / "t")
    for batch in ([0, 1, 30], [2, 30, 50], [2, 30, 50]):
        materialize.incremental_append(readings(spark, *batch), path, "datetime", ["station", "datetime"], mode)
    assert rows(spark.read.parquet(path).select("station")) == sorted((f"s{hour}",) for hour in expected)


def test_per_row_keeps_copies_as_often_as_a_rebuild(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = readings(spark, 0, 0, 1), readings(spark, 0, 0, 0, 1)
    for batch in (first, second, second):
        materialize.incremental_append(batch, path, "datetime", mode="per_row")
    assert rows(spark.read.parquet(path).select(*second.columns)) == rows(second)


@pytest.mark.parametrize("mode", ["per_key", "per_row", "global"])
def test_empty_target_takes_all(spark, tmp_path, mode):
    path = str(tmp_path / "t")
    readings(spark, 0).limit(0).write.parquet(path)
    materialize.incremental_append(readings(spark, 0, 1), path, "datetime", ["station"], mode)
    assert spark.read.schema("station string").parquet(path).filter("station is not null").count() == 2


def test_bad_mode(spark):
    with pytest.raises(ValueError):
        materialize.incremental_append(readings(spark, 0), "nowhere", "datetime", mode="per_key")
    with pytest.raises(ValueError):
        materialize.incremental_append(readings(spark, 0), "nowhere", "datetime", ["station"], "sometimes")


def test_view_and_table(spark, tmp_path):
    df = readings(spark, 0, 30)
    assert materialize.materialize_view(df, "some_readings").count() == 2
    for _ in range(2):
        table = materialize.materialize_table(df, str(tmp_path / "t"), "datetime")
    assert table.count() == 2


def test_scratch_is_shared_folder_of_the_session(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# --- whole graph --------------------------------------------------------------------------------

SEED_ROWS = {
    "state_locations": [("L1", "p1", 1.0, 2.0, "50000", "WMKK", "I1", None, None), ("L2", "p1", 1.0, 2.0, "50000", None, "I2", None, None)],
    "city_places": [("p1", "c1")],
    "city_states": [("c1", "s1")],
    "air_quality_indicators": [("PM2.5", "**", "m", "u")],
    "air_quality_warning": [("Moderate", "PM2.5", "slow, please", False)],
    "uv_info": [(2, "low", "s", "l")],
}


def weather_line(hour, temperature):
    observation = {"obs_id": "WMKK", "valid_time_gmt": 1704067200 + 3600 * hour, "temp": temperature, "uv_index": 1}
    metadata = {"status_code": 200, "language": "en-US", "units": "m"}
    return json.dumps({"WMKK:9:MY": {"metadata": metadata, "observations": [observation]}})


def pws_line(station, hour, temperature):
    observation = {"stationID": station, "epoch": 1704067200 + 3600 * hour, "metric": {"tempAvg": temperature}}
    return json.dumps({station: {"observations": [observation]}})


def aq_line(hour, value):
    moment = (START + timedelta(hours=8 + hour)).strftime("%Y-%m-%dT%H:%M:%S")
    return json.dumps({"api_table_hourly": [{"STATION_LOCATION": "L1, c1", "DATETIME": moment, "API": value}]})


def test_refreshing_touched_days_equals_a_rebuild(spark, tmp_path):
    seeds_folder = tmp_path / "seeds"
    for name, columns in SEEDS.items():
        writers.write_csv(spark.createDataFrame(SEED_ROWS[name], columns), f"{seeds_folder}/{name}.csv")
    seeds = Seeds.read(spark, str(seeds_folder))

    def bronze(weather, pws, aq):
        def documents(lines):
            return spark.createDataFrame([(line,) for line in lines], "value string")

        return Bronze(
            ingest.bronze_weather(documents(weather)),
            ingest.bronze_pws(documents(pws)),
            ingest.bronze_air_quality(documents(aq)),
        )

    before = bronze([weather_line(0, 30), weather_line(40, 31)], [pws_line("I1", 40, 20)], [aq_line(0, "58**"), aq_line(40, "9*")])
    # Of the second day: a late hour, a corrected value, and a station more. The first day is as it was.
    after = bronze(
        [weather_line(0, 30), weather_line(40, 33), weather_line(41, 32)],
        [pws_line("I1", 40, 20), pws_line("I2", 40, 26)],
        [aq_line(0, "58**"), aq_line(40, "60*")],
    )
    run(before, seeds, str(tmp_path / "kept"))
    refreshed = refresh_days(after, seeds, str(tmp_path / "kept"), date(2024, 1, 3), date(2024, 1, 3))
    rebuilt = run(after, seeds, str(tmp_path / "fresh"))
    for name, df in refreshed.items():
        assert rows(df.select(rebuilt[name].columns)) == rows(rebuilt[name]), name


def test_landing_to_marts_twice(spark, tmp_path):
    """Stream landed files into bronze, run all models, add late files, run again: equal to a full run."""
    landing, root, seeds_folder = tmp_path / "landing", tmp_path / "tables", tmp_path / "seeds"
    for name, columns in SEEDS.items():
        writers.write_csv(spark.createDataFrame(SEED_ROWS[name], columns), f"{seeds_folder}/{name}.csv")
    seeds = Seeds.read(spark, str(seeds_folder))
    loads = {
        "hourly_weather": ingest.bronze_weather,
        "hourly_pws_weather": ingest.bronze_pws,
        "hourly_air_quality": ingest.bronze_air_quality,
    }

    def land(batch, weather, pws, aq):
        for name, lines in zip(loads, (weather, pws, aq)):
            (landing / name).mkdir(parents=True, exist_ok=True)
            (landing / name / f"{batch}.json").write_text("\n".join(lines))
        for name, to_bronze in loads.items():
            for _ in range(2):  # the second load finds nothing new
                ingest.ingest(
                    spark, f"{landing}/{name}", f"{root}/prod/{name}", f"{root}/checkpoints/{name}", to_bronze
                ).awaitTermination()

    def run_models(warehouse):
        return run(Bronze.read(spark, str(root)), seeds, str(tmp_path / warehouse))

    land(
        1,
        [weather_line(0, 30), weather_line(5, 31)],
        [pws_line("I1", 0, 20), pws_line("I2", 0, 20), pws_line("IX", 0, 20)],
        [aq_line(0, "58**")],
    )
    run_models("growing")
    first = {name: df.count() for name, df in run_models("growing").items()}
    assert (first["weather"], first["personal_weather"], first["air_quality"]) == (2, 3, 1)
    land(2, [weather_line(2, 32)], [pws_line("I2", 0, 28), pws_line("IX", 1, 20)], [aq_line(0, "58**"), aq_line(1, "60**")])
    grown, rebuilt = run_models("growing"), run_models("fresh")
    for name in rebuilt:
        columns = [column for column in rebuilt[name].columns if column != "date"]
        assert rows(grown[name].select(columns)) == rows(rebuilt[name].select(columns)), name
    noonless = rebuilt["full_weather_places"].filter("place = 'p1' and hour(datetime) = 8").first()
    assert noonless.temperature == ((20 + 20 + 28) / 3 + 30) / 2
    assert noonless.pollutant_value == 58.0


def test_what_a_load_leaves_out_is_in_its_quarantine(spark, tmp_path):
    """Accepted, quarantined and empty responses are all that landed, also after a second load and a second file."""
    refused = weather_line(3, 30).replace("200", "404")
    empty = json.dumps({"WMKK:9:MY": {"metadata": {"status_code": 200, "language": "en-US", "units": "m"}, "observations": []}})
    lines = {
        ingest.bronze_weather: [weather_line(0, 30), weather_line(1, 30)[:60], refused, empty, weather_line(2, 31).replace("WMKK:9", "WSSS:9"), ""],
        ingest.bronze_pws: [pws_line("I1", 0, 20), pws_line("I2", 0, 20)[:30], pws_line("I3", 0, 20).replace('{"I3"', '{"I4"')],
        ingest.bronze_air_quality: [aq_line(0, "58**"), aq_line(1, "9*")[:25]],
    }
    expected = {
        ingest.bronze_weather: ["broken", "mismatch", "refused"],
        ingest.bronze_pws: ["broken", "mismatch"],
        ingest.bronze_air_quality: ["broken"],
    }
    for to_bronze, landed in lines.items():
        root = tmp_path / to_bronze.__name__
        (root / "landing").mkdir(parents=True)
        for times in (1, 2):
            (root / "landing" / f"{times}.json").write_text("\n".join(landed))
            for _ in range(2):  # the second load finds nothing new
                ingest.ingest(spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint", to_bronze).awaitTermination()
            out = spark.read.parquet(f"{root}/table_quarantine").collect()
            assert sorted(r["reason"] for r in out) == sorted(expected[to_bronze] * times)
            assert {r["value"] for r in out if r["reason"] == "broken"} == {landed[1]}
            accepted = spark.read.parquet(f"{root}/table").count()
            n_empty = times * sum(line in ("", empty) for line in landed)
            assert accepted == times and accepted + len(out) + n_empty == times * len(landed)
