"""What a task holds does not grow with the tables: figures of plans over rows made here."""

from datetime import datetime

from pyspark.sql import functions as F

from atmolake.functions.casts import apart
from atmolake.operators.staging import stage_pws, stage_weather
from atmolake.plans import checks, core, marts
from atmolake.plans.models import BRONZE_TABLES, MODEL_NAMES, Bronze, Models
from atmolake.registry import base, inputs, relations
from atmolake.registry.base import QUERIES
from atmolake.schemas import BRONZE_PWS, BRONZE_WEATHER
from atmolake.sources import landing
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def customers(spark, path, n):
    key = F.col("id")
    spark.range(n).coalesce(1).select(
        key.alias("c_custkey"),
        F.lit("name").alias("c_name"),
        (key % 25).cast("int").alias("c_nationkey"),
        F.lit(1.5).alias("c_acctbal"),
        F.when(key % 2 == 0, "BUILDING").otherwise("MACHINERY").alias("c_mktsegment"),
    ).write.parquet(f"{path}/customer.parquet")


def test_matrices_of_one_file_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    customers(spark, tmp_path, 64)
    monkeypatch.setattr(base, "ROWS_PER_TASK", 10, raising=False)
    for documents in (inputs.matrix_documents, inputs.landed_matrices):
        assert documents(spark, str(tmp_path)).rdd.getNumPartitions() == 7
    choice = QUERIES["header_order_choice"](spark, str(tmp_path))
    # Landed are files by the first five bits of the number, with a right header by the bits after them.
    def expected(n):
        right = {i for i in range(5) if n >> i & 1 and not n >> (i + 5) & 1}
        return next((inputs.LANDED_TIMES[i] for i in (1, 4, 3, 0) if i in right), None)
    assert rows(choice) == sorted(((n, expected(n)) for n in range(64) if n & 31), key=repr)
    assert len(rows(QUERIES["header_order_check"](spark, str(tmp_path)))) == 64
    # Headers are known where they are right, so the grouping does not carry them; the keys are dealt once.
    for line in plan(choice).splitlines():
        assert "min_by" not in line or "header" not in line
    assert "ENSURE_REQUIREMENTS" not in plan(choice)


def test_spans_are_judged_in_one_join(spark, tmp_path):
    day = lambda n: datetime(2024, 1, 1 + n)
    orders = [(1, day(0)), (2, None), (2, day(1)), (3, day(2))]
    lines = [(1, 1, day(30)), (1, 1, day(30)), (1, 2, datetime(2024, 3, 1)), (2, 1, day(3)), (None, 1, day(3)), (4, 1, day(3))]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    judged = QUERIES["max_span_guard"](spark, str(tmp_path))
    assert [(row[0], row[1], row[4]) for row in rows(judged)] == [(1, 1, True), (1, 1, True), (1, 2, False), (2, 1, False), (2, 1, True)]
    assert "Union" not in plan(judged)


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    monkeypatch.setattr(marts, "ROWS_PER_BUCKET", 10, raising=False)
    empty = spark.createDataFrame([], "datetime string")
    for n, buckets in ((0, 8), (80, 8), (81, 9), (1000, 100)):
        models = Models(Bronze(spark.range(n), empty, empty), None)
        assert marts.buckets_for(models) == buckets


def test_wide_staging_is_compiled_column_by_column(spark):
    """One method for all columns is too long for the JIT compiler; it would be a whole-stage projection, marked by a star."""
    for stage, columns in ((stage_weather, BRONZE_WEATHER), (stage_pws, BRONZE_PWS)):
        texts = [F.when(F.col("id") >= 0, F.lit("2024-01-01" if name == "datetime" else "7")).alias(name) for name in columns]
        staged = stage(spark.range(3).select(*texts))
        typed = [line for line in plan(staged).splitlines() if "Project" in line and "AS temperature" in line and "transform(" in line]
        assert typed and not any("*(" in line for line in typed)
        assert [row.temperature for row in staged.collect()] == [7.0] * 3


def test_a_value_apart_is_the_same(spark):
    values = spark.createDataFrame([(1.5,), (None,), (float("nan"),)], "v double").select(apart(F.col("v")).alias("v"))
    assert repr([row.v for row in values.collect()]) == "[1.5, None, nan]"


def test_sources_are_averaged_before_they_meet(spark):
    def source(names, *given):
        keys = {"datetime": "2024-01-01", "place": None, "city": "c", "state": "s"}
        columns = [F.lit(value).cast("timestamp_ntz" if key == "datetime" else "string").alias(key) for key, value in keys.items()]
        return spark.createDataFrame([(float(v),) for v in given], "v double").select(*columns, *[F.col("v").alias(name) for name in names])

    weather = source([*core.BLENDED.values(), *core.WEATHER_ONLY], 1, 2, 6)
    personal = source([*core.BLENDED, *core.PWS_ONLY], 5, 6)
    averages = core.source_averages(weather, source(["pollutant_value"], 4), personal)
    # Sums of a source are shuffled with its own rows only: no partial sum has columns of two sources.
    partial = [line for line in plan(averages).splitlines() if "partial_avg" in line]
    assert partial and not any("weather_" in line and "pws_" in line for line in partial)
    (row,) = averages.collect()
    assert (row.weather_temperature, row.pws_temperature, row.pollutant_value, row.visibility) == (3.0, 5.5, 4.0, 3.0)


def events(spark, path, n):
    key = F.col("id")
    spark.range(n).coalesce(1).select(
        key.alias("event_id"),
        F.lit(datetime(2024, 1, 2, 3, 4)).cast("timestamp_ntz").alias("ts"),
        (key % 7).alias("user_id"),
        F.when(key % 2 == 0, "view").otherwise("error").alias("event_type"),
        (key + 50).cast("double").alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(f"{path}/events.parquet")


def test_documents_are_dealt_to_tasks_and_made_once(spark, tmp_path, monkeypatch):
    events(spark, tmp_path, 44)
    monkeypatch.setattr(base, "ROWS_PER_TASK", 10)
    aside = QUERIES["quarantined_documents"](spark, str(tmp_path))
    assert aside.rdd.getNumPartitions() == 5
    assert aside._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 1
    broken = [(n, "broken", None) for n in range(0, 44, 11)]
    refused = [(n, "refused", f"U{n % 7}:9:MY") for n in range(44) if n % 11 and n % 2 and n > 10]
    assert rows(aside) == sorted(broken + refused, key=repr)


def test_blank_and_missing_documents_are_none(spark):
    documents = spark.createDataFrame([(1, None), (2, ""), (3, " \t"), (4, "  "), (5, "{}")], "n int, value string")
    opened = landing.open_maps(documents, landing.RESPONSES["weather"], "n").select("n", "document")
    assert rows(opened) == [(3, "broken"), (5, "empty")]


def test_averages_that_two_joins_read_are_computed_once(spark):
    joined = QUERIES["full_outer_join_3way"](spark, "/root/testdata/sf0.001")
    assert not [path for path in joined.inputFiles() if path.endswith("lineitem.parquet")]


def test_declared_checks_write_the_columns_that_somebody_reads(spark, tmp_path, monkeypatch):
    """Others would be cast, averaged and written for each row and read by nothing; the report is that of the whole models."""
    def write(table, rows):
        spark.createDataFrame(rows, base.TABLES[table]).write.parquet(f"{tmp_path}/{table}.parquet")

    day = lambda n: datetime(2024, 1, 1 + n)
    write("region", [(0, "R")])
    write("nation", [(n, f"N{n}", 0) for n in range(3)])
    write("customer", [(i, "c", i % 3, float(i * 900 - 800), "BUILDING" if i % 2 else "X") for i in range(9)] + [(1, "again", 1, 5.0, "X")])
    write("supplier", [(i, "s", i % 3, float(i * 2000 - 1500)) for i in range(5)] + [(None, None, None, None), (2, "again", 2, 5.0)])
    write("part", [(1, "p", "b", "t", 1, 1.0)])
    write("orders", [(i, i % 11, "OFP"[i % 3], 1000.0 + i * 7000, day(i % 4) if i % 9 else None, f"{i % 5 + 1}-X") for i in range(60)] * 2)
    write("lineitem", [(i, 1, i % 7, i % 7 + 1, float(i % 51), 20000.0 + i * 900, i % 11 / 100, i % 9 / 100, "NAR"[i % 3], "OF"[i % 2], day(i % 4) if i % 8 else None) for i in range(90)] * 2)
    written = {}
    materialize = relations.materialize_table
    monkeypatch.setattr(relations, "materialize_table", lambda df, path: written.update({path.rsplit("/")[-1]: df.columns}) or materialize(df, path))
    report = rows(QUERIES["dq_declared"](spark, str(tmp_path)))
    assert written["stg_hourly_weather"] == written["stg_hourly_pws_weather"] == ["datetime", "weather_station"]
    assert written["full_weather_places"] == ["datetime", "place", "city", "state", "temperature", "uv_index", "pollutant_value"]
    assert "wind_direction_dir" not in written["weather"] and "personal_weather" not in written and "long_description" not in written["uv"]
    models = Models(inputs.bronze(spark, str(tmp_path)), inputs.seeds(spark, str(tmp_path)))
    tables = {f"{env}.{name}": df for env in ("dev", "prod") for name, df in vars(models.bronze).items() if name in BRONZE_TABLES}
    whole = checks.report({**tables, **vars(models.seeds), **{name: getattr(models, name) for name in MODEL_NAMES}})
    assert report == rows(whole) and len(report) == 74 and sum(row[3] > 0 for row in report) > 20
