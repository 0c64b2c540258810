from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from atmolake.operators import calendar, quality
from tests.conftest import rows


def compact(first: str, last: str):
    return tuple(datetime.strptime(text, "%Y%m%d").date() for text in (first, last))


@pytest.mark.parametrize(
    "span, chunks",
    [
        (("20210101", "20210129"), [("20210101", "20210129")]),
        (("20210101", "20210131"), [("20210101", "20210131")]),
        (("20210101", "20210202"), [("20210101", "20210131"), ("20210201", "20210202")]),
        (
            ("20230101", "20230527"),
            [("20230101", "20230131"), ("20230201", "20230303"), ("20230304", "20230403"), ("20230404", "20230504"), ("20230505", "20230527")],
        ),
        (("20210102", "20210101"), []),
    ],
)
def test_date_chunks(spark, span, chunks):
    assert rows(calendar.date_chunks(spark, *compact(*span))) == [compact(*chunk) for chunk in chunks]


def test_daily_chunks_are_the_spine(spark):
    span = (date(2024, 2, 27), date(2024, 3, 2))
    days = rows(calendar.date_spine(spark, *span))
    assert len(days) == 5
    assert [(day, day) for (day,) in days] == rows(calendar.date_chunks(spark, *span, n=0))
    assert rows(calendar.date_spine(spark, span[1], span[0])) == []


def test_missing_days(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1)), ("a", date(2024, 1, 4)), ("b", date(2024, 1, 2))], "k string, d date")
    span = (date(2024, 1, 1), date(2024, 1, 3))
    assert rows(calendar.missing_days(df, "d", *span)) == [(date(2024, 1, 3),)]
    assert rows(calendar.missing_days(df, "d", *span, by=["k"])) == [
        ("a", date(2024, 1, 2)), ("a", date(2024, 1, 3)), ("b", date(2024, 1, 1)), ("b", date(2024, 1, 3)),
    ]
    assert rows(calendar.missing_days_in_own_range(df, "d")) == [(date(2024, 1, 3),)]


def test_backfill_manifest(spark):
    stations = spark.createDataFrame([("A",), ("B",)], "station string")
    landed = spark.createDataFrame(
        [("A", date(2024, 1, 1), date(2024, 1, 31))], "station string, chunk_start date, chunk_end date"
    )
    work = calendar.backfill_manifest(stations, landed, date(2024, 1, 1), date(2024, 2, 2))
    assert rows(work) == [
        ("A", date(2024, 2, 1), date(2024, 2, 2)), ("B", date(2024, 1, 1), date(2024, 1, 31)), ("B", date(2024, 2, 1), date(2024, 2, 2)),
    ]
    assert "CartesianProduct" not in work._jdf.queryExecution().executedPlan().toString()


def test_span_guard(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), date(2024, 2, 1)), (date(2024, 1, 1), date(2024, 2, 2)), (date(2024, 1, 1), None)], "a date, b date")
    accepted, rejected = calendar.max_span_guard(df, "a", "b")
    assert (accepted.count(), rejected.count()) == (1, 2)


def test_daily_slice_reaches_the_scan(spark, tmp_path):
    df = spark.range(96).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("datetime"))
    df.write.parquet(str(tmp_path / "t"))
    part = calendar.daily_slice(spark.read.parquet(str(tmp_path / "t")), "datetime", datetime(2024, 1, 2, 20))
    got = [row.datetime for row in part.collect()]
    assert len(got) == 24 and {moment.date() for moment in got} == {date(2024, 1, 2)}
    assert "GreaterThanOrEqual(datetime,2024-01-02" in part._jdf.queryExecution().executedPlan().toString()


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (None, "b", None), (None, "b", "z"), (2, None, "q")], "n int, k string, v string")
    parent = spark.createDataFrame([("a",), ("a",)], "name string")
    assert rows(quality.not_null(df, ["n", "k"])) == [("k", 1), ("n", 2)]
    assert rows(quality.unique(df, "n")) == [(1, 2)]
    assert rows(quality.unique_combination(df, ["n", "k"])) == [(1, "a", 2), (None, "b", 2)]
    assert rows(quality.relationships(df, "k", parent, "name")) == [("b", 2)]
    assert rows(quality.accepted_values(df, "v", ["x", "z"])) == [("q", 1)]
    report = quality.dq_report(
        [
            quality.report_not_null("t", df, ["n", "k"]),
            quality.report_unique("t", df, "n"),
            quality.report_unique("t", df.limit(0), "n"),
            quality.report_unique_combination("t", df, ["n", "k"]),
            quality.report_relationships("t", df, "k", parent, "name"),
            quality.report_accepted_values("t", df, "v", ["x", "z", "q"]),
        ]
    )
    assert report.columns == quality.REPORT_COLUMNS
    assert rows(report) == [
        ("t", "accepted_values", "v", 0), ("t", "not_null", "k", 1), ("t", "not_null", "n", 2), ("t", "relationships", "k", 2),
        ("t", "unique", "n", 0), ("t", "unique", "n", 1), ("t", "unique_combination", "n+k", 2),
    ]
