"""Date spines, chunks and gaps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake.fixed_values import MAX_REQUEST_DAYS
from atmolake.functions.times import local_day


def spine_of(start: Column, end: Column) -> Column:
    """Array of all days from start to end, both included; empty if end is before start."""
    days = F.sequence(start, end, F.expr("interval 1 day"))
    return F.when(start <= end, days).otherwise(F.array().cast("array<date>"))


def chunks_of(start: Column, end: Column, n: int) -> Column:
    """Array of struct(chunk_start, chunk_end), each of n + 1 days, the last one cut at the end."""
    starts = F.when(start <= end, F.sequence(start, end, F.expr(f"interval {n + 1} days"))).otherwise(
        F.array().cast("array<date>")
    )
    return F.transform(
        starts,
        lambda first: F.struct(
            first.alias("chunk_start"), F.least(F.date_add(first, n), end).alias("chunk_end")
        ),
    )


def _day(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    return spark.range(1).select(F.explode(spine_of(_day(start), _day(end))).alias("day"))


def date_chunks(spark: SparkSession, start: date, end: date, n: int = 30) -> DataFrame:
    return spark.range(1).select(F.inline(chunks_of(_day(start), _day(end), n)))


def day_range(df: DataFrame, day: str) -> DataFrame:
    """One row, `first_day` and `last_day` of a date or timestamp column."""
    return df.agg(F.min(day).cast("date").alias("first_day"), F.max(day).cast("date").alias("last_day"))


def missing_days(df: DataFrame, day: str, start: date, end: date, by: list[str] | None = None) -> DataFrame:
    """Days of a closed range without any row; per combination of `by` if given."""
    by = by or []
    present = df.select(*by, F.col(day).cast("date").alias("day")).distinct()
    owners = present.select(*by).distinct() if by else df.sparkSession.range(1)
    spine = owners.select(*by, F.explode(spine_of(_day(start), _day(end))).alias("day"))
    return spine.join(present, [*by, "day"], "left_anti")


def missing_days_in_own_range(df: DataFrame, day: str) -> DataFrame:
    """Days between the first and the last one of the data itself that have no row."""
    present = df.select(F.col(day).cast("date").alias("day")).distinct()
    spine = day_range(present, "day").select(F.explode(spine_of(F.col("first_day"), F.col("last_day"))).alias("day"))
    return spine.join(present, "day", "left_anti")


def backfill_manifest(
    stations: DataFrame, landed: DataFrame, start: date, end: date, n: int = 30, station: str = "station"
) -> DataFrame:
    """Station and chunk pairs still to fetch.

    Each station row unfolds the chunks of the date range, so no cross join is needed.
    """
    work = stations.select(station, F.inline(chunks_of(_day(start), _day(end), n)))
    return work.join(landed, [station, "chunk_start", "chunk_end"], "left_anti")


def span_allowed(start: Column, end: Column, days: int = MAX_REQUEST_DAYS) -> Column:
    """Whether a request spans at most `days` days from start to end; NULL for unknown dates."""
    return F.datediff(end, start) <= days


def judged_spans(requests: DataFrame, start: str, end: str, days: int = MAX_REQUEST_DAYS) -> DataFrame:
    """All requests with `accepted`, in one pass; never NULL."""
    return requests.withColumn("accepted", F.coalesce(span_allowed(F.col(start), F.col(end), days), F.lit(False)))


def max_span_guard(
    requests: DataFrame, start: str, end: str, days: int = MAX_REQUEST_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected requests; each part computes the requests anew, `judged_spans` has both at once."""
    allowed = F.coalesce(span_allowed(F.col(start), F.col(end), days), F.lit(False))
    return requests.filter(allowed), requests.filter(~allowed)


def daily_slice(df: DataFrame, datetime: str, now_utc, days_prior: int = 1) -> DataFrame:
    """Rows of the local day `days_prior` days before `now_utc`.

    The day is turned into a range on the column itself, so the filter reaches the scan.
    """
    day = local_day(now_utc, days_prior)
    first = day.cast("timestamp_ntz")
    return df.filter((F.col(datetime) >= first) & (F.col(datetime) < F.date_add(day, 1).cast("timestamp_ntz")))
