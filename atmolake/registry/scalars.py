"""Queries of the scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from atmolake.functions import casts, text, times
from atmolake.operators.calendar import daily_slice as slice_of_day
from atmolake.registry import inputs
from atmolake.registry.base import query, read


@query("""
SELECT event_id, CAST(ts AS DATE) AS request_date, label,
       CASE WHEN label = '12:00AM' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
            ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 1 DAY + to_hours(hour(ts)) END AS datetime
FROM (SELECT *, CASE WHEN hour(ts) = 0 THEN '12:00AM' WHEN hour(ts) < 12 THEN hour(ts) || ':00AM'
                     WHEN hour(ts) = 12 THEN '12:00PM' ELSE (hour(ts) - 12) || ':00PM' END AS label FROM events)""")
def legacy_hour_to_datetime(spark, sf_dir):
    labelled = read(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("request_date"), F.date_format(F.date_trunc("hour", "ts"), "h:mma").alias("label")
    )
    moment = times.legacy_hour_to_datetime(F.col("request_date"), F.col("label"))
    return labelled.withColumn("datetime", moment)


@query("""
SELECT event_id, strftime(ts, '%H%M') AS hhmm,
       CASE WHEN minute(ts) = 0 THEN strftime(ts, '%H00') ELSE strftime(ts + INTERVAL 1 HOUR, '%H00') END AS full_hour
FROM events""")
def ceil_to_hour_hhmm(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "HHmm").alias("hhmm"))
    return events.withColumn("full_hour", times.ceil_to_hour_hhmm(F.col("hhmm")))


@query("""
SELECT location, datetime, value,
       CASE WHEN value = 'N/A' THEN NULL WHEN symbol = '**' THEN 'PM2.5' WHEN symbol = '*' THEN 'PM10' WHEN symbol = 'a' THEN 'SO2'
            WHEN symbol = '&' THEN 'multi-pollutant' ELSE 'unknown' END AS pollutant,
       CASE WHEN value = 'N/A' THEN NULL WHEN symbol IN ('**', '*') THEN 'ug/m3' WHEN symbol = 'a' THEN 'ppm' END AS unit,
       TRY_CAST(regexp_extract(value, '[0-9]+') AS BIGINT) AS number
FROM (SELECT *, regexp_replace(value, '[0-9]+', '', 'g') AS symbol FROM hourly_air_quality)""")
def pollutant_token(spark, sf_dir):
    aq = inputs.hourly_air_quality(spark, sf_dir).withColumn("token", text.pollutant_token(F.col("value")))
    return aq.select("location", "datetime", "value", "token.*")


@query("""
SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'""")
def daily_slice(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "ts", "value")
    return slice_of_day(events, "ts", datetime(2024, 1, 15, 17, 30))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def yyyymmdd_to_iso(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("compact"))
    return orders.withColumn("iso", times.yyyymmdd_to_iso(F.col("compact")))


@query("""
SELECT c_custkey, split_part(c_name, '#', 1) AS before_hash, split_part(c_name, ',', 1) AS no_comma,
       c_mktsegment AS before_colon FROM customer""")
def first_segment(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        text.first_segment(F.col("c_name"), "#").alias("before_hash"),
        text.first_segment(F.col("c_name"), ",").alias("no_comma"),
        text.first_segment(F.concat("c_mktsegment", F.lit(":9:MY")), ":").alias("before_colon"),
    )


@query("SELECT event_id, date_trunc('second', ts) AS datetime FROM events")
def parse_iso_datetime(spark, sf_dir):
    written = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return read(spark, sf_dir, "events").select("event_id", times.parse_iso_datetime(written).alias("datetime"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def parse_yyyymmdd(spark, sf_dir):
    written = F.date_format("o_orderdate", "yyyyMMdd")
    return read(spark, sf_dir, "orders").select("o_orderkey", times.parse_yyyymmdd(written).alias("day"))


# Fixed-point formatting rounds the exact binary value, which round() does not.
@query("SELECT event_id, CAST(format('{:.3f}', value / 8) AS DOUBLE) AS rounded FROM events")
def round3(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", casts.round_exact(F.col("value") / 8, 3).alias("rounded"))


@query("SELECT weather_station, pressure_desc, lower(pressure_desc) = 'none' AS is_none FROM hourly_weather")
def lower_compare(spark, sf_dir):
    weather = inputs.hourly_weather(spark, sf_dir).select("weather_station", "pressure_desc")
    return weather.withColumn("is_none", text.same_text(F.col("pressure_desc"), "none"))


@query("""
SELECT c_custkey, rtrim(c_name, '0123456789[]') AS stripped, rtrim(c_mktsegment || '[' || c_custkey || ']', '0123456789[]') AS noted
FROM customer""")
def strip_trailing_chars(spark, sf_dir):
    noted = F.concat("c_mktsegment", F.lit("["), F.col("c_custkey").cast("string"), F.lit("]"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        text.strip_trailing_digits_and_brackets(F.col("c_name")).alias("stripped"),
        text.strip_trailing_digits_and_brackets(noted).alias("noted"),
    )
