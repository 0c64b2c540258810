"""One station holds a third of all rows: results stay whole and no step gathers it in one task."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from atmolake.operators import aggregates, flatten, lookups, quality
from atmolake.plans import core

ROWS = 300_000


@pytest.fixture(scope="module")
def readings(spark):
    hot = F.col("id") < ROWS // 3
    return spark.range(ROWS).select(
        "id",
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("id") / 7)).alias("station"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") / 100).cast("int"))).alias("datetime"),
        (F.col("id") / 10).alias("value"),
    )


def largest_reduce_input(df) -> int:
    """Rows in the fullest partition after the first shuffle of the plan."""
    return df.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().agg(F.max("count")).first()[0]


def test_hot_value_is_combined_before_the_shuffle(spark, readings):
    parent = spark.createDataFrame([("nobody",)], "name string")
    orphans = quality.relationships(readings, "station", parent, "name")
    assert orphans.filter("value = 'hot'").first().rows == ROWS // 3
    assert orphans.agg(F.sum("rows")).first()[0] == ROWS
    plan = orphans._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("HashAggregate")  # the join is above the aggregation


def test_repeats_of_a_hot_value_spread_over_tasks(spark, readings):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        repeated = aggregates.repeated_rows(readings, "station", "id")
        expected = ROWS - readings.select("station").distinct().count()
        assert repeated.count() == expected
        assert largest_reduce_input(repeated) < 2 * expected / 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_shuffled_lookup_splits_a_hot_station(spark, readings):
    """Beyond the broadcast limit the adaptive plan must cut the partition of the hot station."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        noisy = readings.withColumn("noise", F.sha2(F.col("id").cast("string"), 256))
        # One row per station: the last hot row and all others.
        dim = readings.filter(F.col("id") >= ROWS // 3 - 1).select(F.col("station").alias("name"), F.length("station").alias("n"))
        placed = lookups.lookup_left(noisy, lookups.broadcast_if_small(dim, max_bytes=1), {"station": "name"}, ["n"])
        result = placed.groupBy("n").agg(F.count("*").alias("rows"), F.max("noise").alias("last"))
        assert result.agg(F.sum("rows")).first()[0] == ROWS
        result.collect()
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_last_response_of_a_hot_station(readings):
    last = flatten.merge_last_wins(readings, "station", ["id"])
    assert last.filter("station = 'hot'").first().id == ROWS // 3 - 1
    # The payload is in no aggregation.
    payload = flatten.merge_last_wins(readings.withColumn("payload", F.repeat("station", 9)), "station", ["id"])
    plan = payload._jdf.queryExecution().executedPlan().toString()
    assert "payload" in plan and not any("payload" in line for line in plan.splitlines() if "Aggregate" in line or "partial_max" in line)


def test_busy_hour_does_not_multiply(spark):
    """3000 rows of each source in one hour and place: joined naively, 27 billion rows."""
    place = [F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("datetime")]
    place += [F.lit(name).alias(name) for name in ("place", "city", "state")]
    value = (F.col("id") / 2).cast("double")
    base = spark.range(3000)
    w = base.select(*place, *[value.alias(n) for n in [*core.BLENDED.values(), *core.WEATHER_ONLY]])
    a = base.select(*place, value.alias("pollutant_value"))
    p = base.select(*place, *[value.alias(n) for n in [*core.BLENDED, *core.PWS_ONLY]])
    for form in (core.source_averages, core.full_join_sources):
        row = form(w, a, p).first()
        assert row.weather_temperature == row.pws_gust == row.pollutant_value == 2999 / 4
