"""Queries of file and table sources, sinks and materializations: write to shared scratch, read back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from atmolake.registry import inputs
from atmolake.registry.base import query, read
from atmolake.registry.core import built
from atmolake.registry.landing import wide_readings
from atmolake.session import scratch_path
from atmolake.sinks import catalog, materialize, writers
from atmolake.sources import csv_files, tables

_ORDERS = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus FROM orders"


def orders_of(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(*_ORDERS)


# --- sources ------------------------------------------------------------------------------------


@query("SELECT * FROM wide_readings")
def scan_wide_csv(spark, sf_dir):
    path = scratch_path(spark, "wide-csv")
    writers.write_csv(wide_readings(spark, sf_dir), path)
    return csv_files.scan_wide_csv(spark, path)


@query("SELECT * FROM city_places")
def scan_seed_csv(spark, sf_dir):
    path = scratch_path(spark, "seed")
    writers.write_csv(inputs.city_places(spark, sf_dir), path)
    return csv_files.scan_seed(spark, path, "city_places")


@query("SELECT location, datetime, value FROM hourly_air_quality")
def scan_table_env(spark, sf_dir):
    root = scratch_path(spark, "env")
    aq = inputs.hourly_air_quality(spark, sf_dir)
    writers.append_table(aq.filter(F.col("value") == "N/A"), f"{root}/dev/hourly_air_quality")
    writers.append_table(aq, f"{root}/prod/hourly_air_quality")
    return tables.source(spark, "hourly_air_quality", root)


@query("""
SELECT 'City ' || s_nationkey AS City, 'State ' || s_nationkey AS State, 'Supplier#' AS Weather_station_name, 'S' || s_suppkey AS ICAO,
       s_nationkey || '°' || s_suppkey || '''' AS Coordinates FROM supplier""")
def read_airports_csv(spark, sf_dir):
    path = scratch_path(spark, "airports")
    # The raw list has non-breaking spaces, primes, aliases after a slash and footnote marks.
    raw = read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("City "), "s_nationkey").alias("City served"),
        F.concat(F.lit("State "), "s_nationkey").alias("State"),
        F.concat(F.lit(" "), "s_name", F.lit("[3] / alias "), "s_suppkey").alias("Airport name"),
        F.concat(F.lit("S"), "s_suppkey").alias("ICAO"),
        F.concat("s_nationkey", F.lit("°"), "s_suppkey", F.lit("′")).alias("Coordinates"),
    )
    writers.write_csv(raw, path)
    return csv_files.read_airports_csv(spark, path)


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS aq_date FROM orders")
def read_date_export_csv(spark, sf_dir):
    path = scratch_path(spark, "dates")
    writers.write_csv(read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("aq_date")), path)
    return csv_files.read_date_export_csv(spark, path, "aq_date")


# --- sinks --------------------------------------------------------------------------------------


@query(f"SELECT *, CAST(o_orderdate AS DATE) AS date FROM ({_ORDERS_SQL})")
def write_parquet(spark, sf_dir):
    path = writers.object_path(scratch_path(spark, "parquet"), "orders of all days", "parquet")
    by_month = orders_of(spark, sf_dir).withColumn("year", F.year("o_orderdate"))
    writers.write_parquet(by_month.hint("rebalance", "year"), path, ["year"])
    return materialize.read_table(spark, path).select(*_ORDERS, F.to_date("o_orderdate").alias("date"))


@query(_ORDERS_SQL)
def write_json(spark, sf_dir):
    path = writers.object_path(scratch_path(spark, "json"), "orders", "json", mobile=True)
    orders = orders_of(spark, sf_dir)
    writers.write_json(orders, path)
    return spark.read.schema(orders.schema).json(path)


@query(_ORDERS_SQL)
def write_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    orders = orders_of(spark, sf_dir)
    writers.write_csv(orders, path)
    return spark.read.csv(path, header=True, schema=orders.schema)


@query(f"{_ORDERS_SQL} UNION ALL {_ORDERS_SQL}")
def append_table(spark, sf_dir):
    path = scratch_path(spark, "append")
    writers.append_table(orders_of(spark, sf_dir), path)
    writers.append_table(orders_of(spark, sf_dir), path)
    return materialize.read_table(spark, path)


@query(_ORDERS_SQL)
def replace_table(spark, sf_dir):
    path = scratch_path(spark, "replace")
    orders = orders_of(spark, sf_dir)
    writers.append_table(orders.withColumn("o_totalprice", F.lit(0.0)), path)
    writers.replace_table(orders, path)
    return materialize.read_table(spark, path)


@query(f"""
SELECT 'dev' AS env, * FROM ({_ORDERS_SQL}) UNION ALL SELECT 'dev', * FROM ({_ORDERS_SQL} WHERE o_orderstatus = 'F')
UNION ALL SELECT 'prod', o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def catalog_tables(spark, sf_dir):
    """Tables by name: append twice in one environment, replace by what the table itself has in the other."""
    catalog.ensure_environments(spark, scratch_path(spark, "catalog"))
    name, orders = f"orders_{uuid.uuid4().hex}", orders_of(spark, sf_dir).withColumn("year", F.year("o_orderdate"))
    for rows in (orders, orders.filter("o_orderstatus = 'F'")):
        catalog.load(rows.hint("rebalance", "year"), "dev", name, ["year"])
    catalog.load(orders, "prod", name)
    catalog.load(tables.scan_table(spark, "prod", name).filter("o_orderstatus <> 'F'"), "prod", name, ["year"], append_rows=False)
    found = [tables.scan_table(spark, env, name).select(F.lit(env).alias("env"), *_ORDERS) for env in ("dev", "prod")]
    return found[0].unionByName(found[1])


@query("SELECT day, count(*) AS readings FROM (SELECT CAST(ts AS DATE) AS day FROM events) GROUP BY day")
def materialize_view(spark, sf_dir):
    days = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    materialize.materialize_view(days, "atmolake_event_days")
    return spark.sql("SELECT day, count(*) AS readings FROM atmolake_event_days GROUP BY day")


@query("SELECT * FROM locations")
def materialize_table(spark, sf_dir):
    return materialize.materialize_table(built(spark, sf_dir).full_locations, scratch_path(spark, "table"))


@query("""
SELECT mode, event_id, ts, value FROM events, (VALUES ('per_key'), ('global'), ('per_row')) AS m(mode)
WHERE mode <> 'global' OR event_type <> 'view' OR ts > TIMESTAMP '2024-01-20 00:00:00'""")
def incremental_append(spark, sf_dir):
    """Load all events but the views up to the 20th, then all events: the high mark loses those views."""
    everything = read(spark, sf_dir, "events").select("event_id", "ts", "value", "event_type")
    early = F.col("ts") <= F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz")
    first = everything.filter(early & (F.col("event_type") != "view"))
    results = []
    for mode in ("per_key", "global", "per_row"):
        path = scratch_path(spark, f"incremental-{mode}")
        for batch in (first, everything):
            materialize.incremental_append(batch, path, "ts", ["event_id"], mode)
        loaded = materialize.read_table(spark, path)
        results.append(loaded.select(F.lit(mode).alias("mode"), "event_id", "ts", "value"))
    return results[0].unionByName(results[1]).unionByName(results[2])
