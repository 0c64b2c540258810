"""Queries of lookups, aggregates, calendars and data-quality checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from atmolake.fixed_values import ACCEPTED_LABELS, ACCEPTED_POLLUTANTS
from atmolake.operators import aggregates, calendar, lookups, quality
from atmolake.plans import checks, core
from atmolake.plans.checks import DECLARED
from atmolake.plans.models import BRONZE_TABLES, MODEL_NAMES
from atmolake.registry import inputs
from atmolake.registry.base import CTES, query, read, tasks_for
from atmolake.registry.core import built
from atmolake.registry.landing import wide_readings
from atmolake.session import scratch_path
from atmolake.sinks.materialize import materialize_table

# --- gaps and matches ---------------------------------------------------------------------------


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def anti_join_missing(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return lookups.missing_from(customers, read(spark, sf_dir, "events"), {"c_custkey": "user_id"})


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def semi_join_known(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookups.known_in(orders, read(spark, sf_dir, "events"), {"o_custkey": "user_id"})


@query("""
SELECT location FROM (SELECT DISTINCT location FROM wide_readings
                      UNPIVOT (value FOR location IN (click, error, purchase, signup, "view")))
WHERE location NOT IN (SELECT event_type FROM events WHERE value > 350)""")
def unknown_locations(spark, sf_dir):
    known = read(spark, sf_dir, "events").filter(F.col("value") > 350)
    return lookups.unknown_headers(wide_readings(spark, sf_dir), "Time", known, "event_type")


@query("""
SELECT DISTINCT 'P' || o_custkey AS station_id FROM orders
WHERE 'P' || o_custkey NOT IN (SELECT PWStation FROM state_locations WHERE PWStation IS NOT NULL)""")
def new_stations(spark, sf_dir):
    scanned = read(spark, sf_dir, "orders").select(F.concat(F.lit("P"), "o_custkey").alias("station_id")).distinct()
    return lookups.new_stations(scanned, inputs.state_locations(spark, sf_dir))


# --- aggregates ---------------------------------------------------------------------------------


@query("""
SELECT date_trunc('hour', ts) AS hour, user_id, event_type, round(avg(value), 6) AS value FROM events GROUP BY ALL""")
def group_avg(spark, sf_dir):
    hours = read(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    means = aggregates.group_avg(hours, ["hour", "user_id", "event_type"], ["value"])
    return means.withColumn("value", F.round("value", 6))


@query("""
SELECT CAST(ts AS DATE) AS day, event_type, round(avg(value), 6) AS value, max(user_id) AS user_id
FROM events GROUP BY ALL""")
def group_avg_max(spark, sf_dir):
    days = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rolled = aggregates.group_avg_max(days, ["day", "event_type"], ["value"], ["user_id"])
    return rolled.withColumn("value", F.round("value", 6))


@query("SELECT max(ts) AS ts FROM events")
def global_max(spark, sf_dir):
    return aggregates.global_max(read(spark, sf_dir, "events"), "ts")


@query("SELECT DISTINCT event_type, CAST(ts AS DATE) AS day, user_id FROM events")
def distinct(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "user_id").distinct()


@query("""
SELECT user_id, min(value) AS min_value, round(avg(value), 6) AS mean_value, max(value) AS max_value,
       avg(value) = 0 AS is_zero FROM events GROUP BY user_id""")
def min_mean_max_by_station(spark, sf_dir):
    stats = aggregates.station_stats(read(spark, sf_dir, "events"), "user_id", "value")
    return stats.withColumn("mean_value", F.round("mean_value", 6))


@query("""
SELECT "column", CAST(nulls AS BIGINT) AS nulls FROM (
  SELECT count(*) - count(Time) AS Time, count(*) - count(click) AS click, count(*) - count(error) AS error,
         count(*) - count(purchase) AS purchase, count(*) - count(signup) AS signup, count(*) - count("view") AS "view"
  FROM wide_readings) UNPIVOT (nulls FOR "column" IN (Time, click, error, purchase, signup, "view"))""")
def null_counts(spark, sf_dir):
    return aggregates.null_counts(wide_readings(spark, sf_dir))


@query("""
SELECT * FROM wide_readings
WHERE click IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL AND signup IS NOT NULL AND "view" IS NOT NULL""")
def dropna_any(spark, sf_dir):
    return wide_readings(spark, sf_dir).dropna("any")


@query("""
SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1""")
def duplicate_keys(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return aggregates.repeated_rows(orders, "o_custkey", "o_orderkey")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def drop_duplicates(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return aggregates.first_rows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey")
def sort(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_totalprice").orderBy("o_orderdate", "o_orderkey")


@query("SELECT event_id, ts, value FROM events ORDER BY value DESC, event_id LIMIT 1000")
def limit(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "ts", "value")
    return events.orderBy(F.desc("value"), "event_id").limit(1000)


# --- calendars ----------------------------------------------------------------------------------


def whole_range(df, day: str) -> tuple[date, date]:
    """First and last date of a table."""
    return calendar.day_range(df, day).first()


CTES["order_spine"] = """
SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders"""


@query("SELECT day FROM order_spine")
def date_spine(spark, sf_dir):
    return calendar.date_spine(spark, *whole_range(read(spark, sf_dir, "orders"), "o_orderdate"))


CTES["order_chunks"] = """
SELECT chunk_start, least(chunk_start + 30, last_day) AS chunk_end
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 31 DAY)) AS DATE) AS chunk_start,
             CAST(max(o_orderdate) AS DATE) AS last_day FROM orders)"""


@query("SELECT chunk_start, chunk_end FROM order_chunks")
def date_chunks(spark, sf_dir):
    return calendar.date_chunks(spark, *whole_range(read(spark, sf_dir, "orders"), "o_orderdate"), n=30)


@query("""
SELECT o_orderpriority, o_orderstatus, day
FROM order_spine, (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders) AS kinds
EXCEPT SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) FROM orders""")
def missing_days(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    first, last = whole_range(orders, "o_orderdate")
    return calendar.missing_days(orders, "o_orderdate", first, last, by=["o_orderpriority", "o_orderstatus"])


@query("""
SELECT 'S' || s_suppkey AS station, chunk_start, chunk_end FROM supplier, order_chunks
EXCEPT
SELECT 'S' || l_suppkey, chunk_start, chunk_end FROM lineitem JOIN order_chunks
ON CAST(l_shipdate AS DATE) BETWEEN chunk_start AND chunk_end WHERE l_quantity > 48""")
def backfill_manifest(spark, sf_dir):
    first, last = whole_range(read(spark, sf_dir, "orders"), "o_orderdate")
    stations = read(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("station"))
    # What has landed: chunks of a station with a line of more than 48 pieces.
    number = F.floor(F.datediff(F.to_date("l_shipdate"), F.lit(first)) / 31).cast("int")
    landed = (
        read(spark, sf_dir, "lineitem")
        .filter((F.col("l_quantity") > 48) & F.to_date("l_shipdate").between(F.lit(first), F.lit(last)))
        .select(
            F.concat(F.lit("S"), "l_suppkey").alias("station"), F.date_add(F.lit(first), number * 31).alias("chunk_start")
        )
        .distinct()
        .withColumn("chunk_end", F.least(F.date_add("chunk_start", 30), F.lit(last)))
    )
    return calendar.backfill_manifest(stations, landed, first, last, n=30)


#: Lines that a task sorts to meet their orders.
JOINED_ROWS = 1_000_000


@query("""
SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS first_day, CAST(l_shipdate AS DATE) AS last_day,
       CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) <= 31 AS accepted
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def max_span_guard(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("last_day"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("first_day"))
    # Both sides are dealt alike, so the rows that a task sorts for the join are bounded whatever the tables' sizes.
    tasks = tasks_for(lines, JOINED_ROWS)
    lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    spans = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("l_orderkey", "l_linenumber", "first_day", "last_day")
    return calendar.judged_spans(spans, "first_day", "last_day")


# --- data quality -------------------------------------------------------------------------------

_NULLABLE = ["datetime", "temperature", "wind_speed", "gust", "uv_index", "clouds"]


@query(f"""
SELECT "column", CAST(failures AS BIGINT) AS failures
FROM (SELECT {", ".join(f"count(*) - count({name}) AS {name}" for name in _NULLABLE)} FROM stg_weather_rows)
UNPIVOT (failures FOR "column" IN ({", ".join(_NULLABLE)}))""")
def dq_not_null(spark, sf_dir):
    return quality.not_null(built(spark, sf_dir).stg_hourly_weather, _NULLABLE)


@query("SELECT o_custkey, count(*) AS occurrences FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return quality.unique(read(spark, sf_dir, "orders"), "o_custkey")


@query("""
SELECT datetime, weather_station, count(*) AS occurrences FROM stg_weather_rows GROUP BY ALL HAVING count(*) > 1""")
def dq_unique_combo(spark, sf_dir):
    return quality.unique_combination(built(spark, sf_dir).stg_hourly_weather, ["datetime", "weather_station"])


@query("""
SELECT weather_station AS value, count(*) AS rows FROM stg_pws_rows
WHERE weather_station NOT IN (SELECT PWStation FROM locations WHERE PWStation IS NOT NULL) GROUP BY ALL""")
def dq_relationships(spark, sf_dir):
    m = built(spark, sf_dir)
    return quality.relationships(m.stg_hourly_pws_weather, "weather_station", m.full_locations, "PWStation")


@query("""
SELECT pollutant_symbol AS value, count(*) AS rows FROM stg_air_quality_rows
WHERE pollutant_symbol NOT IN ('*', '**', 'b', 'c', 'd', '-') GROUP BY ALL""")
def dq_accepted_values(spark, sf_dir):
    staged = built(spark, sf_dir).stg_hourly_air_quality
    return quality.accepted_values(staged, "pollutant_symbol", ["*", "**", "b", "c", "d", "-"])


@query("""
SELECT 'air_quality' AS "table", 'not_null' AS "check", c AS columns, CAST(f AS BIGINT) AS failures
FROM (SELECT count(*) - count(location) AS location, count(*) - count(city) AS city, count(*) - count(pollutant) AS pollutant,
             count(*) - count(message) AS message FROM air_quality_rows)
UNPIVOT (f FOR c IN (location, city, pollutant, message))
UNION ALL
SELECT 'full_locations', 'unique', 'place', count(*) FROM (SELECT 1 FROM locations GROUP BY place HAVING count(*) > 1)
UNION ALL
SELECT 'air_quality', 'unique_combination', 'location+datetime', count(*)
FROM (SELECT 1 FROM air_quality_rows GROUP BY location, datetime HAVING count(*) > 1)
UNION ALL
SELECT 'stg_hourly_pws_weather', 'relationships', 'weather_station', count(*) FROM stg_pws_rows
WHERE weather_station NOT IN (SELECT PWStation FROM locations WHERE PWStation IS NOT NULL)
UNION ALL
SELECT 'air_quality', 'accepted_values', 'pollutant', count(DISTINCT pollutant) FROM air_quality_rows
WHERE pollutant IN ('Unidentified', 'PM2.5')
UNION ALL
SELECT 'air_quality', 'accepted_values', 'label', count(DISTINCT label) FROM air_quality_rows WHERE label IN ('Unhealthy', 'Good')""")
def dq_report(spark, sf_dir):
    m = built(spark, sf_dir)
    labels = [label for label in ACCEPTED_LABELS if label not in ("Unhealthy", "Good")]
    pollutants = [pollutant for pollutant in ACCEPTED_POLLUTANTS if pollutant not in ("Unidentified", "PM2.5")]
    return quality.dq_report(
        [
            quality.report_not_null("air_quality", m.air_quality, ["location", "city", "pollutant", "message"]),
            quality.report_unique("full_locations", m.full_locations, "place"),
            quality.report_unique_combination("air_quality", m.air_quality, ["location", "datetime"]),
            quality.report_relationships(
                "stg_hourly_pws_weather", m.stg_hourly_pws_weather, "weather_station", m.full_locations, "PWStation"
            ),
            quality.report_accepted_values("air_quality", m.air_quality, "pollutant", pollutants),
            quality.report_accepted_values("air_quality", m.air_quality, "label", labels),
        ]
    )


CTES["placed_customers"] = """
SELECT CASE WHEN c_acctbal < 9990 THEN 'Place ' || c_nationkey END AS place,
       CASE WHEN c_acctbal < -990 THEN NULL WHEN c_acctbal > 9900 AND c_nationkey % 3 = 0 THEN 'elsewhere'
            ELSE 'City ' || c_nationkey END AS city FROM customer"""


@query("""
SELECT place, count(*) AS rows, min(city) AS least_city, max(city) AS greatest_city FROM placed_customers WHERE place IS NOT NULL
GROUP BY place HAVING min(city) <> max(city) OR count(city) NOT IN (0, count(*))""")
def place_determines_city(spark, sf_dir):
    """Customers as places of cities; some places have a customer who names another city, some one who names none."""
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    place = F.when(balance < 9990, F.concat(F.lit("Place "), nation))
    city = F.when(balance < -990, None).when((balance > 9900) & (nation % 3 == 0), "elsewhere").otherwise(F.concat(F.lit("City "), nation))
    customers = read(spark, sf_dir, "customer").select(place.alias("place"), city.alias("city"))
    conflicts = quality.conflicting_dependants(customers, ["place"], ["city"])
    # NULL is the least of all values; the SQL passes it over.
    named = customers.filter("city IS NOT NULL").groupBy("place").agg(F.min("city").alias("least_city"), F.max("city").alias("greatest_city"))
    return conflicts.select("place", "rows").join(named, "place", "left")


# --- the declared checks ------------------------------------------------------------------------

#: The SQL of each table that has declared checks.
_CHECKED = {
    "dev.hourly_air_quality": "hourly_air_quality",
    "dev.hourly_weather": "hourly_weather",
    "dev.hourly_pws_weather": "hourly_pws_weather",
    "prod.hourly_air_quality": "hourly_air_quality",
    "prod.hourly_pws_weather": "hourly_pws_weather",
    "city_states": "city_states",
    "city_places": "city_places",
    "state_locations": "state_locations",
    "air_quality_warning": "warnings",
    "stg_hourly_air_quality": "stg_air_quality_rows",
    "stg_hourly_weather": "stg_weather_rows",
    "stg_hourly_pws_weather": "stg_pws_rows",
    "full_locations": "locations",
    "air_quality": "air_quality_rows",
    "weather": "weather_rows",
    "full_weather_places": "places",
    "uv": "uv_rows",
    "livability_score": "livability_rows",
}


def _check_sql() -> str:
    lines = []

    def line(table: str, kind: str, columns: str, count: str) -> None:
        lines.append(f"SELECT '{table}' AS \"table\", '{kind}' AS \"check\", '{columns}' AS columns, CAST(({count}) AS BIGINT) AS failures")

    for table, declared in DECLARED.items():
        rows = _CHECKED[table]
        for column in declared.not_null:
            line(table, "not_null", column, f"SELECT count(*) FROM {rows} WHERE {column} IS NULL")
        for column, values in declared.accepted.items():
            listed = ", ".join(f"'{value}'" for value in values)
            line(table, "accepted_values", column, f"SELECT count(DISTINCT {column}) FROM {rows} WHERE {column} NOT IN ({listed})")
        for column in declared.unique:
            line(table, "unique", column, f"SELECT count(*) FROM (SELECT 1 FROM {rows} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)")
        for column, (parent, key) in declared.has_parent.items():
            known = f"SELECT {key} FROM {_CHECKED[parent]} WHERE {key} IS NOT NULL"
            line(table, "relationships", column, f"SELECT count(*) FROM {rows} WHERE {column} NOT IN ({known})")
        if declared.unique_together:
            keys = ", ".join(declared.unique_together)
            count = f"SELECT count(*) FROM (SELECT 1 FROM {rows} GROUP BY {keys} HAVING count(*) > 1)"
            line(table, "unique_combination", "+".join(declared.unique_together), count)
    return "\nUNION ALL ".join(lines)


#: The models that are written for the checks, and what models after them read of their columns. The models after the staged
#: weather take its wide rows straight from the bronze readings. Personal weather has no checks and one reader, and of the
#: city days one check reads one column, so both stay plans.
_READ_ON = {
    "full_locations": {"identifying_location", *core.PLACE, "ICAO", "PWStation"},
    "stg_hourly_air_quality": {"datetime", "location", "pollutant_value", "pollutant_symbol"},
    "stg_hourly_weather": set(),
    "stg_hourly_pws_weather": set(),
    "air_quality": {*core.PLACE_HOUR, "pollutant_value"},
    "weather": {*core.PLACE_HOUR, *core.BLENDED.values(), *core.WEATHER_ONLY},
    "full_weather_places": {*core.PLACE_HOUR, "pollutant_value", "temperature", "uv_index"},
    "uv": set(),
}


@query(_check_sql())
def dq_declared(spark, sf_dir):
    """All declared checks of all tables, over models that were written once, in the columns that somebody reads."""
    models, warehouse = built(spark, sf_dir), scratch_path(spark, "checked")
    for name, read_on in _READ_ON.items():  # each model reads those before it from their files
        model = getattr(models, name)
        wanted = [column for column in model.columns if column in read_on | DECLARED[name].columns]
        setattr(models, name, materialize_table(model.select(*wanted), f"{warehouse}/{name}"))
        if name == "full_locations":
            models.weather, models.personal_weather  # planned before the staged readings are written in part
    sources = {f"{env}.{name}": getattr(models.bronze, name) for env in ("dev", "prod") for name in BRONZE_TABLES}
    return checks.report({**sources, **vars(models.seeds), **{name: getattr(models, name) for name in MODEL_NAMES}})
