"""Bronze tables, seeds and documents that Spark derives from the driver's tables.

Every function uses all rows of its tables. Lines of an order stand for station weather, orders
for personal stations and air quality, events for landed documents; suppliers and customers are
the stations, their nation and balance class the place, the nation the city, the region the state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from atmolake.plans.models import Bronze, Seeds
from atmolake.registry.base import CTES, read, spread
from atmolake.schemas import BRONZE_PWS, BRONZE_WEATHER, PWS_OBSERVATION, WEATHER_OBSERVATION

DENIED = ["ISELAN1", "ISELANGO11", "ISELANGO6", "IPETAL1", "IPEKAN1"]
SYMBOLS = ["**", "*", "a", "&", ""]
ZONES = ["low", "mid", "high"]


def text(column: Column) -> Column:
    return column.cast("string")


def whole(column: Column) -> Column:
    return F.floor(column).cast("bigint")


def _bronze(df: DataFrame, columns: list[str], given: dict[str, Column]) -> DataFrame:
    return df.select(*[given.get(name, F.lit(None).cast("string")).alias(name) for name in columns])


# --- station weather from order lines -----------------------------------------------------------


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    n = whole(q)
    line, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    moment = F.col("l_shipdate") + F.make_dt_interval(hours=line)
    given = {
        "datetime": text(F.when((F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08), None).otherwise(moment)),
        "weather_station": F.when(q == 50, "Unidentified").otherwise(F.concat(F.lit("S"), "l_suppkey")),
        "observation_place": F.concat(F.lit("Site "), status),
        "temperature": F.when(F.col("l_tax") >= 0.08, "nan").otherwise(text(q - 2)),
        "min_temperature": text(q - 5),
        "max_temperature": text(q + 1),
        "feels_like_temperature": text(q - 3),
        "pressure": text(whole(F.col("l_extendedprice") / 300) + 780),
        "pressure_tend": text(line - 2),
        "pressure_desc": F.when(flag == "N", "None").when(flag == "A", "Steady").otherwise("Rising"),
        "wind_speed": F.when(line == 7, text(q)).otherwise(text(n - 3)),
        "gust": F.when(status == "O", "None").otherwise(text(n - 5)),
        "dew_point": text(q - 1),
        "relative_humidity": text(n * 3 - 10),
        "heat_index": text(n - 4),
        "wind_direction_dir": F.when(flag == "R", "NONE").when(flag == "A", "NNE").otherwise("SW"),
        "wind_direction_deg": text(n * 8 - 8),
        "wind_chill": text(q - 6),
        "clouds": F.when((status == "F") & (flag == "N"), "none").otherwise("SCT"),
        "weather_phrase": F.when(flag == "A", "None").otherwise(F.concat(F.lit("Fair / "), status)),
        "uv_description": F.when(line > 5, "none").otherwise("Low"),
        "uv_index": F.when(line == 6, "nan").otherwise(text(line * 3 - 5)),
        "visibility": text(n),
        "day_indicator": F.when(line < 4, "D").otherwise("N"),
    }
    return _bronze(read(spark, sf_dir, "lineitem"), list(BRONZE_WEATHER), given)


CTES["hourly_weather"] = """
SELECT CASE WHEN l_discount >= 0.1 AND l_tax >= 0.08 THEN NULL
            ELSE CAST(l_shipdate + to_hours(l_linenumber) AS VARCHAR) END AS datetime,
       CASE WHEN l_quantity = 50 THEN 'Unidentified' ELSE 'S' || l_suppkey END AS weather_station,
       'Site ' || l_linestatus AS observation_place,
       CASE WHEN l_tax >= 0.08 THEN 'nan' ELSE CAST(l_quantity - 2 AS VARCHAR) END AS temperature,
       CAST(l_quantity - 5 AS VARCHAR) AS min_temperature,
       CAST(l_quantity + 1 AS VARCHAR) AS max_temperature,
       CAST(l_quantity - 3 AS VARCHAR) AS feels_like_temperature,
       CAST(CAST(floor(l_extendedprice / 300) AS BIGINT) + 780 AS VARCHAR) AS pressure,
       CAST(l_linenumber - 2 AS VARCHAR) AS pressure_tend,
       CASE l_returnflag WHEN 'N' THEN 'None' WHEN 'A' THEN 'Steady' ELSE 'Rising' END AS pressure_desc,
       CASE WHEN l_linenumber = 7 THEN CAST(l_quantity AS VARCHAR)
            ELSE CAST(CAST(l_quantity AS BIGINT) - 3 AS VARCHAR) END AS wind_speed,
       CASE WHEN l_linestatus = 'O' THEN 'None' ELSE CAST(CAST(l_quantity AS BIGINT) - 5 AS VARCHAR) END AS gust,
       CAST(l_quantity - 1 AS VARCHAR) AS dew_point,
       CAST(CAST(l_quantity AS BIGINT) * 3 - 10 AS VARCHAR) AS relative_humidity,
       CAST(CAST(l_quantity AS BIGINT) - 4 AS VARCHAR) AS heat_index,
       CASE l_returnflag WHEN 'R' THEN 'NONE' WHEN 'A' THEN 'NNE' ELSE 'SW' END AS wind_direction_dir,
       CAST(CAST(l_quantity AS BIGINT) * 8 - 8 AS VARCHAR) AS wind_direction_deg,
       CAST(l_quantity - 6 AS VARCHAR) AS wind_chill,
       CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'none' ELSE 'SCT' END AS clouds,
       CASE WHEN l_returnflag = 'A' THEN 'None' ELSE 'Fair / ' || l_linestatus END AS weather_phrase,
       CASE WHEN l_linenumber > 5 THEN 'none' ELSE 'Low' END AS uv_description,
       CASE WHEN l_linenumber = 6 THEN 'nan' ELSE CAST(l_linenumber * 3 - 5 AS VARCHAR) END AS uv_index,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS visibility,
       CASE WHEN l_linenumber < 4 THEN 'D' ELSE 'N' END AS day_indicator
FROM lineitem"""


# --- personal stations and air quality from orders ----------------------------------------------


def _priority() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def hourly_pws_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    hours = _priority() + F.when(status == "O", 12).otherwise(0)
    half = whole(price / 5000) / 2
    given = {
        "datetime": text(
            F.when(price < 3000, None).otherwise(F.col("o_orderdate") + F.make_dt_interval(hours=hours))
        ),
        "weather_station": F.when(price > 495000, "Unidentified")
        .when(status == "P", F.element_at(F.array(*[F.lit(name) for name in DENIED]), _priority()))
        .otherwise(F.concat(F.lit("P"), "o_custkey")),
        "solar_radiation_high": text(whole(price / 500) - 10),
        "humidity": text(half * 2 + 10),
        "temperature": text(half),
        "precipitation_rate": text(half - 1),
        "precipitation_total": F.when(status == "F", "None").otherwise(text(half - 2)),
        "pressure_trend": text(_priority() - 3),
        "pressure": text(whole(price / 1500) + 800),
        "wind_speed": text(half - 3),
        "gust": text(half - 4),
        "dew_point": text(half - 1),
        "heat_index": text(half + 1),
        "wind_direction": text(whole(price / 1000) - 50),
        "wind_chill": text(half - 6),
        "uv": F.when(_priority() == 5, "nan").otherwise(text(whole(price / 20000) / 2 - 1)),
    }
    return _bronze(read(spark, sf_dir, "orders"), list(BRONZE_PWS), given)


CTES["hourly_pws_weather"] = """
SELECT CASE WHEN o_totalprice < 3000 THEN NULL
            ELSE CAST(o_orderdate + to_hours(p + CASE WHEN o_orderstatus = 'O' THEN 12 ELSE 0 END) AS VARCHAR)
       END AS datetime,
       CASE WHEN o_totalprice > 495000 THEN 'Unidentified'
            WHEN o_orderstatus = 'P' THEN ['ISELAN1', 'ISELANGO11', 'ISELANGO6', 'IPETAL1', 'IPEKAN1'][p]
            ELSE 'P' || o_custkey END AS weather_station,
       CAST(CAST(floor(o_totalprice / 500) AS BIGINT) - 10 AS VARCHAR) AS solar_radiation_high,
       CAST(half * 2 + 10 AS VARCHAR) AS humidity,
       CAST(half AS VARCHAR) AS temperature,
       CAST(half - 1 AS VARCHAR) AS precipitation_rate,
       CASE WHEN o_orderstatus = 'F' THEN 'None' ELSE CAST(half - 2 AS VARCHAR) END AS precipitation_total,
       CAST(p - 3 AS VARCHAR) AS pressure_trend,
       CAST(CAST(floor(o_totalprice / 1500) AS BIGINT) + 800 AS VARCHAR) AS pressure,
       CAST(half - 3 AS VARCHAR) AS wind_speed,
       CAST(half - 4 AS VARCHAR) AS gust,
       CAST(half - 1 AS VARCHAR) AS dew_point,
       CAST(half + 1 AS VARCHAR) AS heat_index,
       CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) - 50 AS VARCHAR) AS wind_direction,
       CAST(half - 6 AS VARCHAR) AS wind_chill,
       CASE WHEN p = 5 THEN 'nan' ELSE CAST(floor(o_totalprice / 20000) / 2 - 1 AS VARCHAR) END AS uv
FROM (SELECT *, CAST(left(o_orderpriority, 1) AS INTEGER) AS p, floor(o_totalprice / 5000) / 2 AS half FROM orders)"""


def hourly_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    symbol = F.element_at(F.array(*[F.lit(name) for name in SYMBOLS]), _priority())
    given = {
        "location": F.concat(F.lit("L"), "o_custkey"),
        "datetime": text(F.col("o_orderdate") + F.make_dt_interval(hours=_priority())),
        "value": F.when(price < 20000, "N/A").otherwise(F.concat(text(whole(price / 1500)), symbol)),
    }
    return _bronze(read(spark, sf_dir, "orders"), ["location", "datetime", "value"], given)


CTES["hourly_air_quality"] = """
SELECT 'L' || o_custkey AS location,
       CAST(o_orderdate + to_hours(p) AS VARCHAR) AS datetime,
       CASE WHEN o_totalprice < 20000 THEN 'N/A'
            ELSE CAST(CAST(floor(o_totalprice / 1500) AS BIGINT) AS VARCHAR) || ['**', '*', 'a', '&', ''][p]
       END AS value
FROM (SELECT *, CAST(left(o_orderpriority, 1) AS INTEGER) AS p FROM orders)"""


# --- seeds --------------------------------------------------------------------------------------


def _zone(balance: str) -> Column:
    return F.when(F.col(balance) < -500, "new").when(F.col(balance) < 3000, "low").when(
        F.col(balance) < 6000, "mid"
    ).otherwise("high")


def state_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are locations, some with a personal station; suppliers are airports, most with a code."""
    home = ["BUILDING", "AUTOMOBILE", "HOUSEHOLD"]
    customers = read(spark, sf_dir, "customer").select(
        F.concat(F.lit("L"), "c_custkey").alias("Identifying_Location"),
        F.concat(F.lit("Place "), "c_nationkey", F.lit(" "), _zone("c_acctbal")).alias("Place"),
        (F.col("c_acctbal") / 100).alias("Latitude"),
        (F.col("c_nationkey") + 100).cast("double").alias("Longitude"),
        F.lit(None).cast("string").alias("ICAO"),
        F.when(F.col("c_mktsegment").isin(home), F.concat(F.lit("P"), "c_custkey")).alias("PWStation"),
    )
    suppliers = read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("A"), "s_suppkey").alias("Identifying_Location"),
        F.concat(F.lit("Place "), "s_nationkey", F.lit(" "), _zone("s_acctbal")).alias("Place"),
        (F.col("s_acctbal") / 100).alias("Latitude"),
        (F.col("s_nationkey") + 100).cast("double").alias("Longitude"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("S"), "s_suppkey")).alias("ICAO"),
        F.lit(None).cast("string").alias("PWStation"),
    )
    return customers.unionByName(suppliers)


_ZONE_SQL = (
    "CASE WHEN {0} < -500 THEN 'new' WHEN {0} < 3000 THEN 'low' WHEN {0} < 6000 THEN 'mid' ELSE 'high' END"
)
CTES["state_locations"] = f"""
SELECT 'L' || c_custkey AS Identifying_Location,
       'Place ' || c_nationkey || ' ' || {_ZONE_SQL.format("c_acctbal")} AS Place,
       c_acctbal / 100 AS Latitude, CAST(c_nationkey + 100 AS DOUBLE) AS Longitude,
       CAST(NULL AS VARCHAR) AS ICAO,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'HOUSEHOLD') THEN 'P' || c_custkey END AS PWStation
FROM customer
UNION ALL
SELECT 'A' || s_suppkey, 'Place ' || s_nationkey || ' ' || {_ZONE_SQL.format("s_acctbal")},
       s_acctbal / 100, CAST(s_nationkey + 100 AS DOUBLE),
       CASE WHEN s_acctbal > 0 THEN 'S' || s_suppkey END, CAST(NULL AS VARCHAR)
FROM supplier"""


def city_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three places per nation; places of the zone `new` belong to no city yet."""
    zones = F.explode(F.array(*[F.lit(zone) for zone in ZONES])).alias("zone")
    return (
        read(spark, sf_dir, "nation")
        .select("n_nationkey", "n_name", zones)
        .select(F.concat(F.lit("Place "), "n_nationkey", F.lit(" "), "zone").alias("Place"), F.col("n_name").alias("City"))
    )


CTES["city_places"] = """
SELECT 'Place ' || n_nationkey || ' ' || zone AS Place, n_name AS City
FROM (SELECT n_nationkey, n_name, unnest(['low', 'mid', 'high']) AS zone FROM nation)"""


def city_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("City"), F.col("r_name").alias("State")
    )


CTES["city_states"] = """
SELECT n_name AS City, r_name AS State FROM nation JOIN region ON n_regionkey = r_regionkey"""


def local_rows(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A table of literals. Unlike rows sent from Python it has a known size, so joins can broadcast it."""
    values = ", ".join("(" + ", ".join(repr(value) for value in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def indicators(spark: SparkSession) -> DataFrame:
    rows = [("PM2.5", "**"), ("PM10", "*"), ("SO2", "a"), ("Unidentified", "-")]
    return local_rows(spark, "pollutant, symbol", rows)


CTES["indicators"] = """
SELECT * FROM (VALUES ('PM2.5', '**'), ('PM10', '*'), ('SO2', 'a'), ('Unidentified', '-')) AS t(pollutant, symbol)"""


def warnings(spark: SparkSession) -> DataFrame:
    rows = [
        (label, pollutant, f"{pollutant}: {advice}")
        for label, advice in [("Good", "go out"), ("Moderate", "go slow"), ("Unhealthy", "stay in"), ("Hazardous", "hide")]
        for pollutant in ["PM2.5", "PM10", "SO2", "Unidentified"]
    ]
    return local_rows(spark, "label, pollutant, warning_message", rows)


CTES["warnings"] = """
SELECT label, pollutant, pollutant || ': ' || advice AS warning_message
FROM (VALUES ('Good', 'go out'), ('Moderate', 'go slow'), ('Unhealthy', 'stay in'), ('Hazardous', 'hide')) AS l(label, advice),
     (VALUES ('PM2.5'), ('PM10'), ('SO2'), ('Unidentified')) AS p(pollutant)"""


def uv_info(spark: SparkSession) -> DataFrame:
    rows = [
        (2, "low", "none", "nothing to do"),
        (5, "moderate", "some", "hat, shade"),
        (7, "high", "some", "hat, shade, cream"),
        (10, "very high", "extra", "avoid noon"),
    ]
    return local_rows(spark, "uv_level, exposure_category, short_description, long_description", rows)


CTES["uv_info"] = """
SELECT * FROM (VALUES (2, 'low', 'none', 'nothing to do'), (5, 'moderate', 'some', 'hat, shade'),
  (7, 'high', 'some', 'hat, shade, cream'), (10, 'very high', 'extra', 'avoid noon'))
  AS t(uv_level, exposure_category, short_description, long_description)"""


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(
        hourly_weather(spark, sf_dir), hourly_pws_weather(spark, sf_dir), hourly_air_quality(spark, sf_dir)
    )


def seeds(spark: SparkSession, sf_dir: str) -> Seeds:
    return Seeds(
        state_locations(spark, sf_dir),
        city_places(spark, sf_dir),
        city_states(spark, sf_dir),
        indicators(spark),
        warnings(spark),
        uv_info(spark),
    )


# --- landed documents from events ---------------------------------------------------------------


def _event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dealt to tasks of a bounded size, as each becomes a document."""
    hour = F.date_trunc("hour", "ts")
    return spread(read(spark, sf_dir, "events")).withColumns(
        {"epoch": F.unix_seconds(hour.cast("timestamp")), "kind": F.col("event_type"), "station": F.concat(F.lit("U"), "user_id")}
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response document per event: two observations, or none."""
    kind, value, station = F.col("kind"), F.col("value"), F.col("station")

    def observation(shift: int, temperature: Column) -> Column:
        return F.struct(
            F.when(kind == "signup", None)
            .when((kind == "click") & (value > 100), F.concat(F.lit("X"), "user_id"))
            .otherwise(station)
            .alias("obs_id"),
            F.when((kind == "signup") & (value < 10), "96535")
            .when((kind == "signup") & (value > 60), None)
            .otherwise(station)
            .alias("key"),
            (F.col("epoch") + shift).alias("valid_time_gmt"),
            (F.col("epoch") + shift + 7200).alias("expire_time_gmt"),
            F.lit("observation").alias("class"),
            F.concat(F.lit("Site "), "user_id").alias("obs_name"),
            temperature.alias("temp"),
            (whole(value / 10) + 990).alias("pressure"),
            whole(value / 20).alias("wspd"),
            value.alias("dewPt"),
            F.when(kind == "error", "NNE").alias("wdir_cardinal"),
            kind.alias("wx_phrase"),
        )

    observations = F.slice(
        F.array(observation(0, whole(value / 8)), observation(1800, F.lit(None).cast("bigint"))),
        1,
        F.when((kind == "view") & (value > 100), 0).otherwise(2),
    )
    metadata = F.struct(
        F.when((kind == "error") & (value > 60), 500).otherwise(200).alias("status_code"),
        F.when((kind == "purchase") & (value > 80), "ms-MY").otherwise("en-US").alias("language"),
        F.when((kind == "purchase") & (value < 5), "e").otherwise("m").alias("units"),
    )
    response = F.struct(metadata.alias("metadata"), observations.alias("observations"))
    document = F.to_json(F.create_map(F.concat(station, F.lit(":9:MY")), response))
    return _event(spark, sf_dir).select("event_id", document.alias("value"))


CTES["weather_responses"] = """
SELECT event_id, user_id, event_type AS kind, value, 'U' || user_id || ':9:MY' AS station,
       CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS epoch, date_trunc('hour', ts) AS utc,
       CASE WHEN event_type = 'error' AND value > 60 THEN 500 ELSE 200 END AS status_code,
       CASE WHEN event_type = 'purchase' AND value > 80 THEN 'ms-MY' ELSE 'en-US' END AS language,
       CASE WHEN event_type = 'purchase' AND value < 5 THEN 'e' ELSE 'm' END AS units,
       CASE WHEN event_type = 'view' AND value > 100 THEN 0 ELSE 2 END AS n_observations,
       CASE WHEN event_type = 'signup' THEN
                 CASE WHEN value < 10 THEN 'Unidentified' WHEN value > 60 THEN 'Unidentified' ELSE 'U' || user_id END
            WHEN event_type = 'click' AND value > 100 THEN 'X' || user_id
            ELSE 'U' || user_id END AS observed
FROM events"""
CTES["accepted_observations"] = """
SELECT *, utc + INTERVAL 8 HOUR + CASE n WHEN 0 THEN INTERVAL 0 MINUTE ELSE INTERVAL 30 MINUTE END AS local_time
FROM (SELECT *, unnest([0, 1]) AS n FROM weather_responses
      WHERE n_observations > 0 AND status_code = 200 AND language = 'en-US' AND units = 'm')"""


def pws_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response document per event with one or two observations; some epochs in milliseconds."""
    kind, value, station = F.col("kind"), F.col("value"), F.col("station")

    def observation(shift: int) -> Column:
        epoch = F.col("epoch") + shift
        metric = F.struct(
            whole(value / 8).alias("tempAvg"),
            whole(value / 20).alias("windspeedAvg"),
            F.when(kind == "error", 0).when(kind == "signup", None).otherwise(whole(value) + 901).alias("pressureMax"),
            F.when(kind == "purchase", None).when(kind == "signup", None).otherwise(whole(value) + 900).alias("pressureMin"),
            value.alias("precipRate"),
        )
        return F.struct(
            F.when(kind == "signup", None)
            .when((kind == "click") & (value > 100), F.concat(F.lit("X"), "user_id"))
            .otherwise(station)
            .alias("stationID"),
            F.when(kind == "view", epoch * 1000).otherwise(epoch).alias("epoch"),
            F.lit(3.5).alias("lat"),
            whole(value / 30).alias("uvHigh"),
            F.lit(1).alias("qcStatus"),
            metric.alias("metric"),
        )

    observations = F.slice(F.array(observation(0), observation(1800)), 1, F.when(value > 50, 1).otherwise(2))
    document = F.to_json(F.create_map(station, F.struct(observations.alias("observations"))))
    return _event(spark, sf_dir).select("event_id", document.alias("value"))


CTES["pws_observations"] = """
SELECT event_id, user_id, kind, value, station, observed, high, low,
       utc + INTERVAL 8 HOUR + CASE n WHEN 0 THEN INTERVAL 0 MINUTE ELSE INTERVAL 30 MINUTE END AS local_time
FROM (SELECT event_id, user_id, event_type AS kind, value, 'U' || user_id AS station, date_trunc('hour', ts) AS utc,
             CASE WHEN event_type = 'signup' THEN 'Unidentified'
                  WHEN event_type = 'click' AND value > 100 THEN 'X' || user_id ELSE 'U' || user_id END AS observed,
             CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE floor(value) + 901 END AS high,
             CASE WHEN event_type IN ('purchase', 'signup') THEN NULL ELSE floor(value) + 900 END AS low,
             unnest(CASE WHEN value > 50 THEN [0] ELSE [0, 1] END) AS n
      FROM events)"""


def aq_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event: a reading and a copy an hour later; signups above 60 have no table."""
    kind, value = F.col("kind"), F.col("value")

    def reading(shift: str) -> Column:
        moment = F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.expr(f"interval {shift}")
        return F.struct(
            F.concat(F.lit("ST"), "user_id").alias("STATION_ID"),
            F.length("kind").alias("STATE_ID"),
            F.concat(F.lit("Station "), "user_id").alias("STATION_NAME"),
            F.when(kind == "error", F.col("station"))
            .otherwise(F.concat("station", F.lit(", "), "kind"))
            .alias("STATION_LOCATION"),
            F.when(value > 90, None).otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")).alias("DATETIME"),
            F.when(value < 2, None).otherwise(whole(value)).alias("API"),
        )

    table = F.struct(F.array(reading("0 hours"), reading("1 hours")).alias("api_table_hourly"))
    document = F.when((kind == "signup") & (value > 60), '{"message": "none"}').otherwise(F.to_json(table))
    return _event(spark, sf_dir).select("event_id", document.alias("value"))


CTES["aq_readings"] = """
SELECT event_id, user_id, 'ST' || user_id AS station_id, CAST(length(event_type) AS INTEGER) AS state_id,
       'Station ' || user_id AS station_name,
       CASE WHEN event_type = 'error' THEN 'U' || user_id ELSE 'U' || user_id || ', ' || event_type END AS station_location,
       CASE WHEN value > 90 THEN NULL ELSE date_trunc('hour', ts) + to_hours(n) END AS datetime,
       CASE WHEN value < 2 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS api
FROM (SELECT *, unnest([0, 1]) AS n FROM events)
WHERE NOT (event_type = 'signup' AND value > 60)"""


def matrix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer the 24-hour matrix of one location, landed for one time of a day."""
    from atmolake.fixed_values import MATRIX_HEADER

    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    header = F.array(*[F.lit(label) for label in MATRIX_HEADER])
    cells = [
        F.when(balance < 0, "N/A").otherwise(F.concat(text(whole(balance / 100) + hour), F.lit("**"))) for hour in range(24)
    ]
    row = F.array(F.concat(F.lit("State "), "c_nationkey"), F.concat(F.lit("L"), "c_custkey"), *cells)
    # Documents of one segment have their header in the wrong order.
    header = F.when(segment == "MACHINERY", F.reverse(header)).otherwise(header)
    key = F.when(segment == "BUILDING", "24hour_api_apims").when(segment == "FURNITURE", "renamed_api").otherwise("24hour_api")
    landed = F.when(segment == "AUTOMOBILE", "0100").when(segment == "HOUSEHOLD", "2300").otherwise("1200")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return spread(customers, "c_custkey").select(
        "c_custkey",
        F.date_add(F.lit("2021-05-02").cast("date"), F.col("c_nationkey")).alias("request_date"),
        F.concat(F.lit("zone "), F.col("c_nationkey")).alias("zone"),
        landed.alias("landed_time"),
        F.to_json(F.create_map(key, F.array(header, row))).alias("value"),
    )


CTES["matrix_cells"] = """
SELECT c_custkey, DATE '2021-05-02' + c_nationkey AS request_date, c_mktsegment, 'State ' || c_nationkey AS state,
       'L' || c_custkey AS location, hour,
       CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE CAST(CAST(floor(c_acctbal / 100) AS BIGINT) + hour AS VARCHAR) || '**'
       END AS value
FROM (SELECT *, unnest(range(24)) AS hour FROM customer)"""


def tile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order a tile with one feature, so stations of busy customers are seen many times."""
    priority = _priority()
    properties = F.struct(
        F.when(priority == 1, None).when(priority == 2, "SG").otherwise("MY").alias("country"),
        F.concat(F.lit("area "), F.col("o_orderstatus")).alias("neighborhood"),
        F.when(priority == 3, "METAR").otherwise("PWS").alias("type"),
        F.when(priority == 1, "airport").alias("station_name"),
    )
    feature = F.struct(
        F.concat(F.lit("PW"), "o_custkey").alias("id"),
        F.struct(F.lit("Point").alias("type"), F.array(whole(F.col("o_totalprice")), F.lit(3)).alias("coordinates")).alias(
            "geometry"
        ),
        properties.alias("properties"),
    )
    tile = F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.create_map(F.lit("tile"), tile)).alias("value"))


# --- documents in which every declared field is filled -------------------------------------------


def _filled(field: str, kind: str, given: dict[str, Column]) -> Column:
    """A value of its own for a declared field: the given one, or its name and the number of the event."""
    if field in given:
        return given[field].alias(field)
    number = F.col("event_id") % 1000
    if kind == "string":
        return F.concat(F.lit(f"{field} "), number).alias(field)
    return (number + len(field)).cast("double" if kind == "double" else kind).alias(field)


def _fields(struct: str) -> dict[str, str]:
    """Fields of a declared struct and their types, as text."""
    return {field.name: field.dataType.simpleString() for field in StructType.fromDDL(struct.removeprefix("struct<").removesuffix(">"))}


def full_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event whose observation has all fields of the declared schema."""
    given = {"obs_id": F.col("station"), "key": F.lit("other"), "valid_time_gmt": F.col("epoch"), "expire_time_gmt": F.col("epoch") + 3600}
    observation = F.struct(*[_filled(field, kind, given) for field, kind in _fields(WEATHER_OBSERVATION).items()])
    metadata = F.struct(F.lit(200).alias("status_code"), F.lit("en-US").alias("language"), F.lit("m").alias("units"))
    response = F.struct(metadata.alias("metadata"), F.array(observation).alias("observations"))
    document = F.to_json(F.create_map(F.concat("station", F.lit(":9:MY")), response))
    return _event(spark, sf_dir).select("event_id", document.alias("value"))


def full_pws_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event whose observation of a personal station has all declared fields."""
    fields = _fields(PWS_OBSERVATION)
    pressures = {"pressureMax": F.col("event_id") % 50 + 1001, "pressureMin": F.col("event_id") % 50 + 1000}
    metric = F.struct(*[_filled(field, kind, pressures) for field, kind in _fields(fields["metric"]).items()])
    given = {"stationID": F.col("station"), "epoch": F.col("epoch"), "metric": metric}
    observation = F.struct(*[_filled(field, kind, given) for field, kind in fields.items()])
    document = F.to_json(F.create_map("station", F.struct(F.array(observation).alias("observations"))))
    return _event(spark, sf_dir).select("event_id", document.alias("value"))


def landed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer up to five landed files of the same day, of which some have their header in the wrong order."""
    from atmolake.fixed_values import MATRIX_HEADER

    header = F.array(*[F.lit(label) for label in MATRIX_HEADER])
    landed = F.explode(F.array(*[F.lit(time) for time in LANDED_TIMES])).alias("landed_time")
    files = spread(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", landed)
    place = F.array_position(F.array(*[F.lit(time) for time in LANDED_TIMES]), F.col("landed_time")).cast("int")
    # Bit i of the customer's number tells whether its i-th file is there, bit i + 5 whether its header is right.
    files = files.withColumn("place", place).filter(F.expr("(c_custkey >> (place - 1)) & 1 = 1"))
    right = F.expr("(c_custkey >> (place + 4)) & 1 = 0")
    row = F.array(F.lit("State"), F.concat(F.lit("L"), "c_custkey"), *[F.col("landed_time")] * 24)
    matrix = F.array(F.when(right, header).otherwise(F.reverse(header)), row)
    return files.select("c_custkey", "landed_time", F.to_json(F.create_map(F.lit("24hour_api"), matrix)).alias("value"))


#: Landing times of matrix files; the one at noon is what is asked for.
LANDED_TIMES = ["0100", "1200", "0700", "0000", "2300"]
