"""Queries of the JSON sources, the flattens and the reshapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from atmolake.functions.times import epoch_to_local
from atmolake.operators import accounting, flatten, reshape
from atmolake.registry import inputs
from atmolake.registry.base import CTES, query, read
from atmolake.session import scratch_path
from atmolake.sources import landing
from atmolake.streaming import backfill, ingest


def landed(documents, spark, label: str) -> str:
    """Write documents to a new landing folder, one per line, and give its path."""
    path = scratch_path(spark, label)
    documents.select("value").write.text(path)
    return path


# --- sources ------------------------------------------------------------------------------------


@query("""
SELECT station, status_code, language, units, CAST(n_observations AS INTEGER) AS n_observations FROM weather_responses""")
def scan_weather_json(spark, sf_dir):
    path = landed(inputs.weather_documents(spark, sf_dir), spark, "weather")
    return landing.scan_weather_json(spark, path).select(
        "station", "metadata.status_code", "metadata.language", "metadata.units", F.size("observations").alias("n_observations")
    )


@query("""
SELECT station, CAST(count(*) AS INTEGER) AS n_observations, min(local_time) AS first_time
FROM pws_observations GROUP BY event_id, station""")
def scan_pws_json(spark, sf_dir):
    path = landed(inputs.pws_documents(spark, sf_dir), spark, "pws")
    return landing.scan_pws_json(spark, path).select(
        "station",
        F.size("observations").alias("n_observations"),
        epoch_to_local(F.get("observations", F.lit(0))["epoch"]).alias("first_time"),
    )


@query("""
SELECT station_id, state_id, station_name, station_location, strftime(datetime, '%Y-%m-%dT%H:%M:%S') AS datetime,
       CAST(api AS VARCHAR) AS api FROM aq_readings""")
def scan_aq_json(spark, sf_dir):
    path = landed(inputs.aq_documents(spark, sf_dir), spark, "aq")
    columns = ["STATION_ID", "STATE_ID", "STATION_NAME", "STATION_LOCATION", "DATETIME", "API"]
    return landing.scan_aq_json(spark, path).select(*[F.col(name).alias(name.lower()) for name in columns])


@query("""
SELECT location, state, CASE WHEN c_mktsegment = 'MACHINERY' THEN '12:00AM' ELSE 'State' END AS first_header,
       list(value ORDER BY hour)[1] AS first_value, list(value ORDER BY hour)[24] AS last_value
FROM matrix_cells GROUP BY ALL""")
def scan_aq_matrix(spark, sf_dir):
    path = landed(inputs.matrix_documents(spark, sf_dir), spark, "matrix")
    rows = landing.scan_aq_matrix(spark, path).select("header", F.explode("rows").alias("row"))
    return rows.select(
        F.get("row", F.lit(1)).alias("location"),
        F.get("row", F.lit(0)).alias("state"),
        F.get("header", F.lit(0)).alias("first_header"),
        F.get("row", F.lit(2)).alias("first_value"),
        F.get("row", F.lit(25)).alias("last_value"),
    )


@query("""
SELECT 'PW' || o_custkey AS station_id, CAST(3 AS DOUBLE) AS latitude, CAST(floor(o_totalprice) AS DOUBLE) AS longitude,
       'area ' || o_orderstatus AS neighbourhood, left(o_orderpriority, 1) <> '3' AS is_expected_type
FROM orders WHERE left(o_orderpriority, 1) NOT IN ('1', '2')
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def scan_geojson_stations(spark, sf_dir):
    return landing.parse_geojson_stations(inputs.tile_documents(spark, sf_dir), "o_orderkey")


@query("""
SELECT local_time AS datetime, CASE WHEN observed = 'Unidentified' THEN NULL ELSE observed END AS weather_station,
       CASE WHEN kind = 'purchase' THEN high WHEN kind = 'error' THEN low WHEN kind = 'signup' THEN NULL
            ELSE round((high + low) / 2, 3) END AS pressure
FROM pws_observations""")
def scan_glob_pws_pressure(spark, sf_dir):
    path = landed(inputs.pws_documents(spark, sf_dir), spark, "pws-glob")
    return landing.scan_pws_pressure(spark, f"{path}/part-*")


@query("""
SELECT local_time AS datetime, CASE WHEN observed = 'Unidentified' THEN NULL ELSE observed END AS weather_station,
       CASE WHEN kind = 'purchase' THEN high WHEN kind = 'error' THEN low WHEN kind = 'signup' THEN NULL
            ELSE round((high + low) / 2, 3) END AS pressure
FROM pws_observations""")
def load_pws_pressure(spark, sf_dir):
    """The glob grows between loads; a third load finds nothing new."""
    path, table = scratch_path(spark, "pws-files"), scratch_path(spark, "hourly-pws-pressure")
    documents = inputs.pws_documents(spark, sf_dir)
    for remainder in (0, 1, None):
        if remainder is not None:
            documents.filter(F.col("event_id") % 2 == remainder).select("value").write.mode("append").text(path)
        backfill.load_pws_pressure(spark, f"{path}/part-*", table)
    return backfill.read_loaded(spark, table)


# --- response guards ----------------------------------------------------------------------------


@query("""
SELECT event_id, station, status_code = 200 AND language = 'en-US' AND units = 'm' AS accepted
FROM weather_responses WHERE n_observations > 0""")
def api_response_guard(spark, sf_dir):
    responses = landing.parse_weather(inputs.weather_documents(spark, sf_dir), "event_id")
    accepted, rejected = flatten.split_responses(responses)
    return accepted.select("event_id", "station", F.lit(True).alias("accepted")).unionByName(
        rejected.select("event_id", "station", F.lit(False).alias("accepted"))
    )


@query("""
SELECT DISTINCT event_id, 'broken' AS reason, CAST(NULL AS VARCHAR) AS station FROM weather_responses WHERE event_id % 11 = 0
UNION ALL
SELECT event_id, 'refused', station FROM weather_responses
WHERE event_id % 11 <> 0 AND n_observations > 0 AND NOT (status_code = 200 AND language = 'en-US' AND units = 'm')""")
def quarantined_documents(spark, sf_dir):
    """Every eleventh document is cut off in the middle."""
    half = F.expr("substr(value, 1, length(value) div 2)")
    documents = inputs.weather_documents(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 11 == 0, half).otherwise(F.col("value")))
    aside = ingest.quarantined_weather(documents, "event_id").filter(F.col("reason").isin("broken", "refused"))
    return aside.select("event_id", "reason", "station")


def oddly_landed(documents, kind: str):
    """Documents of which some have another shape than declared, by the id of their event, and the `file` of each."""
    id_, value = F.col("event_id"), F.col("value")
    half = F.expr("substr(value, 1, length(value) div 2)")
    inner = F.expr("substr(value, 2, length(value) - 2)")  # an object without its brackets
    if kind == "aq":
        elements = F.regexp_replace(value, r"\}\]\}$", '},7,null]}')
        other = {0: half, 1: F.lit("[1,2]"), 2: F.lit("{}"), 3: F.lit('{"api_table_hourly":3}'), 4: F.lit('{"api_table_hourly":[]}'),
                 5: elements, 6: F.concat(value, F.lit(" {}")), 7: F.regexp_replace(value, r'"DATETIME":"\d+-\d+', '"DATETIME":"2024-99')}
    else:
        elements = F.regexp_replace(value, r"\}\]\}\}$", '},5,"none"]}}')
        other = {0: half, 1: F.lit("[1,2]"), 2: F.lit("{}"), 3: F.lit('{"S2":5}'), 4: F.lit('{"S2":{"observations":"none"}}'),
                 5: F.concat(F.lit('{"S2":null,'), inner, F.lit("}")), 6: elements, 7: F.concat(value, value)}
    odd = value
    for remainder, text in other.items():
        odd = F.when(id_ % 11 == remainder, text).otherwise(odd)
    return documents.select(odd.alias("value"), F.concat(F.lit("file "), id_ % 3).alias("file"))


_LEVELS = """
SELECT source, file, level, outcome, count(*) AS parts FROM (
  SELECT 'weather' AS source, file, 'document' AS level,
         CASE WHEN odd IN (0, 7) THEN 'broken' WHEN odd = 1 THEN 'shape' WHEN odd = 2 THEN 'empty' ELSE 'opened' END AS outcome
  FROM (SELECT *, 'file ' || event_id % 3 AS file, event_id % 11 AS odd FROM weather_responses)
  UNION ALL SELECT 'weather', file, 'response', 'shape' FROM weather_odd WHERE odd IN (3, 4, 5)
  UNION ALL SELECT 'weather', file, 'response', outcome FROM weather_odd WHERE odd IN (5, 6, 8, 9, 10)
  UNION ALL SELECT 'weather', file, 'reading', CASE WHEN left(observed, 1) = 'X' THEN 'mismatch' ELSE 'taken' END
            FROM (SELECT *, unnest([0, 1]) FROM weather_odd WHERE odd IN (5, 6, 8, 9, 10) AND outcome = 'opened')
  UNION ALL SELECT 'weather', file, 'reading', 'shape' FROM (SELECT *, unnest([0, 1]) FROM weather_odd WHERE odd = 6 AND outcome = 'opened')
  UNION ALL SELECT 'pws', file, 'document',
         CASE WHEN odd IN (0, 7) THEN 'broken' WHEN odd = 1 THEN 'shape' WHEN odd = 2 THEN 'empty' ELSE 'opened' END FROM pws_odd
  UNION ALL SELECT 'pws', file, 'response', 'shape' FROM pws_odd WHERE odd IN (3, 4, 5)
  UNION ALL SELECT 'pws', file, 'response', 'opened' FROM pws_odd WHERE odd IN (5, 6, 8, 9, 10)
  UNION ALL SELECT 'pws', 'file ' || event_id % 3, 'reading', CASE WHEN left(observed, 1) = 'X' THEN 'mismatch' ELSE 'taken' END
            FROM pws_observations WHERE event_id % 11 IN (5, 6, 8, 9, 10)
  UNION ALL SELECT 'pws', file, 'reading', 'shape' FROM (SELECT *, unnest([0, 1]) FROM pws_odd WHERE odd = 6)
  UNION ALL SELECT 'aq', file, 'document',
         CASE WHEN odd IN (0, 6) THEN 'broken' WHEN odd IN (1, 2, 3) THEN 'shape' WHEN odd = 4 THEN 'empty'
              WHEN message THEN 'shape' ELSE 'opened' END FROM aq_odd
  UNION ALL SELECT 'aq', file, 'reading', CASE WHEN late OR early THEN 'incomplete' WHEN odd = 7 THEN 'time' ELSE 'taken' END
            FROM (SELECT *, unnest([0, 1]) FROM aq_odd WHERE odd IN (5, 7, 8, 9, 10) AND NOT message)
  UNION ALL SELECT 'aq', file, 'reading', 'shape' FROM (SELECT *, unnest([0, 1]) FROM aq_odd WHERE odd = 5 AND NOT message))
GROUP BY ALL"""
CTES["weather_odd"] = """
SELECT *, 'file ' || event_id % 3 AS file, event_id % 11 AS odd,
       CASE WHEN odd_list THEN CASE WHEN accepted THEN 'opened' ELSE 'refused' END WHEN n_observations = 0 THEN 'empty'
            WHEN accepted THEN 'opened' ELSE 'refused' END AS outcome
FROM (SELECT *, status_code = 200 AND language = 'en-US' AND units = 'm' AS accepted, event_id % 11 = 6 AND n_observations > 0 AS odd_list
      FROM weather_responses)"""
CTES["pws_odd"] = "SELECT event_id, 'file ' || event_id % 3 AS file, event_id % 11 AS odd FROM events"
CTES["aq_odd"] = """
SELECT event_id, 'file ' || event_id % 3 AS file, event_id % 11 AS odd, event_type = 'signup' AND value > 60 AS message,
       value > 90 AS late, value < 2 AS early FROM events"""


@query(_LEVELS)
def landing_accounts(spark, sf_dir):
    """Broken documents, other shapes at every level, empty and refused ones among the good: each is counted once."""
    sources = {
        "weather": (inputs.weather_documents, accounting.weather_parts),
        "pws": (inputs.pws_documents, accounting.pws_parts),
        "aq": (inputs.aq_documents, accounting.aq_parts),
    }
    ledgers = []
    for source, (documents, parts) in sources.items():
        counts = accounting.ledger(parts(oddly_landed(documents(spark, sf_dir), source), "file"), "file")
        ledgers.append(counts.select(F.lit(source).alias("source"), "file", "level", "outcome", "parts"))
    return ledgers[0].unionByName(ledgers[1]).unionByName(ledgers[2])


@query("SELECT event_id, station, station AS weather_station FROM weather_responses")
def stamp_station(spark, sf_dir):
    responses = landing.parse_weather(inputs.weather_documents(spark, sf_dir), "event_id")
    return flatten.stamp_station(responses).select("event_id", "station", "weather_station")


@query("""
SELECT station, count(*) AS responses, CAST(sum(n_observations) AS BIGINT) AS observations
FROM weather_responses GROUP BY station""")
def station_count(spark, sf_dir):
    return flatten.station_count(landing.parse_weather(inputs.weather_documents(spark, sf_dir)))


@query("""
SELECT station, event_id, CAST(n_observations AS INTEGER) AS n_observations, language FROM weather_responses
QUALIFY row_number() OVER (PARTITION BY station ORDER BY event_id DESC) = 1""")
def merge_responses_last_wins(spark, sf_dir):
    documents = inputs.weather_documents(spark, sf_dir)
    responses = landing.parse_weather(documents, "event_id").select(
        "event_id", "station", F.size("observations").alias("n_observations"), F.col("metadata.language").alias("language")
    )
    return flatten.merge_last_wins(responses, "station", ["event_id"], landing.response_names(documents, "event_id"))


@query("""
SELECT 'U' || c_custkey || ':9:MY' AS station, responses, observations, responses IS NOT NULL AS found
FROM customer LEFT JOIN (SELECT user_id, count(*) AS responses, CAST(sum(n_observations) AS BIGINT) AS observations
                         FROM weather_responses GROUP BY user_id) ON c_custkey = user_id""")
def requested_station_lookup(spark, sf_dir):
    requested = read(spark, sf_dir, "customer").select(F.concat(F.lit("U"), "c_custkey", F.lit(":9:MY")).alias("station"))
    responses = flatten.station_count(landing.parse_weather(inputs.weather_documents(spark, sf_dir)))
    return flatten.requested_stations(requested, responses)


@query("SELECT ICAO || ':9:MY' AS station FROM state_locations WHERE ICAO IS NOT NULL")
def icao_station_list(spark, sf_dir):
    return flatten.icao_station_list(inputs.state_locations(spark, sf_dir))


@query("SELECT DISTINCT PWStation AS station FROM state_locations WHERE PWStation IS NOT NULL")
def pws_station_list(spark, sf_dir):
    return flatten.pws_station_list(inputs.state_locations(spark, sf_dir))


# --- flattens -----------------------------------------------------------------------------------


@query("""
SELECT strftime(local_time, '%Y-%m-%d %H:%M:%S') AS datetime, 'observation' AS class,
       strftime(local_time + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS expire_time_gmt, observed AS weather_station,
       'Site ' || user_id AS observation_place,
       CASE n WHEN 0 THEN CAST(CAST(floor(value / 8) AS BIGINT) AS VARCHAR) END AS temperature,
       CAST(CAST(floor(value / 10) AS BIGINT) + 990 AS VARCHAR) AS pressure,
       CAST(CAST(floor(value / 20) AS BIGINT) AS VARCHAR) AS wind_speed,
       CASE WHEN kind = 'error' THEN 'NNE' END AS wind_direction_dir, CAST(value AS VARCHAR) AS dew_point,
       kind AS weather_phrase, CAST(NULL AS VARCHAR) AS gust
FROM accepted_observations WHERE left(observed, 1) <> 'X'""")
def flatten_weather(spark, sf_dir):
    accepted, _ = flatten.split_responses(landing.parse_weather(inputs.weather_documents(spark, sf_dir)))
    rows, _ = flatten.flatten_weather(accepted)
    return rows.select(
        "datetime", "class", "expire_time_gmt", "weather_station", "observation_place", "temperature", "pressure",
        "wind_speed", "wind_direction_dir", "dew_point", "weather_phrase", "gust",
    )


@query("""
SELECT strftime(local_time, '%Y-%m-%d %H:%M:%S') AS datetime, observed AS weather_station, CAST(3.5 AS VARCHAR) AS lat,
       CAST(CAST(floor(value / 30) AS BIGINT) AS VARCHAR) AS uv, CAST(CAST(floor(value / 8) AS BIGINT) AS VARCHAR) AS temperature,
       CAST(CAST(floor(value / 20) AS BIGINT) AS VARCHAR) AS wind_speed,
       CAST(CASE WHEN high IS NULL THEN low WHEN low IS NULL THEN high ELSE (high + low) / 2 END AS VARCHAR) AS pressure,
       CAST(value AS VARCHAR) AS precipitation_rate, '1' AS qc_status
FROM pws_observations WHERE left(observed, 1) <> 'X'""")
def flatten_pws(spark, sf_dir):
    responses = flatten.split_pws_responses(landing.parse_pws(inputs.pws_documents(spark, sf_dir)))
    rows, _ = flatten.flatten_pws(responses)
    return rows.select(
        "datetime", "weather_station", "lat", "uv", "temperature", "wind_speed", "pressure", "precipitation_rate", "qc_status"
    )


# The bronze columns of an observation and the field that each one is taken from.
_WEATHER_FIELDS = {
    "blunt_phrase": "blunt_phrase", "class": "class", "clouds": "clds", "day_indicator": "day_ind", "dew_point": "dewPt",
    "feels_like_temperature": "feels_like", "gust": "gust", "heat_index": "heat_index", "icon_extended": "icon_extd",
    "max_temperature": "max_temp", "min_temperature": "min_temp", "observation_place": "obs_name", "precipitation_hourly": "precip_hrly",
    "precipitation_total": "precip_total", "pressure": "pressure", "pressure_desc": "pressure_desc", "pressure_tend": "pressure_tend",
    "qualifier": "qualifier", "qualifier_severity": "qualifier_svrty", "relative_humidity": "rh", "temperature": "temp",
    "terse_phrase": "terse_phrase", "uv_description": "uv_desc", "uv_index": "uv_index", "visibility": "vis",
    "water_temperature": "water_temp", "weather_phrase": "wx_phrase", "wind_chill": "wc", "wind_direction_deg": "wdir",
    "wind_direction_dir": "wdir_cardinal", "wind_speed": "wspd", "wx_icon": "wx_icon",
}
_PWS_FIELDS = {
    "dew_point": "dewptAvg", "gust": "windgustAvg", "heat_index": "heatindexAvg", "humidity": "humidityAvg", "lat": "lat", "lon": "lon",
    "obsTimeLocal": "obsTimeLocal", "obsTimeUtc": "obsTimeUtc", "precipitation_rate": "precipRate", "precipitation_total": "precipTotal",
    "pressure_trend": "pressureTrend", "qc_status": "qcStatus", "solar_radiation_high": "solarRadiationHigh", "temperature": "tempAvg",
    "uv": "uvHigh", "wind_chill": "windchillAvg", "wind_direction": "winddirAvg", "wind_speed": "windspeedAvg",
}


def _filled_sql(fields: dict[str, str]) -> str:
    return ", ".join(f"'{field} ' || event_id % 1000 AS \"{column}\"" for column, field in fields.items())


_LOCAL_HOUR = "date_trunc('hour', ts) + INTERVAL 8 HOUR"


@query(f"""
SELECT strftime({_LOCAL_HOUR}, '%Y-%m-%d %H:%M:%S') AS datetime, strftime({_LOCAL_HOUR} + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS expire_time_gmt,
       'U' || user_id AS weather_station, {_filled_sql(_WEATHER_FIELDS)} FROM events""")
def flatten_weather_columns(spark, sf_dir):
    """All 35 bronze columns, each from a field with values of its own."""
    accepted, _ = flatten.split_responses(landing.parse_weather(inputs.full_weather_documents(spark, sf_dir)))
    return flatten.flatten_weather(accepted)[0]


@query(f"""
SELECT strftime({_LOCAL_HOUR}, '%Y-%m-%d %H:%M:%S') AS datetime, 'U' || user_id AS weather_station,
       event_id % 50 + 1000 || '.5' AS pressure, {_filled_sql(_PWS_FIELDS)} FROM events""")
def flatten_pws_columns(spark, sf_dir):
    """All 21 bronze columns of personal stations."""
    responses = flatten.split_pws_responses(landing.parse_pws(inputs.full_pws_documents(spark, sf_dir)))
    return flatten.flatten_pws(responses)[0]


@query("""
WITH files AS (
  SELECT c_custkey, time AS landed_time, (c_custkey >> (place + 4)) & 1 = 0 AS valid, rank
  FROM customer, (VALUES ('0100', 1, 3), ('1200', 2, 0), ('0700', 3, NULL), ('0000', 4, 2), ('2300', 5, 1)) AS t(time, place, rank)
  WHERE (c_custkey >> (place - 1)) & 1 = 1)
SELECT c_custkey, arg_min(landed_time, rank) FILTER (valid AND rank IS NOT NULL) AS landed_time FROM files GROUP BY c_custkey""")
def header_order_choice(spark, sf_dir):
    """Of several landed matrices the one asked for, then those of 23:00, 00:00 and 01:00, if the header is right."""
    matrices = landing.parse_aq_matrix(inputs.landed_matrices(spark, sf_dir), "c_custkey", "landed_time")
    chosen, none_valid = reshape.choose_valid_matrix(matrices.withColumn("requested", F.lit("1200")), ["c_custkey"], "requested", "landed_time")
    # The cells tell which file the rows are from.
    found = chosen.select("c_custkey", F.get(F.get("rows", F.lit(0)), F.lit(2)).alias("landed_time"))
    return found.unionByName(none_valid.withColumn("landed_time", F.lit(None).cast("string")))


@query("""
SELECT split_part(station_location, ',', 1) AS location, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime,
       CAST(api AS VARCHAR) AS value
FROM aq_readings WHERE datetime IS NOT NULL AND api IS NOT NULL""")
def flatten_aq(spark, sf_dir):
    return flatten.flatten_aq(landing.parse_aq(inputs.aq_documents(spark, sf_dir)))


@query("SELECT station_id, state_id, station_name, station_location, datetime, api FROM aq_readings")
def aq_reading_projection(spark, sf_dir):
    return flatten.aq_readings(landing.parse_aq(inputs.aq_documents(spark, sf_dir)))


@query("SELECT event_id, observed AS weather_station FROM weather_responses WHERE n_observations > 0")
def station_identity(spark, sf_dir):
    responses = landing.parse_weather(inputs.weather_documents(spark, sf_dir), "event_id")
    first = responses.filter(F.size("observations") > 0).select("event_id", F.get("observations", F.lit(0)).alias("obs"))
    return first.select(
        "event_id", flatten.weather_station_id(F.col("obs.obs_id"), F.col("obs.key")).alias("weather_station")
    )


@query("SELECT observed AS weather_station, count(*) AS rejected FROM accepted_observations WHERE left(observed, 1) = 'X' GROUP BY 1")
def station_mismatch_guard(spark, sf_dir):
    accepted, _ = flatten.split_responses(landing.parse_weather(inputs.weather_documents(spark, sf_dir)))
    _, rejected = flatten.flatten_weather(accepted)
    return rejected.groupBy("weather_station").agg(F.count(F.lit(1)).alias("rejected"))


@query("SELECT event_id, date_trunc('second', ts) + INTERVAL 8 HOUR AS local_time FROM events")
def epoch_s_or_ms(spark, sf_dir):
    seconds = F.unix_seconds(F.date_trunc("second", "ts").cast("timestamp"))
    epoch = F.when(F.col("event_type") == "view", seconds * 1000).otherwise(seconds)
    return read(spark, sf_dir, "events").select("event_id", epoch_to_local(epoch).alias("local_time"))


@query("""
SELECT l_shipdate AS datetime, 'S' || l_suppkey AS weather_station, 'Site ' || l_linestatus AS observation_place,
       l_quantity AS temperature, l_extendedprice AS pressure, CAST(l_linenumber AS DOUBLE) AS wind_speed,
       l_returnflag AS weather_phrase, l_discount AS dew_point, l_tax AS relative_humidity, CAST(NULL AS DOUBLE) AS heat_index
FROM lineitem""")
def typed_projection(spark, sf_dir):
    text = inputs.text
    bronze = read(spark, sf_dir, "lineitem").select(
        text(F.col("l_shipdate")).alias("datetime"),
        F.concat(F.lit("S"), "l_suppkey").alias("weather_station"),
        F.concat(F.lit("Site "), "l_linestatus").alias("observation_place"),
        text(F.col("l_quantity")).alias("temperature"),
        text(F.col("l_extendedprice")).alias("pressure"),
        text(F.col("l_linenumber")).alias("wind_speed"),
        F.col("l_returnflag").alias("weather_phrase"),
        text(F.col("l_discount")).alias("dew_point"),
        text(F.col("l_tax")).alias("relative_humidity"),
        F.lit(None).cast("string").alias("heat_index"),
    )
    return flatten.typed_projection(bronze)


@query("""
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal >= 0 THEN c_name WHEN c_mktsegment = 'BUILDING' THEN 'suburb ' || c_nationkey
            WHEN c_mktsegment = 'MACHINERY' THEN 'county ' || c_nationkey ELSE 'suburb ' || c_nationkey END AS town,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'city ' || c_nationkey WHEN c_mktsegment = 'MACHINERY' THEN 'county ' || c_nationkey
            ELSE 'suburb ' || c_nationkey END AS city,
       'state ' || c_nationkey AS state, CASE WHEN c_acctbal >= 5000 THEN CAST(c_custkey AS VARCHAR) END AS postcode
FROM customer""")
def address_town_city(spark, sf_dir):
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    parts = {
        "town": F.when((segment == "BUILDING") & (F.col("c_acctbal") >= 0), F.col("c_name")).when(segment == "BUILDING", ""),
        "city": F.when(segment == "HOUSEHOLD", F.concat(F.lit("city "), nation)),
        "county": F.when(segment == "MACHINERY", F.concat(F.lit("county "), nation)),
        "suburb": F.concat(F.lit("suburb "), nation),
        "state": F.concat(F.lit("state "), nation),
        "postcode": F.when(F.col("c_acctbal") >= 5000, F.col("c_custkey").cast("string")),
    }
    given = F.create_map(*[item for name, part in parts.items() for item in (F.lit(name), part)])
    address = F.map_filter(given, lambda _, part: part.isNotNull())
    customers = read(spark, sf_dir, "customer").select("c_custkey", address.alias("address"))
    return flatten.address_parts(customers).drop("address")


# --- reshapes -----------------------------------------------------------------------------------

CTES["wide_readings"] = """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS Time,
       CAST(max(value) FILTER (event_type = 'click') AS VARCHAR) AS click,
       CAST(max(value) FILTER (event_type = 'error') AS VARCHAR) AS error,
       CAST(max(value) FILTER (event_type = 'purchase') AS VARCHAR) AS purchase,
       CAST(max(value) FILTER (event_type = 'signup') AS VARCHAR) AS signup,
       CAST(max(value) FILTER (event_type = 'view') AS VARCHAR) AS view
FROM events GROUP BY 1"""


def wide_readings(spark, sf_dir):
    """A wide text table: one row per hour, one column per event type as its location."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    return (
        read(spark, sf_dir, "events")
        .groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("Time"))
        .agg(*[F.max(F.when(F.col("event_type") == kind, F.col("value"))).cast("string").alias(kind) for kind in kinds])
    )


@query("""
SELECT Time AS datetime, location, value FROM wide_readings UNPIVOT (value FOR location IN (click, error, purchase, signup, "view"))""")
def melt_historic_aq(spark, sf_dir):
    return reshape.melt_historic(wide_readings(spark, sf_dir))


@query("""
SELECT request_date, state, location, label AS time_label, value,
       CASE WHEN hour = 23 THEN CAST(request_date AS TIMESTAMP)
            ELSE CAST(request_date AS TIMESTAMP) - INTERVAL 1 DAY + to_hours(hour + 1) END AS datetime
FROM (SELECT *, CASE WHEN hour = 23 THEN '12:00AM' WHEN hour < 11 THEN (hour + 1) || ':00AM' WHEN hour = 11 THEN '12:00PM'
                     ELSE (hour - 11) || ':00PM' END AS label FROM matrix_cells WHERE c_mktsegment <> 'MACHINERY')""")
def unpivot_24h_matrix(spark, sf_dir):
    matrices = landing.parse_aq_matrix(inputs.matrix_documents(spark, sf_dir), "request_date")
    return reshape.unpivot_matrix(matrices.filter(reshape.has_expected_header()), "request_date")


@query("""
SELECT zone, c_custkey, landed_time, c_mktsegment <> 'MACHINERY' AS is_expected, CAST(1 AS BIGINT) AS n_rows
FROM (SELECT 'zone ' || c_nationkey AS zone, c_custkey, c_mktsegment,
             CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '0100' WHEN 'HOUSEHOLD' THEN '2300' ELSE '1200' END AS landed_time
      FROM customer)
WHERE c_mktsegment <> 'MACHINERY'
UNION ALL
SELECT 'zone ' || c_nationkey, c_custkey, NULL, false, CAST(0 AS BIGINT) FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def header_order_check(spark, sf_dir):
    documents = inputs.matrix_documents(spark, sf_dir)
    matrices = landing.parse_aq_matrix(documents, "zone", "c_custkey", "landed_time").withColumn("requested", F.lit("1200"))
    chosen, none_valid = reshape.choose_valid_matrix(matrices, ["zone", "c_custkey"], "requested", "landed_time")
    return chosen.select(
        "zone", "c_custkey", "landed_time", F.lit(True).alias("is_expected"), F.size("rows").cast("bigint").alias("n_rows")
    ).unionByName(
        none_valid.select(
            "zone",
            "c_custkey",
            F.lit(None).cast("string").alias("landed_time"),
            F.lit(False).alias("is_expected"),
            F.lit(0).cast("bigint").alias("n_rows"),
        )
    )


@query("SELECT o_orderkey AS reading, o_orderdate AS datetime, o_totalprice AS value FROM orders")
def rename_columns(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return reshape.rename_columns(orders, {"o_orderkey": "reading", "o_orderdate": "datetime", "o_totalprice": "value"})


@query("""
SELECT event_id AS reading, value, event_type AS kind, CAST(NULL AS VARCHAR) AS status FROM events
UNION ALL SELECT o_orderkey, o_totalprice, NULL, o_orderstatus FROM orders""")
def union_all(spark, sf_dir):
    events = read(spark, sf_dir, "events").select(F.col("event_id").alias("reading"), "value", F.col("event_type").alias("kind"))
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("reading"), F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("status")
    )
    return reshape.union_all(events, orders)
