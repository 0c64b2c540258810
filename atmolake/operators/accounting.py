"""What became of every landed document and of every part of one.

`weather_parts`, `pws_parts` and `aq_parts` open documents once and give one row for each smallest part: a reading, a
response that has none, or a document that has no responses. A part is either taken, and then `row` is its bronze row, or
set aside with a reason, and then `value` is its JSON, or empty. `bronze_rows` and `set_aside` are the two tables of a
load, `ledger` counts the outcomes at each level, so that what landed can be compared with what was written:

* document: broken (no JSON), shape (JSON of another shape), empty (without responses or readings), opened
* response: shape, refused (status, language or units), empty (without observations), opened
* reading: shape, mismatch (another station than requested), incomplete (no time or no value), time (text that is no
  time), taken
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake import schemas
from atmolake.fixed_values import LOCAL_TIME_ZONE
from atmolake.functions.times import parse_iso_datetime
from atmolake.operators.flatten import aq_columns, is_accepted, pws_columns, station_matches, weather_columns
from atmolake.sources.landing import RESPONSES, open_list, open_maps

PARTS = ["document", "first_of_document", "response", "first_of_response", "reading", "station", "value", "row"]


def _response_parts(opened: DataFrame, response: Column, refused: Column, columns: list[Column], *keep: str) -> DataFrame:
    """Parts of opened responses; `response` tells what became of one, `columns` make the bronze row of `obs`."""
    listed = F.coalesce(F.col("body.observations"), F.array())
    none = F.lit(None).cast("string")
    readings = F.concat(
        F.transform(listed, lambda obs: F.struct(obs.alias("obs"), none.alias("odd"))),
        F.transform(F.coalesce("odd", F.array()), lambda text: F.struct(F.lit(None).cast(opened.schema["body"].dataType["observations"].dataType.elementType).alias("obs"), text.alias("odd"))),
    )
    responses = opened.select(
        *keep, "document", F.col("first").alias("first_of_document"), F.col("name").alias("station"),
        F.when(F.col("document") == "opened", response).alias("response"), F.coalesce("text", refused).alias("_text"), readings.alias("_readings"),
    )
    kept = [*keep, "document", "first_of_document", "station", "response"]
    opens = F.col("response") == "opened"
    parts = responses.select(
        *kept,
        F.when(F.col("response").isin("shape", "refused") | F.col("document").isin("broken", "shape"), F.col("_text")).alias("_text"),
        F.posexplode_outer(F.when(opens, F.col("_readings"))).alias("_place", "_reading"),
    ).select(*kept, "_text", F.coalesce("_place", F.lit(0)).alias("_place"), F.col("_reading.obs").alias("obs"), F.col("_reading.odd").alias("_odd"))
    rows = parts.select(*kept, "_text", "_place", "_odd", F.struct(*columns).alias("row"))
    reading = F.when(F.col("_odd").isNotNull(), "shape").when(~station_matches(F.col("station"), F.col("row.weather_station")), "mismatch").otherwise("taken")
    rows = rows.withColumn("reading", F.when(opens, reading))
    mismatch = F.when(F.col("reading") == "mismatch", F.to_json(F.struct("station", "row.*")))
    return rows.select(
        *keep,
        "document",
        (F.col("first_of_document") & (F.col("_place") == 0)).alias("first_of_document"),
        "response",
        (F.col("response").isNotNull() & (F.col("_place") == 0)).alias("first_of_response"),
        "reading",
        "station",
        F.coalesce("_text", "_odd", mismatch).alias("value"),
        F.when(F.col("reading") == "taken", F.col("row")).alias("row"),
    )


def weather_parts(documents: DataFrame, *keep: str, tz: str = LOCAL_TIME_ZONE) -> DataFrame:
    """PARTS of landed station weather."""
    opened = open_maps(documents, RESPONSES["weather"], *keep)
    metadata, listed = F.col("body.metadata"), F.col("body.observations")
    given = F.size(F.coalesce(listed, F.array())) + F.size(F.coalesce("odd", F.array()))
    # A refusal often comes without a list, so it is told from another shape by its status.
    response = (
        F.when(listed.isNull(), F.when(metadata["status_code"].isNotNull() & ~is_accepted(metadata), "refused").otherwise("shape"))
        .when(given == 0, "empty")
        .when(~is_accepted(metadata), "refused")
        .otherwise("opened")
    )
    refused = F.to_json(F.struct(metadata.alias("metadata"), F.col("body.weather_station").alias("weather_station"), given.alias("n_observations")))
    return _response_parts(opened, response, refused, weather_columns(tz), *keep)


def pws_parts(documents: DataFrame, *keep: str, tz: str = LOCAL_TIME_ZONE) -> DataFrame:
    """PARTS of landed personal-station weather, whose responses carry no status."""
    opened = open_maps(documents, RESPONSES["pws"], *keep)
    listed = F.col("body.observations")
    given = F.size(F.coalesce(listed, F.array())) + F.size(F.coalesce("odd", F.array()))
    response = F.when(listed.isNull(), "shape").when(given == 0, "empty").otherwise("opened")
    return _response_parts(opened, response, F.lit(None).cast("string"), pws_columns(tz), *keep)


def aq_parts(documents: DataFrame, *keep: str) -> DataFrame:
    """PARTS of landed air quality; there is no level of responses."""
    opened = open_list(documents, schemas.AQ_TABLE, schemas.AQ_READING, *keep)
    rows = opened.select(*keep, "document", F.col("first").alias("first_of_document"), "text", "element", "element.*")
    rows = rows.withColumn("_time", parse_iso_datetime(F.col("DATETIME"), strict=False))
    reading = (
        F.when(F.col("element").isNull(), "shape")
        .when(F.col("DATETIME").isNull() | F.col("API").isNull(), "incomplete")
        .when(F.col("_time").isNull(), "time")
        .otherwise("taken")
    )
    rows = rows.withColumn("reading", F.when(F.col("document") == "opened", reading))
    none = F.lit(None).cast("string")
    return rows.select(
        *keep,
        "document",
        "first_of_document",
        none.alias("response"),
        F.lit(False).alias("first_of_response"),
        "reading",
        F.col("STATION_ID").alias("station"),
        F.coalesce("text", F.when(F.col("reading").isin("incomplete", "time"), F.to_json("element"))).alias("value"),
        F.when(F.col("reading") == "taken", F.struct(*aq_columns(F.col("_time")))).alias("row"),
    )


def bronze_rows(parts: DataFrame, *keep: str) -> DataFrame:
    """The rows that a load writes to its bronze table."""
    return parts.filter(F.col("reading") == "taken").select(*keep, "row.*")


def set_aside(parts: DataFrame, *keep: str) -> DataFrame:
    """What a load cannot take: `reason`, the `station` asked for where it is known, and `value`, the JSON of the part."""
    reason = F.coalesce("reading", F.nullif("response", F.lit("opened")), "document")
    aside = parts.select(*keep, reason.alias("reason"), "station", "value")
    return aside.filter(~F.col("reason").isin("taken", "empty"))


def ledger(parts: DataFrame, *by: str) -> DataFrame:
    """`by`, `level`, `outcome`, `parts`: how many documents, responses and readings there were, and what became of them."""
    each = [
        (F.col("first_of_document"), "document"),
        (F.col("first_of_response"), "response"),
        (F.col("reading").isNotNull(), "reading"),
    ]
    counted = [F.when(is_one, F.struct(F.lit(level).alias("level"), F.col(level).alias("outcome"))) for is_one, level in each]
    levels = parts.select(*by, F.inline(F.filter(F.array(*counted), lambda x: x.isNotNull())))
    return levels.groupBy(*by, "level", "outcome").agg(F.count(F.lit(1)).alias("parts"))
