"""Landed JSON documents.

Each reader comes in two parts: `parse_*` turns a DataFrame with a text column `value` (one
document per row) into typed rows, `scan_*` reads files and calls it. A landed document is one
line, so plain text reading splits files at any line and a file may hold any number of documents.
`whole_file=True` is for pretty-printed files, of which each one must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake import schemas
from atmolake.fixed_values import MATRIX_KEYS, STATION_COUNTRY
from atmolake.functions.casts import safe_double
from atmolake.functions.times import epoch_to_local
from atmolake.operators.flatten import pws_pressure, variant_text


def read_documents(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    """Documents as text, `value`, from a path, a list of paths or a glob."""
    return spark.read.text(path, wholetext=whole_file)


# --- opening documents --------------------------------------------------------------------------
#
# One odd value of another type makes from_json give up the whole document. So what a document holds is
# opened in two ways: at once by its declared schema, and where that gives nothing, level by level, which
# tells the parts of another shape from the others. Every document, and every part of one, comes out with
# what became of it; none is dropped here.

def _is_json(text: Column) -> Column:
    """Whether the text is one JSON value from its first to its last character.

    The JSON functions read one value and leave what follows alone, so the text is put inside an array and inside an
    object: what follows it, another document or the end of a longer one, breaks one or the other.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    in_object = F.json_object_keys(F.concat(F.lit('{"in":'), text, F.lit("}"))).isNotNull()
    return F.coalesce(in_array & in_object, F.lit(False))


def _is_object(text: Column) -> Column:
    """Whether a text that is JSON is an object. NULL stands for the JSON null."""
    return F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))


def _documents(documents: DataFrame, whole: Column, *keep: str) -> DataFrame:
    """`value`, `_object` (JSON and an object), `_json` and `_whole` of every document. Blank lines are none.

    A filter of `value` itself would be pushed below what makes the documents, which were then made for it once more.
    """
    made = documents.select(*keep, F.explode(F.array("value")).alias("value"))
    json = made.filter(F.trim("value") != "").select(*keep, "value", _is_json(F.col("value")).alias("_json"), whole.alias("_whole"))
    return json.select(*keep, "value", "_json", (F.col("_json") & _is_object(F.col("value"))).alias("_object"), "_whole")


class _Maps:
    """Documents that map names to bodies, `{name: {head..., items: [element, ...]}}`."""

    def __init__(self, head: dict[str, str], items: str, element: str):
        self.items, self.element, self.fields = items, element, list(head)
        self.head = ", ".join(f"{name}: {kind}" for name, kind in head.items())
        self.body = f"struct<{self.head}, {items}: array<{element}>>"

    @property
    def whole(self) -> Column:
        """The bodies by name, or NULL if anything in the document has another type."""
        return F.from_json("value", f"map<string, {self.body}>")

    @property
    def texts(self) -> Column:
        """The JSON of the bodies by name."""
        return F.from_json("value", "map<string, string>")

    def parts(self, text: Column) -> Column:
        return F.from_json(text, f"struct<{self.head}, {self.items}: array<string>>")

    def by_level(self, text: Column) -> Column:
        """The body of a JSON text, with those of its elements that are objects; NULL if it is no object itself."""
        parts = self.parts(text)
        given = F.transform(F.filter(parts[self.items], _is_object), lambda element: F.from_json(element, self.element))
        opened = F.struct(*[parts[name].alias(name) for name in self.fields], given.alias(self.items))
        return F.when(_is_object(text), opened.cast(self.body))

    def odd(self, text: Column) -> Column:
        """The JSON of the elements that are no objects."""
        others = F.filter(self.parts(text)[self.items], lambda element: ~_is_object(element))
        return F.transform(others, lambda element: F.coalesce(element, F.lit("null")))


RESPONSES = {
    kind: _Maps(schemas.RESPONSE_HEAD, "observations", observation)
    for kind, observation in (("weather", schemas.WEATHER_OBSERVATION), ("pws", schemas.PWS_OBSERVATION))
}
TILES = _Maps(schemas.TILE_HEAD, "features", schemas.TILE_FEATURE)


def read_maps(documents: DataFrame, kind: _Maps, *keep: str) -> DataFrame:
    """`keep`, `name` and `body` of all entries that are objects, whatever the others are."""
    listed = lambda name, body: F.when(body[kind.items].isNull(), kind.by_level(F.try_element_at(kind.texts, name))).otherwise(body)
    bodies = F.transform_values(kind.whole, listed)
    bodies = F.coalesce(bodies, F.transform_values(kind.texts, lambda name, text: kind.by_level(text)))
    return documents.select(*keep, F.explode(bodies).alias("name", "body")).filter(F.col("body").isNotNull())


def open_maps(documents: DataFrame, kind: _Maps, *keep: str) -> DataFrame:
    """One row for each entry of the documents, whatever its shape.

    Columns: `keep`, `document` (broken, shape, empty or opened), `first` (of its document), `name`, `body` (NULL if
    it is no object), `odd` (the elements that are no objects, as JSON) and `text` (the JSON of what has another
    shape: the document, or an entry without a list). A document that is not opened has one row without a name.
    """
    none = F.lit(None).cast("string")
    no_list = F.array().cast("array<string>")

    def entry(name: Column, body: Column, text: Column, odd: Column) -> Column:
        listed = F.when(body[kind.items].isNull(), F.coalesce(text, F.lit("null"))).otherwise(none)
        return F.struct(name.alias("name"), body.alias("body"), listed.alias("text"), odd.alias("odd"))

    def by_level(name: Column, text: Column) -> Column:
        return entry(name, kind.by_level(text), text, F.coalesce(kind.odd(text), no_list))

    def at_once(e: Column) -> Column:
        # A list that from_json takes has no odd elements, but nulls are nulls of any type.
        listed = F.coalesce(e["value"][kind.items], F.array(F.lit(None)))
        return F.when(F.exists(listed, lambda x: x.isNull()), by_level(e["key"], F.try_element_at(kind.texts, e["key"]))).otherwise(
            entry(e["key"], e["value"], none, no_list)
        )

    parsed = _documents(documents, kind.whole, *keep)
    entries = F.when(F.col("_whole").isNotNull(), F.transform(F.map_entries("_whole"), at_once)).otherwise(
        F.transform(F.map_entries(kind.texts), lambda e: by_level(e["key"], e["value"]))
    )
    parsed = parsed.select(*keep, "value", "_json", F.when(F.col("_object"), entries).alias("_entries"))
    document = (
        F.when(~F.col("_json"), "broken").when(F.col("_entries").isNull(), "shape").when(F.size("_entries") == 0, "empty").otherwise("opened")
    )
    parsed = parsed.select(*keep, document.alias("document"), "value", "_entries")
    parts = parsed.select(
        *keep,
        "document",
        F.when(F.col("document").isin("broken", "shape"), F.col("value")).alias("_value"),
        F.posexplode_outer("_entries").alias("_place", "_entry"),
    )
    return parts.select(
        *keep,
        "document",
        (F.coalesce("_place", F.lit(0)) == 0).alias("first"),
        "_entry.name",
        "_entry.body",
        "_entry.odd",
        F.coalesce("_value", "_entry.text").alias("text"),
    )


def read_list(documents: DataFrame, items: str, element: str, *keep: str) -> DataFrame:
    """`keep` and `element` of all elements that are objects, whatever the others are."""
    texts = F.from_json("value", f"struct<{items}: array<string>>")[items]
    by_level = F.transform(F.filter(texts, _is_object), lambda text: F.from_json(text, element))
    elements = F.coalesce(F.from_json("value", f"struct<{items}: array<{element}>>")[items], by_level)
    return documents.select(*keep, F.explode(elements).alias("element")).filter(F.col("element").isNotNull())


def open_list(documents: DataFrame, items: str, element: str, *keep: str) -> DataFrame:
    """One row for each element of documents `{items: [element, ...]}`.

    Columns: `keep`, `document` (broken, shape, empty or opened), `first`, `element` (NULL if it is no object) and
    `text` (the JSON of a document or an element of another shape).
    """
    texts = F.from_json("value", f"struct<{items}: array<string>>")[items]
    part = lambda element, text: F.struct(element.alias("element"), text.alias("text"))
    none = F.lit(None).cast("string")
    at_once = F.transform("_whole", lambda e: part(e, F.when(e.isNull(), F.lit("null")).otherwise(none)))
    by_level = F.transform(
        texts,
        lambda text: part(
            F.when(_is_object(text), F.from_json(text, element)), F.when(~_is_object(text), F.coalesce(text, F.lit("null"))).otherwise(none)
        ),
    )
    parsed = _documents(documents, F.from_json("value", f"struct<{items}: array<{element}>>")[items], *keep)
    parts = F.when(F.col("_whole").isNotNull(), at_once).otherwise(by_level)
    parsed = parsed.select(*keep, "value", "_json", F.when(F.col("_object"), parts).alias("_parts"))
    document = F.when(~F.col("_json"), "broken").when(F.col("_parts").isNull(), "shape").when(F.size("_parts") == 0, "empty").otherwise("opened")
    parsed = parsed.select(*keep, document.alias("document"), "value", "_parts")
    rows = parsed.select(
        *keep,
        "document",
        F.when(F.col("document").isin("broken", "shape"), F.col("value")).alias("_value"),
        F.posexplode_outer("_parts").alias("_place", "_part"),
    )
    return rows.select(
        *keep, "document", (F.coalesce("_place", F.lit(0)) == 0).alias("first"), "_part.element", F.coalesce("_value", "_part.text").alias("text")
    )


# --- station responses --------------------------------------------------------------------------


def parse_responses(documents: DataFrame, kind: str, *keep: str) -> DataFrame:
    """One row per response: `station` (as requested), `metadata`, `weather_station`, `observations`.

    `keep` names columns of the documents to carry along, such as a load order. What has another shape is not here;
    `operators.accounting` has it, and tells broken documents from others.
    """
    return read_maps(documents, RESPONSES[kind], *keep).select(*keep, F.col("name").alias("station"), "body.*")


def response_names(documents: DataFrame, *keep: str) -> DataFrame:
    """`keep` and the `station` of every response that `parse_responses` gives, without parsing what is in it."""
    objects = F.map_filter(F.from_json("value", "map<string, string>"), lambda name, text: _is_object(text))
    return documents.select(*keep, F.explode(F.map_keys(objects)).alias("station"))


def parse_weather(documents: DataFrame, *keep: str) -> DataFrame:
    return parse_responses(documents, "weather", *keep)


def parse_pws(documents: DataFrame, *keep: str) -> DataFrame:
    return parse_responses(documents, "pws", *keep)


def scan_weather_json(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    return parse_weather(read_documents(spark, path, whole_file))


def scan_pws_json(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    return parse_pws(read_documents(spark, path, whole_file))


def scan_pws_pressure(
    spark: SparkSession, glob: str | list[str], tz: str | None = None, whole_file: bool = False, keep_file: bool = False
) -> DataFrame:
    """`(datetime, weather_station, pressure)` of many files; means are rounded to three places. `file` on request."""
    documents = read_documents(spark, glob, whole_file).select("value", F.col("_metadata.file_path").alias("file"))
    observation = parse_pws(documents, "file").select("file", F.explode("observations").alias("obs")).filter("obs IS NOT NULL").select("file", "obs.*")
    local = epoch_to_local(F.col("epoch"), tz) if tz else epoch_to_local(F.col("epoch"))
    return observation.select(
        local.alias("datetime"),
        variant_text(F.col("stationID")).alias("weather_station"),
        pws_pressure(
            safe_double(F.col("metric.pressureMax")), safe_double(F.col("metric.pressureMin")), places=3
        ).alias("pressure"),
        *(["file"] if keep_file else []),
    )


# --- air quality --------------------------------------------------------------------------------


def parse_aq(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per reading of `api_table_hourly`. What has another shape is not here, see `operators.accounting`."""
    return read_list(documents, schemas.AQ_TABLE, schemas.AQ_READING, *keep).select(*keep, "element.*")


def scan_aq_json(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    return parse_aq(read_documents(spark, path, whole_file))


def parse_aq_matrix(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per document: `header` (array of text) and `rows` (array of arrays of text)."""
    # get() and try_element_at() give NULL for a missing key, also under ANSI mode.
    parsed = documents.select(*keep, F.from_json("value", schemas.MATRIX_DOCUMENT).alias("document"))
    matrix = F.coalesce(
        *[F.try_element_at("document", F.lit(key)) for key in MATRIX_KEYS],
        F.get(F.map_values("document"), F.lit(0)),
    )
    return parsed.select(*keep, matrix.alias("matrix")).select(
        *keep,
        F.get("matrix", F.lit(0)).alias("header"),
        F.slice("matrix", 2, F.greatest(F.size("matrix") - 1, F.lit(0))).alias("rows"),
    )


def scan_aq_matrix(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    """As `parse_aq_matrix`, with `source_file`, whose name tells the request date."""
    documents = read_documents(spark, path, whole_file).select("value", F.col("_metadata.file_name").alias("source_file"))
    return parse_aq_matrix(documents, "source_file")


# --- station tiles ------------------------------------------------------------------------------


def parse_geojson_stations(documents: DataFrame, order_by: str, country: str = STATION_COUNTRY) -> DataFrame:
    """Stations of one country from GeoJSON tiles, each id as first seen by `order_by`.

    Features without a country (airports) are left out. Geometries and properties of another
    type than expected are kept and flagged, as the scan only warns about them.
    """
    tiles = read_maps(documents, TILES, order_by)
    features = (
        tiles.select(
            order_by,
            F.col("name").alias("tile"),
            (F.col("body.type") == "FeatureCollection").alias("is_collection"),
            F.posexplode("body.features").alias("position", "feature"),
        )
        .filter(F.col("feature.properties.country") == country)
        .select(
            F.col("feature.id").alias("station_id"),
            F.struct(F.col(order_by), F.col("tile"), F.col("position")).alias("seen"),
            F.struct(
                F.get("feature.geometry.coordinates", F.lit(1)).alias("latitude"),
                F.get("feature.geometry.coordinates", F.lit(0)).alias("longitude"),
                F.col("feature.properties.neighborhood").alias("neighbourhood"),
                (
                    F.col("is_collection")
                    & (F.col("feature.geometry.type") == "Point")
                    & (F.col("feature.properties.type") == "PWS")
                ).alias("is_expected_type"),
            ).alias("station"),
        )
    )
    # min_by combines on the map side, so a station seen in very many tiles stays cheap.
    first = features.groupBy("station_id").agg(F.min_by("station", "seen").alias("station"))
    return first.select("station_id", "station.*")


def scan_geojson_stations(
    spark: SparkSession, path: str | list[str], country: str = STATION_COUNTRY, whole_file: bool = False
) -> DataFrame:
    documents = read_documents(spark, path, whole_file).select(
        "value", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).alias("seen_in")
    )
    return parse_geojson_stations(documents, "seen_in", country)
