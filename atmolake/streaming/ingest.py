"""Landed files to bronze tables, each file once.

The daily load as a stream that stops when it has read what is there: the checkpoint knows which files are done. A batch
opens its documents once and writes three tables beside each other: the bronze rows, `<table>_quarantine` (what it could
not take, with the reason) and `<table>_loads` (the ledger: how many documents, responses and readings of each file there
were and what became of them, and how many rows of each date were written).

A batch writes to partitions of its own, `load=<stream>-<batch>`, and replaces them, so a batch that is repeated after a
failure leaves no row twice; the ledger comes last, and a batch that is in it is not loaded again. The tables are plain
Parquet folders without a streaming log: any reader sees rows that are appended to them in other ways.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from atmolake.fixed_values import LOCAL_TIME_ZONE
from atmolake.operators import accounting
from atmolake.operators.flatten import flatten_aq, flatten_pws, flatten_weather, split_pws_responses, split_responses
from atmolake.sinks.materialize import existing_table
from atmolake.sinks.writers import LOAD, write_load
from atmolake.sources.landing import parse_aq, parse_pws, parse_weather


def landed_documents(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """`value` and `file` of all documents."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select("value", F.col("_metadata.file_path").alias("file"))


def bronze_weather(documents: DataFrame, tz: str = LOCAL_TIME_ZONE) -> DataFrame:
    return flatten_weather(split_responses(parse_weather(documents))[0], tz)[0]


def bronze_pws(documents: DataFrame, tz: str = LOCAL_TIME_ZONE) -> DataFrame:
    return flatten_pws(split_pws_responses(parse_pws(documents)), tz)[0]


def bronze_air_quality(documents: DataFrame) -> DataFrame:
    return flatten_aq(parse_aq(documents))


def quarantined_weather(documents: DataFrame, *keep: str) -> DataFrame:
    """What a load of station weather cannot take: `keep`, `reason`, `station` and `value`."""
    return accounting.set_aside(accounting.weather_parts(documents, *keep), *keep)


#: What opens the documents of each load.
PARTS: dict[Callable, Callable[..., DataFrame]] = {
    bronze_weather: accounting.weather_parts,
    bronze_pws: accounting.pws_parts,
    bronze_air_quality: accounting.aq_parts,
}


def load_batch(documents: DataFrame, table: str, load: str, parts_of: Callable[..., DataFrame]) -> bool:
    """Load the documents (`value`, `file`) of one batch into `table` and the two tables beside it.

    False, and nothing is written, if the ledger has a load of this name already.
    """
    spark = documents.sparkSession
    ledger = existing_table(spark, f"{table}_loads")
    if ledger is not None and not ledger.filter(F.col(LOAD) == load).isEmpty():
        return False
    parts = parts_of(documents, "file").persist()
    try:
        rows = accounting.bronze_rows(parts).withColumn("date", F.col("datetime").cast("timestamp_ntz").cast("date"))
        write_load(rows.hint("rebalance", "date"), table, load, ["date"])
        write_load(accounting.set_aside(parts, "file"), f"{table}_quarantine", load)
        counts = accounting.ledger(parts, "file").withColumn("date", F.lit(None).cast("date"))
        dates = rows.groupBy("date").agg(F.count(F.lit(1)).alias("parts"))
        dates = dates.select(F.lit(None).cast("string").alias("file"), F.lit("date").alias("level"), F.lit("written").alias("outcome"), "parts", "date")
        write_load(counts.unionByName(dates).coalesce(1), f"{table}_loads", load)
    finally:
        parts.unpersist()
    return True


def ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    to_bronze: Callable[[DataFrame], DataFrame],
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load all files of `landing` not loaded before into the bronze table at path `table`, one of `PARTS`.

    A new checkpoint is another stream, whose batches are other loads.
    """
    parts_of = PARTS[to_bronze]

    def load(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.read.json(f"{checkpoint}/metadata", schema="id string").first()["id"]
        load_batch(batch, table, f"{stream}-{number}", parts_of)

    documents = landed_documents(spark, landing, files_per_batch)
    return documents.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
