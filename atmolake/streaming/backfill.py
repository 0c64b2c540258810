"""Backfills over a growing set of files, each file once, without a stream.

A ledger beside the table, `<table>_files`, has path, modification time and load of every file whose rows are in the
table. A load lists the files, leaves out those of the ledger, reads the others, writes their rows to a partition of its
own and enters the files last. Rows count only if the ledger has their load for their file, so what a failed load wrote
is never seen, and a file that was changed counts with its last rows alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake.sinks.writers import LOAD, append_table, write_load
from atmolake.sources.landing import scan_pws_pressure
from atmolake.sources.tables import existing_table, read_table

LEDGER = "path string, modified timestamp, load string"


def listed_files(spark: SparkSession, glob: str | list[str]) -> DataFrame:
    """`(path, modified)` of the files of a glob. Only listed: no file is opened."""
    files = spark.read.format("binaryFile").load(glob)
    return files.select("path", F.col("modificationTime").alias("modified"))


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """The ledger of `table`, empty if nothing was loaded yet."""
    ledger = existing_table(spark, f"{table}_files")
    return spark.createDataFrame([], LEDGER) if ledger is None else ledger


def load_new_files(spark: SparkSession, glob: str | list[str], table: str, scan: Callable[[SparkSession, list[str]], DataFrame]) -> int:
    """Load the files of `glob` that are new or changed since; how many there were.

    `scan` reads a list of files to rows that have a column `file`, the path of their file. The list of new files is
    on the driver, as any list of files to read is.
    """
    new = listed_files(spark, glob).join(loaded_files(spark, table), ["path", "modified"], "left_anti").collect()
    if not new:
        return 0
    load = uuid.uuid4().hex
    write_load(scan(spark, [row["path"] for row in new]), table, load)
    entries = spark.createDataFrame([(row["path"], row["modified"], load) for row in new], LEDGER)
    append_table(entries.coalesce(1), f"{table}_files")
    return len(new)


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """The rows that count: of each file those of its last load."""
    last = loaded_files(spark, table).groupBy(F.col("path").alias("file")).agg(F.max_by(LOAD, "modified").alias(LOAD))
    return read_table(spark, table).join(last, ["file", LOAD], "left_semi").drop("file", LOAD)


def load_pws_pressure(spark: SparkSession, glob: str | list[str], table: str, tz: str | None = None) -> int:
    """The backfill of `hourly_pws_pressure`: pressures of all personal-station files that were not loaded before."""
    return load_new_files(spark, glob, table, lambda session, paths: scan_pws_pressure(session, paths, tz, keep_file=True))
