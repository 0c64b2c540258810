"""Tables of the catalog, by name: `dev.hourly_weather`, `prod.hourly_weather`.

A table's files lie in a folder of their own below the location of its database, one folder for each time that the table
was replaced. A replacement is written in full under another name first; then the names change places, which touches no
file. So readers have either the old rows or the new ones, and if the writer fails the old ones stay.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from atmolake.sinks import folders
from atmolake.sinks.writers import _writer
from atmolake.sources.tables import ENVIRONMENTS


class Buckets(NamedTuple):
    """Rows are dealt to so many files by the hash of some columns, so that joins and groupings on them need no shuffle."""

    number: int
    columns: list[str]


def _named(env: str, table: str) -> str:
    if env not in ENVIRONMENTS:
        raise ValueError(f"environment must be one of {ENVIRONMENTS}, not {env!r}")
    if not table.isidentifier():
        raise ValueError(f"not the name of a table: {table!r}")
    return f"{env}.{table}"


def _create(df: DataFrame, env: str, table: str, folder: str, partition_by: list[str] | None, buckets: Buckets | None = None) -> None:
    spark = df.sparkSession
    location = f"{spark.catalog.getDatabase(env).locationUri}/{folder}/{uuid.uuid4().hex}"
    try:
        if buckets:  # each bucket is one file, written by one task
            df = df.repartition(buckets.number, *buckets.columns)
        writer = _writer(df, "errorifexists", partition_by)
        if buckets:
            writer = writer.bucketBy(buckets.number, *buckets.columns).sortBy(*buckets.columns)
        writer.format("parquet").option("path", location).saveAsTable(f"{env}.{table}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {env}.{table}")
        folders.remove(spark, location)
        raise


def ensure_environments(spark: SparkSession, root: str | None = None) -> None:
    """Make the databases that are not there yet, in the warehouse of the session or below `root`."""
    for env in ENVIRONMENTS:
        place = f" LOCATION '{root}/{env}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {env}{place}")


def append(df: DataFrame, env: str, table: str, partition_by: list[str] | None = None) -> None:
    """Append rows by the names of their columns; a table that is not there yet begins with them."""
    name = _named(env, table)
    if df.sparkSession.catalog.tableExists(name):
        _writer(df, "append", partition_by).format("parquet").saveAsTable(name)
    else:
        _create(df, env, table, table, partition_by)


def replace(df: DataFrame, env: str, table: str, partition_by: list[str] | None = None, buckets: Buckets | None = None) -> None:
    """Replace the whole table, columns, partitioning and buckets too. `df` may read from it."""
    spark, name = df.sparkSession, _named(env, table)
    new, old = f"{table}_new_{uuid.uuid4().hex}", f"{table}_old_{uuid.uuid4().hex}"
    _create(df, env, new, table, partition_by, buckets)
    there = spark.catalog.tableExists(name)
    if there:
        location = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
        spark.sql(f"ALTER TABLE {name} RENAME TO {env}.{old}")
    spark.sql(f"ALTER TABLE {env}.{new} RENAME TO {name}")
    if there:
        spark.sql(f"DROP TABLE {env}.{old}")
        folders.remove(spark, location)


def load(df: DataFrame, env: str, table: str, partition_by: list[str] | None = None, append_rows: bool = True) -> None:
    """The load of a table: append by default, else replace."""
    (append if append_rows else replace)(df, env, table, partition_by)
