"""Writers. Files of a dated table go into one folder per date."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from atmolake.sinks import folders
from atmolake.sources.tables import existing_table


def object_path(folder: str, name: str, extension: str, mobile: bool = False) -> str:
    """`folder/name.extension`; the name is cut at its first space, ` mobile` marks mobile stations."""
    stem = name.split(" ")[0] + (" mobile" if mobile else "")
    return f"{folder}/{stem}.{extension}"


def by_date(df: DataFrame, datetime: str) -> DataFrame:
    """Add the partition column `date`, and gather each date in few tasks.

    REBALANCE lets AQE cut the tasks by size: a date with a third of all rows is written by many
    tasks, small dates share one, and no task opens a file for every date.
    """
    return df.withColumn("date", F.col(datetime).cast("timestamp_ntz").cast("date")).hint("rebalance", "date")


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None):
    if not isinstance(df, DataFrame):
        raise TypeError(f"only a DataFrame can be written, not {type(df).__name__}")
    writer = df.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    _writer(df, mode, partition_by).parquet(path)


def write_json(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    _writer(df, mode, partition_by).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    _writer(df, mode, None).option("header", True).csv(path)


#: Partition column of tables that are loaded batch by batch: the name of the load.
LOAD = "load"


def write_load(df: DataFrame, path: str, load: str, partition_by: list[str] | None = None) -> None:
    """Write the rows of one load into partitions of its own, in place of what the same load wrote there before."""
    writer = _writer(df.withColumn(LOAD, F.lit(load)), "overwrite", [*(partition_by or []), LOAD])
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows as they are, without looking for copies.

    In a table that is loaded batch by batch they are a load of their own, below the table's other partition columns.
    """
    target = existing_table(df.sparkSession, path)
    if target is not None and LOAD in target.columns and LOAD not in df.columns:
        df, partition_by = df.withColumn(LOAD, F.lit(f"append-{uuid.uuid4().hex}")), [*(partition_by or []), LOAD]
    _writer(df, "append", partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the whole table. The new rows are written beside it first and then take its place, so the old ones stay
    if the writer fails, and `df` may read from `path`."""
    spark, new, old = df.sparkSession, folders.beside(path, "new"), folders.beside(path, "old")
    try:
        _writer(df, "errorifexists", partition_by).parquet(new)
    except BaseException:
        folders.remove(spark, new)
        raise
    there = folders.exists(spark, path)
    if there:
        folders.move(spark, path, old)
    folders.move(spark, new, path)
    if there:
        folders.remove(spark, old)


def replace_dates(df: DataFrame, path: str, datetime: str = "datetime", dates: Iterable[date] = ()) -> None:
    """Replace the dates that `df` has and keep all others: loading a day twice changes nothing.

    Of `dates`, the days that were loaded, those without a row are emptied.
    """
    dated, written = by_date(df, datetime), Observation()
    dated = dated.observe(written, F.collect_set("date").alias("dates"))
    _writer(dated, "overwrite", ["date"]).option("partitionOverwriteMode", "dynamic").parquet(path)
    for day in set(dates) - set(written.get["dates"] or []):
        folders.remove(df.sparkSession, f"{path}/date={day.isoformat()}")
