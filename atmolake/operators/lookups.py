"""Lookups, gaps and matches between tables.

A side is broadcast only if its size is known to be small: Catalyst compares file sizes with
`spark.sql.autoBroadcastJoinThreshold`, and `broadcast_if_small` measures a side whose size
Catalyst cannot know. Beyond that both sides are shuffled, and AQE splits the partitions of hot
keys; all joins here keep the big side on the left, which skew splitting supports. AQE can only do
so if the other side comes straight from a shuffle: a big dimension that is itself an aggregation
on the join key should be written as a table first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Bytes of text that a measured dimension may have to be sent to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024


# What a value takes beside its text: its place in the row, and its share of the row and of the hash table.
FIELD_BYTES = 24


def broadcast_if_small(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a dimension for broadcast if its rows stay below `max_bytes`: the lengths of all values as text, and
    FIELD_BYTES for each field of each row, also for the NULL ones.

    Catalyst guesses the size of a joined dimension as the product of its inputs and so would
    shuffle the whole fact table for a dimension of a few thousand rows. Runs one aggregation
    over the dimension; a bigger one is returned as it is, for a shuffled join.
    """
    texts = [F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0)) for name in dim.columns]
    row = sum(texts, F.lit(FIELD_BYTES * len(dim.columns))).cast("long")
    size = dim.agg(F.sum(row)).first()[0]
    return F.broadcast(dim) if size is None or size <= max_bytes else dim


def lookup_left(fact: DataFrame, dim: DataFrame, on: dict[str, str], take: list[str]) -> DataFrame:
    """Every fact row with the `take` columns of its dimension row, NULL if there is none.

    `on` maps fact columns to dimension columns.
    """
    side = dim.select(*[F.col(key).alias(f"_on_{key}") for key in on.values()], *take)
    condition = [fact[left] == side[f"_on_{right}"] for left, right in on.items()]
    return fact.join(side, condition, "left").drop(*[f"_on_{key}" for key in on.values()])


def _renamed_keys(known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Each known key once: copies are combined before the shuffle, so a hot key is one row on this side."""
    return known.select(*[F.col(right).alias(left) for left, right in on.items()]).distinct()


def missing_from(df: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key is not known. NULL keys are never known."""
    return df.join(_renamed_keys(known, on), list(on), "left_anti")


def known_in(df: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key is known."""
    return df.join(_renamed_keys(known, on), list(on), "left_semi")


def unknown_values(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Distinct values of a column that are not known.

    Distinct first: a value that fills a third of the table is one row before the join.
    """
    return missing_from(df.select(column).distinct(), known, {column: known_column})


def unknown_headers(wide: DataFrame, id_column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Column names of a wide table, `location`, that are not known."""
    names = F.array(*[F.lit(name) for name in wide.columns if name != id_column])
    headers = wide.sparkSession.range(1).select(F.explode(names).alias("location"))
    return missing_from(headers, known, {"location": known_column})


def new_stations(scanned: DataFrame, locations: DataFrame, station: str = "station_id") -> DataFrame:
    """Scanned stations that no location lists yet."""
    return missing_from(scanned, locations, {station: "PWStation"})
