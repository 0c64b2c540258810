"""How a model is kept: as a view, as a table that is rebuilt, or as a table that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atmolake.sinks.writers import append_table, by_date, replace_table
from atmolake.sources.tables import existing_table, read_table

MODES = ("per_key", "per_row", "global")


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A temporary view: nothing runs, every reader gets the whole plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, path: str, datetime: str | None = None) -> DataFrame:
    """Rebuild a table in full; with `datetime`, one folder per date."""
    if datetime is None:
        replace_table(df, path)
        return read_table(df.sparkSession, path, df.schema)
    dated = by_date(df, datetime)
    replace_table(dated, path, ["date"])
    return read_table(df.sparkSession, path, dated.schema)


def newer_than_table(df: DataFrame, target: DataFrame, datetime: str) -> DataFrame:
    """Rows later than the latest row of the target; all rows if the target is empty.

    The high mark is one value, read from file statistics where the scan can, and goes into the
    plan as a literal, so the filter prunes files. Late rows are lost for good, as they are not
    later than the mark: use `not_in_table` unless exactly that is wanted.
    """
    (high,) = target.agg(F.max(datetime)).first()
    return df if high is None else df.filter(F.col(datetime) > F.lit(high).cast(df.schema[datetime].dataType))


def _in_reach(df: DataFrame, target: DataFrame, datetime: str) -> DataFrame:
    """The part of the target that the rows of `df` can meet: their time range, whole dates pruned."""
    low, high = df.agg(F.min(datetime), F.max(datetime)).first()
    kind = df.schema[datetime].dataType
    in_reach = F.col(datetime).isNull()
    if low is not None:
        in_reach = in_reach | F.col(datetime).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        if "date" in target.columns:
            days = F.col("date").between(F.lit(low).cast("date"), F.lit(high).cast("date"))
            target = target.filter(F.col("date").isNull() | days)
    return target.filter(in_reach)


def not_in_table(df: DataFrame, target: DataFrame, datetime: str, keys: list[str], reach: bool = True) -> DataFrame:
    """Rows whose key the target does not have yet, however late they are."""
    known = (_in_reach(df, target, datetime) if reach else target).select(*[F.col(key).alias(f"_known_{key}") for key in keys])
    condition = [df[key].eqNullSafe(known[f"_known_{key}"]) for key in keys]
    return df.join(known, condition, "left_anti")


def rows_not_in_table(df: DataFrame, target: DataFrame, datetime: str, reach: bool = True) -> DataFrame:
    """Rows that the target does not have yet as often as `df` has them, however late they are.

    For tables without a key: appending the result makes the target hold every row as often as a
    full rebuild would.
    """
    return df.exceptAll((_in_reach(df, target, datetime) if reach else target).select(*df.columns))


def incremental_append(
    df: DataFrame, path: str, datetime: str = "datetime", keys: list[str] | None = None, mode: str = "per_key", reach: bool = True
) -> DataFrame:
    """Append the rows that are new: by key (`per_key`), as whole rows (`per_row`) or by time alone (`global`).

    With `reach`, the time range of `df` is computed first, so that only those dates of the target are read. That pays
    for a batch; for rows of the whole history, which reach everything, it would only compute them twice.
    """
    if mode not in MODES or (mode == "per_key" and not keys):
        raise ValueError(f"mode must be one of {MODES}, and per_key needs keys")
    target = existing_table(df.sparkSession, path)
    if target is None:
        new = df
    elif mode == "global":
        new = newer_than_table(df, target, datetime)
    elif mode == "per_row":
        new = rows_not_in_table(df, target, datetime, reach)
    else:
        new = not_in_table(df, target, datetime, keys, reach)
    dated = by_date(new, datetime)
    append_table(dated, path, ["date"])
    return read_table(df.sparkSession, path, dated.schema)
