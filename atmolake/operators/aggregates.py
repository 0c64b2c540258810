"""Small aggregations. Each one combines on the map side, so hot groups do not gather in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_avg(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(name).alias(name) for name in measures])


def group_avg_max(df: DataFrame, keys: list[str], averages: list[str], maxima: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.avg(name).alias(name) for name in averages], *[F.max(name).alias(name) for name in maxima]
    )


def global_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(column))


def station_stats(df: DataFrame, station: str, factor: str) -> DataFrame:
    """Least, mean and greatest value per station, flagging stations with mean 0, in one pass."""
    stats = df.groupBy(station).agg(
        F.min(factor).alias("min_value"), F.avg(factor).alias("mean_value"), F.max(factor).alias("max_value")
    )
    return stats.withColumn("is_zero", F.col("mean_value") == 0)


def null_counts(df: DataFrame) -> DataFrame:
    """`(column, nulls)`, counted in one pass over all columns."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULL is no value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.filter(F.col("occurrences") > 1)


def repeated_rows(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """All rows but the first of each value; `order_by` must be unique within a value.

    The first rows are found by aggregation and taken away by a join on value *and* order, which
    spreads evenly. A window over the value would sort a hot value in one task.
    """
    present = df.filter(F.col(column).isNotNull())
    first = present.groupBy(column).agg(F.min(order_by).alias(order_by))
    return present.join(first, [column, order_by], "left_anti")


def first_rows(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row of each key by `order_by`, which must be a total order."""
    rest = [name for name in df.columns if name not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("first"))
    return first.select(*keys, "first.*")
