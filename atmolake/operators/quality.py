"""Data-quality checks. Each gives rows that fail, or counts of them for a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atmolake.operators.aggregates import duplicate_values
from atmolake.operators.lookups import missing_from

REPORT_COLUMNS = ["table", "check", "columns", "failures"]


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(column, failures)` for all columns, from one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "column", "failures")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return duplicate_values(df, column)


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once; NULLs form a combination like any value."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.filter(F.col("occurrences") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """`(value, rows)` of child values without a parent; NULLs are ignored.

    Child rows are counted per value before the join, so a hot value is one row in it.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return missing_from(values, parent, {"value": parent_column})


def accepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """`(value, rows)` of values outside the list; NULLs are ignored."""
    wrong = df.filter(~F.col(column).isin(accepted))
    return wrong.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def conflicting_dependants(df: DataFrame, keys: list[str], dependants: list[str]) -> DataFrame:
    """Keys whose rows do not all have the same dependants: the keys, `least` and `greatest` dependants and `rows`.

    Least and greatest combine on the map side, so a hot key is one row of each task. A NULL dependant is a value like
    any other; NULL keys determine nothing and are left out.
    """
    values = F.struct(*dependants)
    groups = df.dropna("any", subset=keys).groupBy(*keys)
    ends = groups.agg(F.min(values).alias("least"), F.max(values).alias("greatest"), F.count(F.lit(1)).alias("rows"))
    return ends.filter(~F.col("least").eqNullSafe(F.col("greatest")))


def _line(failures: DataFrame, table: str, check: str, columns: str) -> DataFrame:
    return failures.select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), F.lit(columns).alias("columns"), "failures"
    )


def report_not_null(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    return not_null(df, columns).select(
        F.lit(table).alias("table"), F.lit("not_null").alias("check"), F.col("column").alias("columns"), "failures"
    )


def report_unique(table: str, df: DataFrame, column: str) -> DataFrame:
    """Failures are the values that occur more than once."""
    return _line(unique(df, column).agg(F.count(F.lit(1)).alias("failures")), table, "unique", column)


def report_unique_combination(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Failures are the combinations that occur more than once."""
    repeated = unique_combination(df, columns).agg(F.count(F.lit(1)).alias("failures"))
    return _line(repeated, table, "unique_combination", "+".join(columns))


def report_relationships(table: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    orphans = relationships(child, column, parent, parent_column)
    return _line(orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures")), table, "relationships", column)


def report_accepted_values(table: str, df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Failures are the values outside the list."""
    wrong = accepted_values(df, column, accepted).agg(F.count(F.lit(1)).alias("failures"))
    return _line(wrong, table, "accepted_values", column)


def dq_report(lines: list[DataFrame]) -> DataFrame:
    """One row per check: `(table, check, columns, failures)`."""
    return reduce(DataFrame.unionByName, lines)
