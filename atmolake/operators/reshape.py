"""Wide to long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atmolake.fixed_values import MATRIX_HEADER, MATRIX_RETRY_TIMES
from atmolake.functions.times import legacy_hour_to_datetime


def melt_locations(wide: DataFrame, time_column: str = "Time") -> DataFrame:
    """`(datetime, location, value)` of a table with one column per location; NULLs kept."""
    named = wide.withColumnRenamed(time_column, "datetime")
    locations = [name for name in named.columns if name != "datetime"]
    return named.unpivot("datetime", locations, "location", "value")


def melt_historic(wide: DataFrame, time_column: str = "Time") -> DataFrame:
    """As `melt_locations`, without rows that miss anything."""
    return melt_locations(wide, time_column).dropna("any")


def has_expected_header(header: str = "header"):
    return F.col(header) == F.array(*[F.lit(label) for label in MATRIX_HEADER])


def choose_valid_matrix(
    matrices: DataFrame, keys: list[str], requested_time: str, landed_time: str
) -> tuple[DataFrame, DataFrame]:
    """The best landed matrix per key with the expected header, and the keys that have none.

    First choice is the file of the requested time, then those of the retry times in order.
    """
    ladder = F.when(F.col(landed_time) == F.col(requested_time), 0)
    for rank, time in enumerate(MATRIX_RETRY_TIMES, start=1):
        ladder = ladder.when(F.col(landed_time) == time, rank)
    ranked = matrices.withColumn("rank", F.when(has_expected_header(), ladder))
    # Only what can be chosen is grouped, and without its header, which is the expected one: the rows of a group are wide.
    candidate = F.when(F.col("rank").isNotNull(), F.struct(F.col(landed_time), F.col("rows")))
    # min_by skips NULL ranks, so one pass gives both the choice and the keys left over.
    best = ranked.select(*keys, "rank", candidate.alias("candidate")).groupBy(*keys).agg(
        F.min("rank").alias("rank"), F.min_by("candidate", "rank").alias("best")
    )
    header = F.array(*[F.lit(label) for label in MATRIX_HEADER])
    chosen = best.filter(F.col("rank").isNotNull()).select(*keys, f"best.{landed_time}", header.alias("header"), "best.rows")
    return chosen, best.filter(F.col("rank").isNull()).select(*keys)


def unpivot_matrix(matrices: DataFrame, request_date: str, *keep: str) -> DataFrame:
    """`(state, location, time_label, datetime, value)` of 24-hour matrices, one row per cell."""
    rows = matrices.select(request_date, *keep, "header", F.explode("rows").alias("row"))
    cells = rows.select(
        request_date,
        *keep,
        F.get("row", F.lit(0)).alias("state"),
        F.get("row", F.lit(1)).alias("location"),
        F.inline(
            F.arrays_zip(
                F.slice("header", 3, F.greatest(F.size("header") - 2, F.lit(0))).alias("time_label"),
                F.slice("row", 3, F.greatest(F.size("row") - 2, F.lit(0))).alias("value"),
            )
        ),
    )
    return cells.withColumn("datetime", legacy_hour_to_datetime(F.col(request_date), F.col("time_label")))


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; a column that a frame lacks is NULL there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
