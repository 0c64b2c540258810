"""Tables of one environment: `dev` or `prod`, from a catalog database or below a folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from atmolake.fixed_values import TEST_RUN_ROWS

ENVIRONMENTS = ("dev", "prod")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table at `path`; with its schema also if it has no rows and so no files yet."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at `path`, or nothing if there is none."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def scan_table(spark: SparkSession, env: str, table: str, root: str | None = None) -> DataFrame:
    """`env.table` of the catalog, or `root/env/table` in parquet."""
    if env not in ENVIRONMENTS:
        raise ValueError(f"environment must be one of {ENVIRONMENTS}, not {env!r}")
    return spark.table(f"{env}.{table}") if root is None else spark.read.parquet(f"{root}/{env}/{table}")


def source(
    spark: SparkSession, table: str, root: str | None = None, test_run: bool = False, rows: int = TEST_RUN_ROWS
) -> DataFrame:
    """The source of a staging model: all of prod, or some rows of dev for a test run."""
    return test_run_limit(scan_table(spark, "dev", table, root), rows=rows) if test_run else scan_table(
        spark, "prod", table, root
    )


def test_run_limit(df: DataFrame, *order_by: str, rows: int = TEST_RUN_ROWS) -> DataFrame:
    """The first rows for a test run; with `order_by` the same ones each time."""
    return df.orderBy(*order_by).limit(rows) if order_by else df.limit(rows)


test_run_limit.__test__ = False  # not a pytest case
