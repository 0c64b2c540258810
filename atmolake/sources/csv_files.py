"""CSV sources. Every column is read as text or with a declared schema, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake.functions.text import (
    first_segment,
    plain_primes,
    plain_spaces,
    strip_trailing_digits_and_brackets,
)
from atmolake.schemas import SEEDS


def scan_wide_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A wide table whose columns are only known from its header; all text, empty cells NULL."""
    return spark.read.csv(path, header=True, inferSchema=False)


def scan_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dimension seed with its declared schema. Line ends may be CRLF, commas may be quoted."""
    return spark.read.csv(path, header=True, schema=SEEDS[name], enforceSchema=True, quote='"', escape='"')


def read_airports_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Airport list with plain spaces and apostrophes, and station names without notes."""
    raw = scan_wide_csv(spark, path)
    plain = raw.toDF(*[name.replace("\u00a0", " ") for name in raw.columns])
    cleaned = plain.withColumns(
        {
            name: plain_spaces(F.col(name))
            for name in ("City served", "State", "Airport name", "IATA", "ICAO")
            if name in plain.columns
        }
        | {"Coordinates": plain_primes(plain_spaces(F.col("Coordinates")))}
    )
    renamed = cleaned.withColumnsRenamed({"City served": "City", "Airport name": "Weather_station_name"})
    return renamed.withColumn(
        "Weather_station_name",
        strip_trailing_digits_and_brackets(F.trim(first_segment(F.col("Weather_station_name"), "/"))),
    )


def read_date_export_csv(spark: SparkSession, path: str | list[str], column: str) -> DataFrame:
    """Distinct dates of an export."""
    return scan_wide_csv(spark, path).select(F.col(column).cast("date").alias(column)).distinct()
