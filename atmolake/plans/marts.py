"""The three enriched sources as catalog tables in the same buckets of hour and place.

They are computed once and written. What groups or joins them by hour and place then reads bucket by bucket: the
averages of an hour and place, the joins of the sources and the combined places need no shuffle below the last grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from atmolake.plans.models import Models
from atmolake.sinks import catalog
from atmolake.sources.tables import scan_table

HOUR_AND_PLACE = ["datetime", "place"]
SOURCES = ["weather", "air_quality", "personal_weather"]
#: Buckets of each table. A bucket is read by one task, so at 100 TB there should be about one for each 256 MB.
BUCKETS = 64


#: Bronze rows for each bucket where their number is taken from the tables.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(models: Models, least: int = 8) -> int:
    """As many buckets as keep a task at ROWS_PER_BUCKET bronze rows, however many there are."""
    bronze = models.bronze
    rows = sum(df.count() for df in (bronze.hourly_weather, bronze.hourly_pws_weather, bronze.hourly_air_quality))
    return max(least, -(-rows // ROWS_PER_BUCKET))


def write_marts(models: Models, env: str = "prod", buckets: int = BUCKETS, prefix: str = "") -> list[DataFrame]:
    """Write the sources of `models` as bucketed tables of `env`, each replaced as a whole, and give them back as read."""
    spark = models.bronze.hourly_weather.sparkSession
    for name in SOURCES:
        catalog.replace(getattr(models, name), env, prefix + name, buckets=catalog.Buckets(buckets, HOUR_AND_PLACE))
    return [scan_table(spark, env, prefix + name) for name in SOURCES]
