"""The declared checks of all tables as data, and the suite that runs them.

Checks of one table that only count rows share one aggregation. Those that need a grouping share one for each key: a
value that must be unique and must have a parent is grouped once, and the counts per value, not the rows, meet the parent.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.fixed_values import ACCEPTED_LABELS, ACCEPTED_POLLUTANTS, ACCEPTED_SYMBOLS


@dataclass(frozen=True)
class Checks:
    """What is declared for one table. `has_parent` maps a column to the table and the column of its parent."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    unique_together: tuple[str, ...] = ()
    accepted: Mapping[str, list[str]] = field(default_factory=dict)
    has_parent: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.not_null) + len(self.unique) + bool(self.unique_together) + len(self.accepted) + len(self.has_parent)

    @property
    def columns(self) -> set[str]:
        """The columns of the table that its checks read."""
        return {*self.not_null, *self.unique, *self.unique_together, *self.accepted, *self.has_parent}


def _location(*columns: str) -> dict[str, tuple[str, str]]:
    """Columns that must be known to the joined locations."""
    return {column: ("full_locations", "identifying_location" if column == "location" else column) for column in columns}


#: The checks that are declared for each table, from the sources to the last model.
DECLARED: dict[str, Checks] = {
    "dev.hourly_air_quality": Checks(not_null=("datetime", "value")),
    "dev.hourly_weather": Checks(not_null=("datetime", "weather_station")),
    "dev.hourly_pws_weather": Checks(not_null=("datetime", "weather_station")),
    "prod.hourly_air_quality": Checks(not_null=("datetime", "value")),
    "prod.hourly_pws_weather": Checks(not_null=("datetime", "weather_station")),
    "city_states": Checks(not_null=("city", "state"), unique=("city",)),
    "city_places": Checks(not_null=("place", "city"), unique=("place",), has_parent={"city": ("city_states", "city")}),
    "state_locations": Checks(
        not_null=("identifying_location", "place", "latitude", "longitude"),
        unique=("identifying_location",),
        has_parent={"place": ("city_places", "place")},
    ),
    "air_quality_warning": Checks(accepted={"label": ACCEPTED_LABELS, "pollutant": ACCEPTED_POLLUTANTS}),
    "stg_hourly_air_quality": Checks(
        not_null=("location", "datetime", "pollutant_value", "pollutant_symbol"),
        unique_together=("location", "datetime"),
        accepted={"pollutant_symbol": ACCEPTED_SYMBOLS},
        has_parent={"location": ("state_locations", "identifying_location")},
    ),
    "stg_hourly_weather": Checks(
        not_null=("weather_station",),
        unique_together=("datetime", "weather_station"),
        has_parent={"weather_station": ("state_locations", "ICAO")},
    ),
    "stg_hourly_pws_weather": Checks(
        not_null=("datetime", "weather_station"),
        unique_together=("datetime", "weather_station"),
        has_parent={"weather_station": ("state_locations", "PWStation")},
    ),
    "full_locations": Checks(not_null=("place", "city", "state"), unique=("identifying_location",)),
    "air_quality": Checks(
        not_null=("location", "place", "datetime", "city", "pollutant_value", "label", "message"),
        unique_together=("location", "datetime"),
        accepted={"pollutant": ACCEPTED_POLLUTANTS},
        has_parent=_location("location", "place", "city"),
    ),
    "weather": Checks(
        not_null=("datetime", "location", "city"),
        unique_together=("location", "datetime"),
        has_parent=_location("location", "place", "city"),
    ),
    "full_weather_places": Checks(
        not_null=("datetime", "city", "state"), unique_together=("place", "datetime"), has_parent=_location("place", "city", "state")
    ),
    "uv": Checks(not_null=("city",), unique_together=("place", "datetime"), has_parent=_location("place", "city")),
    "livability_score": Checks(not_null=("day",)),
}

KINDS = ("not_null", "accepted_values", "unique", "relationships", "unique_combination")


class ChecksFailed(ValueError):
    """Declared checks that did not hold, as rows of the report."""

    def __init__(self, failed: list):
        lines = [f"{row['table']}: {row['check']} of {row['columns']}, {row['failures']} failures" for row in failed]
        super().__init__("; ".join(lines))
        self.failed = failed


def _lines(counts: DataFrame, table: str, counted: list[tuple[str, str, Column]]) -> DataFrame:
    """One row of the report for each (kind, columns, count) of one aggregation."""
    row = counts.agg(*[count.cast("bigint").alias(f"n{i}") for i, (_, _, count) in enumerate(counted)])
    lines = [
        F.struct(F.lit(kind).alias("check"), F.lit(columns).alias("columns"), F.coalesce(f"n{i}", F.lit(0)).alias("failures"))
        for i, (kind, columns, _) in enumerate(counted)
    ]
    return row.select(F.lit(table).alias("table"), F.inline(F.array(*lines)))


def table_report(name: str, tables: Mapping[str, DataFrame], checks: Checks) -> list[DataFrame]:
    """The report of one table, in as many parts as there are aggregations."""
    df, parts = tables[name], []
    narrow = [("not_null", column, F.count_if(F.col(column).isNull())) for column in checks.not_null]
    for column, values in checks.accepted.items():
        narrow.append(("accepted_values", column, F.count_distinct(F.when(~F.col(column).isin(values), F.col(column)))))
    if narrow:
        parts.append(_lines(df, name, narrow))
    for column in dict.fromkeys([*checks.unique, *checks.has_parent]):
        values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        counted = [("unique", column, F.count_if(F.col("rows") > 1))] if column in checks.unique else []
        if column in checks.has_parent:
            parent, key = checks.has_parent[column]
            known = tables[parent].select(F.col(key).alias("value")).distinct().withColumn("known", F.lit(True))
            values = values.join(known, "value", "left")
            counted.append(("relationships", column, F.sum(F.when(F.col("known").isNull(), F.col("rows")))))
        parts.append(_lines(values, name, counted))
    if together := checks.unique_together:
        groups = df.groupBy(*together).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(_lines(groups, name, [("unique_combination", "+".join(together), F.count_if(F.col("rows") > 1))]))
    return parts


def report(tables: Mapping[str, DataFrame], declared: Mapping[str, Checks] = DECLARED) -> DataFrame:
    """`(table, check, columns, failures)` for every declared check of the tables that are given.

    Failures are rows for not_null and relationships, values for unique and accepted_values, and combinations for
    unique_combination. Every aggregation reads its table, so tables that are dear to compute should be written first.
    """
    parts = [part for name, checks in declared.items() if name in tables for part in table_report(name, tables, checks)]
    return reduce(DataFrame.unionByName, parts)


def stop_on_failure(tables: Mapping[str, DataFrame], *names: str, declared: Mapping[str, Checks] = DECLARED) -> None:
    """Raise if a declared check of one of the named tables does not hold. `tables` has their parents too."""
    wanted = {name: declared[name] for name in names if name in declared and name in tables}
    if wanted and (failed := report(tables, wanted).filter("failures > 0").collect()):
        raise ChecksFailed(sorted(failed, key=lambda row: (row["table"], row["check"], row["columns"])))
