"""The model graph: from bronze tables and seeds to all marts, full or incremental."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from atmolake.fixed_values import TEST_RUN_ROWS
from atmolake.operators.lookups import broadcast_if_small
from atmolake.operators.staging import stage_air_quality, stage_pws, stage_weather
from atmolake.plans import checks, core
from atmolake.schemas import SEEDS
from atmolake.sinks.materialize import incremental_append, materialize_table
from atmolake.sinks.writers import append_table, replace_dates
from atmolake.sources.csv_files import scan_seed
from atmolake.sources.tables import existing_table, read_table, scan_table, source

MODEL_NAMES = [
    "stg_hourly_air_quality", "stg_hourly_weather", "stg_hourly_pws_weather", "full_locations", "air_quality",
    "weather", "personal_weather", "full_weather_places", "uv", "livability_score",
]


@dataclass(frozen=True)
class Seeds:
    state_locations: DataFrame
    city_places: DataFrame
    city_states: DataFrame
    air_quality_indicators: DataFrame
    air_quality_warning: DataFrame
    uv_info: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Seeds:
        return cls(**{name: scan_seed(spark, f"{folder}/{name}.csv", name) for name in SEEDS})


@dataclass(frozen=True)
class Bronze:
    hourly_weather: DataFrame
    hourly_pws_weather: DataFrame
    hourly_air_quality: DataFrame
    # Rows of a test run that are still to be taken of the distinct air-quality readings.
    air_quality_rows: int | None = None

    @classmethod
    def read(cls, spark: SparkSession, root: str | None = None, test_run: bool = False) -> Bronze:
        """All of prod, or a test run: some rows of dev, of air quality so many distinct readings."""
        weather, personal = (source(spark, table, root, test_run) for table in ("hourly_weather", "hourly_pws_weather"))
        air_quality = scan_table(spark, "dev" if test_run else "prod", "hourly_air_quality", root)
        return cls(weather, personal, air_quality, TEST_RUN_ROWS if test_run else None)


class Models:
    """Every model as a lazy DataFrame, built when it is first asked for."""

    def __init__(self, bronze: Bronze, seeds: Seeds):
        self.bronze = bronze
        self.seeds = seeds

    @cached_property
    def stg_hourly_air_quality(self) -> DataFrame:
        return stage_air_quality(self.bronze.hourly_air_quality, self.bronze.air_quality_rows)

    @cached_property
    def stg_hourly_weather(self) -> DataFrame:
        return stage_weather(self.bronze.hourly_weather)

    @cached_property
    def stg_hourly_pws_weather(self) -> DataFrame:
        return stage_pws(self.bronze.hourly_pws_weather)

    @cached_property
    def full_locations(self) -> DataFrame:
        return core.full_locations(self.seeds.state_locations, self.seeds.city_places, self.seeds.city_states)

    @cached_property
    def locations(self) -> DataFrame:
        """The locations as the side of a join, their size checked once for all models."""
        return broadcast_if_small(self.full_locations)

    @cached_property
    def air_quality(self) -> DataFrame:
        return core.air_quality(
            self.stg_hourly_air_quality,
            self.seeds.air_quality_indicators,
            self.seeds.air_quality_warning,
            self.locations,
        )

    @cached_property
    def weather(self) -> DataFrame:
        return core.weather(self.stg_hourly_weather, self.locations)

    @cached_property
    def personal_weather(self) -> DataFrame:
        return core.personal_weather(self.stg_hourly_pws_weather, self.locations)

    @cached_property
    def full_weather_places(self) -> DataFrame:
        return core.full_weather_places(self.weather, self.air_quality, self.personal_weather)

    @cached_property
    def uv(self) -> DataFrame:
        return core.uv(self.full_weather_places, self.seeds.uv_info)

    @cached_property
    def livability_score(self) -> DataFrame:
        return core.livability_score(self.full_weather_places)


def check_sources(lazy: Models) -> None:
    """Stop if a declared check of the bronze tables, the seeds or the staging models does not hold."""
    tables = {f"prod.{name}": df for name, df in vars(lazy.bronze).items() if isinstance(df, DataFrame)}
    tables |= vars(lazy.seeds) | {name: getattr(lazy, name) for name in MODEL_NAMES if name.startswith("stg_")}
    checks.stop_on_failure(tables, *tables)


def run(bronze: Bronze, seeds: Seeds, warehouse: str, high_mark_only: bool = False, checked: bool = False) -> dict[str, DataFrame]:
    """Bring all models up to date below `warehouse` and return them.

    Locations, combined places and `uv` are rebuilt, as a late reading changes the means of an hour
    that they have already; the enriched readings grow by what is new, staging and
    `livability_score` stay views. Each table is read back from its files, so no
    model recomputes the ones before it, and lost executors cost only the work in flight.

    A second run over the same bronze data adds nothing. `high_mark_only` takes only rows later
    than all before, and so loses late ones. A place with two cities stops the run before any average; with `checked`
    the first table of which a declared check fails stops it too, before the models that read that table.
    """
    lazy = Models(bronze, seeds)

    def rebuild(name: str, datetime: str | None = None) -> DataFrame:
        return materialize_table(getattr(lazy, name), f"{warehouse}/{name}", datetime)

    # The readings have no key that is sure to be unique (a place may have two stations, a station may have no
    # place), so what is new is told row by row.
    def grow(name: str) -> DataFrame:
        mode = "global" if high_mark_only else "per_row"
        return incremental_append(getattr(lazy, name), f"{warehouse}/{name}", "datetime", mode=mode, reach=False)

    def check(*names: str) -> None:
        if checked:
            checks.stop_on_failure({name: getattr(lazy, name) for name in {*names, "full_locations"}}, *names)

    if checked:
        check_sources(lazy)
    # Each table read back takes the place of its plan, before the models after it are built.
    lazy.full_locations = rebuild("full_locations")
    core.require_one_city(lazy.full_locations)
    check("full_locations")
    lazy.air_quality = grow("air_quality")
    lazy.weather = grow("weather")
    lazy.personal_weather = grow("personal_weather")
    check("air_quality", "weather")
    lazy.full_weather_places = rebuild("full_weather_places", "datetime")
    check("full_weather_places")
    lazy.uv = rebuild("uv", "datetime")
    check("uv", "livability_score")
    return {name: getattr(lazy, name) for name in MODEL_NAMES}


def slice_dates(bronze: Bronze, dates: Iterable[date]) -> Bronze:
    """Bronze rows of some local dates.

    Tables in folders per date are pruned by folder; the others by their time text, which sorts
    like the time and whose file statistics let the scan skip files.
    """
    days = sorted(set(dates))

    def part(df: DataFrame) -> DataFrame:
        if "date" in df.columns:
            return df.filter(F.col("date").isin(days))
        if not days:
            return df.limit(0)
        between = (F.col("datetime") >= str(days[0])) & (F.col("datetime") < str(days[-1] + timedelta(days=1)))
        return df.filter(between & F.substring("datetime", 1, 10).isin([str(day) for day in days]))

    parts = (part(df) for df in (bronze.hourly_weather, bronze.hourly_pws_weather, bronze.hourly_air_quality))
    return Bronze(*parts, bronze.air_quality_rows)


DATED_MODELS = ["air_quality", "weather", "personal_weather", "full_weather_places", "uv"]


def refresh_dates(bronze: Bronze, seeds: Seeds, warehouse: str, dates: Iterable[date]) -> dict[str, DataFrame]:
    """Recompute the dated tables for some dates and replace just those dates.

    No model looks beyond its hour, so a date can be computed alone. It reads those days of bronze data and of the
    tables before it however long the history is, takes in late and corrected readings of them, empties days whose
    readings are all gone, and can be repeated.
    """
    days = sorted(set(dates))
    lazy = Models(slice_dates(bronze, days), seeds)
    spark = seeds.state_locations.sparkSession
    lazy.full_locations = materialize_table(lazy.full_locations, f"{warehouse}/full_locations")
    core.require_one_city(lazy.full_locations)
    tables = {"full_locations": lazy.full_locations}
    for name in DATED_MODELS:
        path, df = f"{warehouse}/{name}", getattr(lazy, name)
        replace_dates(df, path, dates=days)
        tables[name] = read_table(spark, path, StructType([*df.schema.fields, StructField("date", DateType())]))
        setattr(lazy, name, tables[name].filter(F.col("date").isin(days)))
    return tables | {"livability_score": core.livability_score(tables["full_weather_places"])}


def refresh_days(bronze: Bronze, seeds: Seeds, warehouse: str, first: date, last: date) -> dict[str, DataFrame]:
    """`refresh_dates` for a closed range of dates: the daily run, or a backfill."""
    return refresh_dates(bronze, seeds, warehouse, [first + timedelta(days=n) for n in range((last - first).days + 1)])


# --- what new loads have touched ----------------------------------------------------------------

BRONZE_TABLES = ["hourly_weather", "hourly_pws_weather", "hourly_air_quality"]


def new_loads(spark: SparkSession, root: str, warehouse: str) -> DataFrame:
    """`(table, load, date)` of the loads below `root`/prod that the models in `warehouse` have not taken in yet.

    From the ledgers that `streaming.ingest` writes; no bronze row is read.
    """
    ledgers = []
    for name in BRONZE_TABLES:
        ledger = existing_table(spark, f"{root}/prod/{name}_loads")
        if ledger is not None:
            written = ledger.filter("level = 'date'").select(F.lit(name).alias("table"), "load", "date")
            ledgers.append(written)
    if not ledgers:
        return spark.createDataFrame([], "table string, load string, date date")
    loads = reduce(DataFrame.unionByName, ledgers)
    taken = existing_table(spark, f"{warehouse}/taken_loads")
    return loads if taken is None else loads.join(taken.select("table", "load"), ["table", "load"], "left_anti")


def run_new_loads(spark: SparkSession, root: str, seeds: Seeds, warehouse: str) -> dict[str, DataFrame] | None:
    """Bring the dated models up to date with the loads since the last call; None if there are none.

    The touched dates, as many as calendar days at most, go into every scan as partition filters, so a load of one day
    reads one day of every table. The loads are marked as taken in last: if the run fails, the next one takes them
    again, which replaces the same dates.
    """
    loads = new_loads(spark, root, warehouse).distinct().collect()
    if not loads:
        return None
    dates = {row["date"] for row in loads if row["date"] is not None}
    tables = refresh_dates(Bronze.read(spark, root), seeds, warehouse, dates)
    taken = sorted({(row["table"], row["load"]) for row in loads})
    append_table(spark.createDataFrame(taken, "table string, load string").coalesce(1), f"{warehouse}/taken_loads")
    return tables
