"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs to a sink that drops the rows, so all of them are computed and none is collected:
`queries` has the seconds of the second, warm run, `cold` those of the first.

BENCH_FILES (default 8) is the number of files that each larger table is written to, once, before anything is timed. The
given tables have one file with one row group each, which one task reads, however many cores there are; tables of a lake
have many files. BENCH_FILES=0 takes the tables as they are.
"""

from __future__ import annotations

import json
import os
import sys
import time

from atmolake.registry import queries
from atmolake.registry.base import TABLES
from atmolake.session import local_session, scratch_path

HEADLINE = [
    "stg_air_quality", "stg_weather", "stg_pws", "full_locations", "air_quality", "weather", "personal_weather",
    "full_weather_places", "uv", "livability_score", "full_outer_join_3way", "flatten_weather", "flatten_pws",
    "flatten_aq", "scan_weather_json", "melt_historic_aq", "unpivot_24h_matrix", "pollutant_token",
    "merge_responses_last_wins", "min_mean_max_by_station", "duplicate_keys", "missing_days", "backfill_manifest",
    "dq_unique_combo", "dq_relationships", "dq_report", "write_parquet", "incremental_append",
]


def seconds(spark, function, sf_dir: str) -> float:
    start = time.perf_counter()
    function(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def spread(spark, sf_dir: str, files: int) -> str:
    """A folder with the tables that the queries read, the larger ones in several files."""
    folder = scratch_path(spark, "bench")
    for name, schema in TABLES.items():
        table = spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
        table.repartition(1 if name in ("region", "nation") else files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), memory="16g")
    sf, files = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"), int(os.environ.get("BENCH_FILES", "8"))
    if files:
        sf_dir = spread(spark, sf_dir, files)
    functions = queries()
    cold, warm = {}, {}
    for name in names or HEADLINE:
        cold[name] = seconds(spark, functions[name], sf_dir)
        warm[name] = seconds(spark, functions[name], sf_dir)
    result = {
        "metric": "total of headline queries, warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": sf,
        "files": files,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
