"""The query register: each query stands next to the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atmolake.session import tuned_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(sql: str, *names: str):
    """Register a function `(spark, sf_dir) -> DataFrame` under its own name with its SQL."""

    def register(function):
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            with tuned_for(spark):
                return function(spark, sf_dir)

        for name in names or (function.__name__,):
            if name in QUERIES:
                raise ValueError(f"query {name} is registered twice")
            QUERIES[name] = tuned
            ORACLES[name] = sql
        return function

    return register


# Declared, so that opening a table starts no job to look at its files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


#: Rows of a table that one task takes where each of them becomes something wide, or is sorted.
ROWS_PER_TASK = 50_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a table by `keys` to tasks of about ROWS_PER_TASK rows, however many there are.

    A file may be one row group, which one task reads whatever its size. What groups by the keys afterwards needs no
    exchange. The count reads the footers of the files only.
    """
    return df.repartition(tasks_for(df, ROWS_PER_TASK), *keys)


def tasks_for(df: DataFrame, rows: int) -> int:
    return max(1, -(-df.count() // rows))


def with_ctes(sql: str) -> str:
    """Put in front the named subqueries that the SQL uses, each after those it uses itself."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in ordered and body is not text and re.search(rf"\b{name}\b", text):
                visit(body)
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + f"\n{sql.strip()}"
