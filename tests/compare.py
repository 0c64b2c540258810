"""Run queries next to their SQL on DuckDB and tell where they differ.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    return value


KINDS = {
    "int": "int32", "bigint": "int64", "double": "double", "string": "str", "boolean": "bool", "date": "date",
    "timestamp_ntz": "timestamp", "INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "double", "VARCHAR": "str",
    "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
}


def differences(spark, connection, function, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Number of rows and a list of what differs."""
    df = function(spark, sf_dir)
    names = sorted(df.columns)
    mine = Counter(tuple(normal(row[name]) for name in names) for row in df.collect())
    relation = connection.sql(sql)
    found = []
    types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    theirs_types = {name: KINDS.get(str(kind), str(kind)) for name, kind in zip(relation.columns, relation.types)}
    if types != theirs_types:
        found.append(f"schema {types} against {theirs_types}")
    if set(names) == set(relation.columns):
        order = [relation.columns.index(name) for name in names]
        theirs = Counter(tuple(normal(row[i]) for i in order) for row in relation.fetchall())
        if mine != theirs:
            found.append(f"{mine.total()} rows against {theirs.total()}")
            found += [f"  only here {row}" for row in list((mine - theirs))[:4]]
            found += [f"  only SQL  {row}" for row in list((theirs - mine))[:4]]
    return mine.total(), found


def main(sf_dir: str, *names: str) -> int:
    from atmolake.registry import oracle_sql, queries
    from atmolake.session import local_session

    spark, connection = local_session(8), connect(sf_dir)
    functions, oracles = queries(), oracle_sql()
    bad = 0
    for name in names or functions:
        start = time.time()
        try:
            rows, found = differences(spark, connection, functions[name], oracles[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            rows, found = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok':4}{name:32}{rows:9} rows {time.time() - start:6.2f} s", flush=True)
        for line in found:
            print(line)
    print(f"{bad} bad of {len(names or functions)}")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
