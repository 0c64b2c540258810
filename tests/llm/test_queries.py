"""The queries next to their SQL, and what all operators do with odd input."""

from __future__ import annotations

import public_tokenizers
import pytest

import __spark_entry__
from atmolake.llm import ann, bpe, licenses, lm, near_dedup, packing, pii, quality, sharding, toxicity
from atmolake.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.llm.conftest import EDGE, SF_DIR


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    _, found = differences(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR)
    assert not found, "\n".join(found)


def test_all_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["op4_license_scan", "op5_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


TOKENS = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PER_ROW = {
    "lm": lambda df: lm.scored(df, RANKS),
    "sharding": lambda df: sharding.assigned(df, 500),
    "licenses": lambda df: licenses.scan(df.selectExpr("doc_id AS id", "concat(source, '/', doc_id) AS path", "text")),
    "quality": quality.quality_rules,
    "near_dedup": near_dedup.near_duplicates,
    "pii": pii.pseudonymize,
    "bpe": lambda df: bpe.coded(df, RANKS),
    "toxicity": lambda df: toxicity.scored(df, toxicity.train(df, df.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic"))),
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_for_each_document(edge, nothing, name):
    rows = PER_ROW[name](edge).collect()
    assert len(rows) == len(EDGE)
    assert PER_ROW[name](nothing).count() == 0


def test_packing_of_odd_and_empty_tables(edge, nothing):
    pack = lambda df: packing.pack(packing.pieces(df, packing.byte_bpe, TOKENS))
    rows = pack(edge).collect()
    assert sum(r["length"] for r in rows if r["start"] == 0 or True) == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    assert pack(nothing).count() == 0


def test_neighbours_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(empty, empty).count() == 0
