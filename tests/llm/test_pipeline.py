"""The stages one after the other, each against its operator on what the one before kept."""

from __future__ import annotations

import itertools
import random

import corpus_pipeline
from atmolake.llm import common, near_dedup, pii
from atmolake.llm.common import save
from tests.llm.conftest import SF_DIR


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = save(stage(spark, docs, SF_DIR), "test")
        assert docs.columns == columns
        rows = docs.collect()
        kept = {r["doc_id"] for r in rows}
        assert kept <= ids and len(kept) == len(rows) and all(r["n_chars"] == len(r["text"] or "") for r in rows)
        if name == "pii":
            assert kept == ids and all(r["text"] == pii.pseudonymized(before[r["doc_id"]])[0] for r in rows)
        else:
            assert 0 < len(kept) < len(ids)
        ids = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == ids


def test_stages_on_odd_and_empty_tables(spark, edge, nothing):
    for table in (edge, nothing):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            out = save(stage(spark, docs, SF_DIR), "test")
            out.count()
            docs = out if "text" in out.columns else docs
        assert docs.columns == table.columns


def test_repeated_ids_leave_one_row(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, text, "y"), (None, text, "z")], "doc_id long, text string, source string")
    rows = corpus_pipeline.dedup_stage(spark, df, SF_DIR).collect()
    assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1]


def test_near_copies_from_080_on_go(spark):
    """Pairs of 0.80 to 0.85 and pairs just below 0.80, against full sets."""
    rng, docs, similar = random.Random(11), [], set()
    for i in range(300):
        a = [f"p{i}w{j}" for j in range(200)]
        b = list(a)
        for k in rng.sample(range(10, 190), 5):
            b[k] = f"e{k}"
        while rng.random() < 0.7:  # a few shingles more or less
            b.pop()
        s, t = ({tuple(x[j : j + 5]) for j in range(len(x) - 4)} for x in (a, b))
        if 100 * len(s & t) >= 80 * len(s | t):
            similar.add((i, len(s & t) / len(s | t)))
        docs += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    assert any(x < 0.82 for _, x in similar) and 0 < sum(x < 0.85 for _, x in similar) and len(similar) < 300
    rows = corpus_pipeline.dedup_stage(spark, spark.createDataFrame(docs, "doc_id long, text string"), SF_DIR).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in docs} - {2 * i + 1 for i, _ in similar}


def test_tables_for_the_similarity_sought():
    assert [near_dedup.width_for(p) for p in (85, 80)] == [12, 18]


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(80))
    rows = [(1, text("a")), (1, text("b")), (2, text("b")), (3, text("c")), (4, text("c")), (4, text("d")), (4, text("d") + " more"), (5, ""), (5, None), (6, "")]
    out = corpus_pipeline.dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF_DIR).collect()
    kept = sorted((r["doc_id"], (r["text"] or "")[:2]) for r in out)
    assert kept == [(1, "a0"), (1, "b0"), (3, "c0"), (4, "d0"), (5, ""), (6, "")]


def test_columns_of_any_name_come_through(spark):
    """Names that stages use inside, dots among them, keep their values."""
    names = ["_quality", "_Toxicity", "_row", "_pii_found", "_pii", "x.y", "kept", "n"]
    text = lambda k: " ".join(f"{k}word{i}" for i in range(80))
    rows = [(i, text(i % 5), "h", *[f"{name} {i}" for name in names]) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{name}` string" for name in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, SF_DIR), "test")
    assert docs.columns == ["doc_id", "text", "source", *names]
    out = docs.collect()
    assert sorted(r["doc_id"] for r in out) == [0, 1, 2, 3, 4]
    assert all(r[name] == f"{name} {r['doc_id']}" for r in out for name in names)


def test_run_leaves_only_its_result(spark, tmp_path, monkeypatch):
    names = itertools.count()
    monkeypatch.setattr(common, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-{next(names)}")
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.count() > 0 and [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["stage-packing"]
