"""Benchmark decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from atmolake.llm import decontaminate
from tests.llm.conftest import EDGE

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def plain_words(text: str | None) -> list[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items, length=10):
    windows = []
    for item, text in items:
        words = plain_words(text)
        n = min(length, len(words))
        windows += [(item, tuple(words[i : i + n])) for i in range(len(words) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        words = plain_words(text)
        hit, ids = set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    ids.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        spans, last = [], None
        for i in sorted(hit):
            if i - 1 != last:
                spans.append([i, 0])
            spans[-1][1] += 1
            last = i
        out.append((doc_id, len(words), len(hit), len(ids), digest, bool(hit), [tuple(s) for s in spans]))
    return sorted(out, key=repr)


def got(spark, docs, items, length=10):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    rows = decontaminate.contaminated(docs, items, length).collect()
    return sorted([(*[r[c] for c in COLUMNS], [tuple(s) for s in r["spans"]]) for r in rows], key=repr)


def test_every_shared_window_is_found(spark):
    random.seed(5)
    word = lambda: random.choice("ab cd Ef gh9 É x".split())
    text = lambda n: random.choice([" ", "-", ". "]).join(word() for _ in range(n))
    items = [(i, text(random.randint(0, 30))) for i in range(25)] + [(3, text(12)), (None, text(11)), (90, None), (91, ""), (92, "É")]
    docs = [(i, text(random.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, f"{text(5)} {items[i][1]} {text(9)}") for i in range(25)] + [(7, docs[7][1]), (7, docs[8][1]), (None, items[3][1])]
    items = [x for x in items if len(plain_words(x[1])) not in range(1, 4)] + [(92, "É É É")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, items, 4) == brute(docs, items, 4)


def test_passage_of_many_items_and_documents(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    items = [(i, f"{passage} tail{i}") for i in range(120)] + [(500, "one two three")]
    docs = [(i, f"d{i} {passage}" + " one two three" * (i % 2)) for i in range(300)]
    rows = got(spark, docs, items)
    assert {(r[1], r[2], r[3]) for r in rows} == {(15, 14, 120), (18, 17, 121)}
    assert rows == brute(docs, items)


def test_odd_rows_and_empty_tables(spark, edge, nothing):
    items = spark.createDataFrame([(1, "w10 " * 3 + " ".join(f"W{i}" for i in range(20, 35)), "x")], "item_id long, text string, n_hit string")
    rows = decontaminate.contaminated(edge, items).collect()
    assert len(rows) == len(EDGE)
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {1, 2, 3, 11}
    assert all(r["n_words"] == 0 for r in rows if r["doc_id"] in (4, 5, 6))
    assert decontaminate.contaminated(nothing, items).count() == 0
    without = decontaminate.contaminated(edge, items.limit(0)).collect()
    assert len(without) == len(EDGE) and not any(r["contaminated"] or r["n_hit"] for r in without)


@pytest.mark.parametrize("length", [1, 2, 5, 9, 10])
def test_windows_share_their_fingerprints(length):
    """The guarantee of winnowing: what two texts share in a whole window has the same fingerprint in both."""
    random_ = np.random.default_rng(length)
    for _ in range(50):
        shared = random_.integers(0, 3, length).astype(np.uint64)
        texts = [np.concatenate([random_.integers(0, 3, random_.integers(0, 8)), shared, random_.integers(0, 3, 5)]).astype(np.uint64) for _ in range(2)]
        prints = [set(decontaminate.winnowed(t, np.zeros(len(t), int), length)[1].tolist()) for t in texts]
        assert prints[0] & prints[1]
