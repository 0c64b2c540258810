"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

from atmolake.llm import runs
from atmolake.llm.queries import QUERIES
from tests.llm.conftest import EDGE, SF_DIR


def brute(words):
    """All runs as (start, length, period), by comparing every word with every one after it."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(i, j) + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda run: (run[0], run[2]))


def made(random_, n):
    words = [b"%d" % random_.randrange(random_.randint(1, 5)) for _ in range(n)]
    for _ in range(random_.randint(0, 3)):
        block = [b"%d" % random_.randrange(4) for _ in range(random_.randint(1, 8))]
        at = random_.randint(0, len(words))
        words[at:at] = (block * 11)[: random_.randint(1, 10 * len(block))]
    return words


def test_runs_of_many_texts():
    random_ = random.Random(7)
    for _ in range(400):
        texts = [made(random_, random_.randint(0, 50)) for _ in range(random_.randint(1, 5))]
        assert runs.periodic_runs(texts) == [brute(words) for words in texts]


def test_grammar_alone_finds_them():
    """Without cutting words away before."""
    random_ = random.Random(8)
    for _ in range(300):
        words = made(random_, random_.randint(1, 60))
        ids = np.array([int(w) for w in words])
        assert [(s, e - s, q) for s, e, q in runs.found_runs(ids, np.zeros(len(ids), int))] == brute(words)


def test_grammar_derives_its_text():
    random_ = random.Random(9)
    for _ in range(100):
        text = np.array([int(w) for w in made(random_, 60)])
        grammar = runs.Grammar(text)

        def derived(symbol):
            if symbol < grammar.terminals:
                return [symbol]
            i = symbol - grammar.terminals
            return derived(grammar.left[i]) + derived(grammar.right[i])

        assert [w for s in grammar.sequence for w in derived(s)] == text.tolist()
        rules = np.arange(len(grammar.left)) + grammar.terminals
        for rule, places in grammar.places(rules).items():
            word = derived(rule)
            assert all(text[p : p + len(word)].tolist() == word for p in places.tolist())
        pairs = list(zip(grammar.sequence[:-1].tolist(), grammar.sequence[1:].tolist()))
        assert all(a == b or pairs.count((a, b)) == 1 for a, b in pairs)


def test_long_texts():
    block = [b"%d" % i for i in range(2500)]
    assert runs.periodic_runs([block * 9, [b"a"] * 30_000, [b"a", b"b"] * 9_000, block]) == [[(0, 22_500, 2500)], [(0, 30_000, 1)], [(0, 18_000, 2)], []]


def expected(doc_id, text):
    words = text.encode().split() if text else []
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = (None,) * 4
    if found:
        s, length, q = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found).encode()
    return (doc_id, len(found), *best, digest(listed), digest(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark, documents):
    rows = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()}
    short = [d for d in documents if len((d[1] or "").split()) < 1500]
    assert len(rows) == len(documents) and len(short) > 150
    assert sum(rows[i][1] > 0 for i, _ in short) > 5
    for doc_id, text in short:
        assert rows[doc_id] == expected(doc_id, text)


def test_odd_rows(spark, edge, nothing):
    rows = runs.detected(edge, alter=True).collect()
    names = ["doc_id", *runs.FIELDS]
    plain = [(i, text) for i, text, _ in EDGE]
    assert sorted((tuple(r[c] for c in names) for r in rows), key=repr) == sorted((expected(*d) for d in plain), key=repr)
    assert all(hashlib.sha256(r["collapsed"].encode()).hexdigest() == r["collapsed_sha256"] for r in rows)
    assert all(r["n_runs"] == len(r["runs"]) for r in rows)
    assert runs.detected(nothing).count() == 0
