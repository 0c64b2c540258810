"""Near duplicates by MinHash with tensored banding.

A table key of k minhashes is a pair: one value of the left collection and one of the right, each made of k/2
minhashes. `width` values on either side give width**2 tables from 2 * width * HALF minhashes, where plain banding
computes HALF * 2 * width**2. Two texts of similarity s meet with probability (1 - (1 - s**HALF)**width)**2. The width
follows from the similarity sought, so that this is 0.9997 at least: 12 for 0.85, 18 for 0.80. A pair of values can only be shared if each of them is, so the tables are formed
only from values that two texts share; most texts have none and go no further.

Texts of one shingle set are one node, so copies never meet each other in a bucket. Every candidate is confirmed on
full sets. In a bucket all members are first compared with its smallest and its largest, which joins most of a group
of G like texts in about G comparisons. Then members that are still in different components are compared with each
other, so no link between components is left out.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.llm.common import Memo, drop, give_back, save, words_of

SHINGLE = 5
HALF = 4
#: Probability with which two texts that are just similar enough meet, at least.
MEET = 0.9997
#: Probability with which a pair is taken for unlike by its minhashes although it is just similar enough, at most.
MISSED = 1e-9
#: Minhashes of candidates, to tell what is nearly similar enough from what is.
FINE = 1024

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)


def _mix(acc: np.ndarray, value: np.ndarray) -> np.ndarray:
    acc = (acc ^ value) * _GOLDEN
    return acc ^ (acc >> _SHIFT)


_word_hash = Memo(xxhash.xxh64_intdigest, 100_000)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a text of fewer words is one shingle, one without words none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    acc = np.full(n, size, np.uint64)
    for j in range(size):
        acc = _mix(acc, hashes[j : j + n])
    return np.unique(acc)


@functools.cache
def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(n).integers(0, 2**63, size=(2, n), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def minhashes(shingles: np.ndarray, n: int) -> np.ndarray:
    factor, offset = _coefficients(n)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):  # in blocks, so that memory is the same for any text
        part = shingles[start : start + 1024, None]
        np.minimum(least, ((part ^ offset) * factor).min(axis=0), out=least)
    return least


def width_for(percent: int) -> int:
    """Values of either collection; even, so that their minhashes fill longs of 16."""
    width = 2
    while (1 - (1 - (percent / 100) ** HALF) ** width) ** 2 < MEET:
        width += 2
    return width


def nibbles(least: np.ndarray) -> np.ndarray:
    """4 bits of every minhash, 16 in a long."""
    bits = (least >> np.uint64(28) & np.uint64(15)).reshape(-1, 16) << np.arange(0, 64, 4, dtype=np.uint64)
    return np.bitwise_or.reduce(bits, axis=1).view(np.int64)


def collections(shingles: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The `width` values of the left collection, then those of the right one, and the 4 bits of their minhashes."""
    least = minhashes(shingles, 2 * width * HALF)
    codes = nibbles(least)
    least = least.reshape(2 * width, HALF)
    values = np.arange(1, 2 * width + 1, dtype=np.uint64)  # values of different places never meet
    for j in range(HALF):
        values = _mix(values, least[:, j])
    return values.view(np.int64), codes


def _differing(x: Column) -> Column:
    """How many of the 16 groups of 4 bits are not 0."""
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def unlike(a: str, b: str, longs: int) -> Column:
    """How many minhashes of two texts differ in their 4 bits. Few longs are written out, which Spark compiles."""
    if longs <= 9:
        return sum((_differing(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(longs)), F.lit(0))
    each = F.zip_with(a, b, lambda x, y: _differing(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


@functools.cache
def most_unlike(n: int, percent: int) -> int:
    """Of n minhashes a pair of the similarity sought differs in a binomial number, one of 15 in 16 of the others. No pair
    that differs in more than this number is looked at. The number is the smallest whose exact binomial tail is at most
    MISSED for pairs that are just similar enough; for more similar ones it is less."""
    rate = (1 - percent / 100) * 15 / 16
    tail, k = 0.0, n
    while k > 0:
        tail += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate))
        if tail > MISSED:
            return k
        k -= 1
    return k


def _sketch(width: int):
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _word_hash.alone()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = shingle_set(text)
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
                out.append((doc_id, len(found), digest, *(collections(found, width) if len(found) else (None, None))))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "set_hash", "cells", "codes"])
        give_back()

    return sketch


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    _word_hash.alone()
    for batch in batches:
        for start in range(0, len(batch), 500):  # sets are as large as their texts
            part = batch.iloc[start : start + 500]
            sets = [shingle_set(text) for text in part["text"]]
            fine = [nibbles(minhashes(s, FINE)) for s in sets]
            yield pd.DataFrame({"id": part["doc_id"], "n": [len(s) for s in sets], "shingles": [s.view(np.int64) for s in sets], "fine": fine})
    give_back()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in links (a, b); component is the smallest node that can be reached.

    Alternates large-star and small-star: each step hangs the neighbours of a node below the smallest of them, with a
    minimum per node and a join, so no neighbourhood is ever collected. Steps are written to the scratch folder.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        sides = both if large else both.filter("b < a")
        least = sides.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        joined = sides.join(least, "a")
        if large:
            return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = save(links.filter("a <> b").select("a", "b").distinct(), "links")
    before = None
    while (now := state(edges)) != before:
        before, last = now, edges
        edges = save(star(star(last, True), False), "stars")
        drop(last)
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * |intersection| >= percent * |union|."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    return pairs.join(left, "a").join(right, "b").filter(similar(percent)).select("a", "b")


def similar(percent: int) -> Column:
    """100 * |intersection| >= percent * |union| of the sets s_a and s_b of n_a and n_b shingles; sizes are looked at first."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & ((100 + percent) * F.size(F.array_intersect("s_a", "s_b")) >= percent * (F.col("n_a") + F.col("n_b")))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text; other columns are not looked at).

    Null and empty texts have n_shingles 0 and are their own component. A null doc_id takes no part: it has a null
    component and is kept. A repeated doc_id is one node; each of its rows gets the component of its own text.
    """
    width = width_for(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = save(docs.mapInPandas(_sketch(width), "doc_id long, n_shingles long, set_hash binary, cells array<long>, codes array<long>"), "sketches")

    # One node for each distinct set. The cells follow from the set, so any row's will do.
    nodes = save(
        sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("node"), F.any_value("n_shingles").alias("n"), F.any_value("cells").alias("cells"), F.any_value("codes").alias("codes")),
        "nodes",
    )

    # Values that two nodes share, then pairs of a left and a right one.
    cells = nodes.select("node", "n", F.posexplode("cells").alias("place", "value"))
    shared = cells.groupBy("value").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("value")
    kept = cells.join(shared, "value").groupBy("node", "n").agg(
        F.collect_list(F.when(F.col("place") < width, F.col("value"))).alias("left"),
        F.collect_list(F.when(F.col("place") >= width, F.col("value"))).alias("right"),
    )
    keys = save(
        kept.select("node", "n", F.explode("left").alias("l"), "right")
        .select("node", "n", "l", F.explode("right").alias("r"))
        .select(F.xxhash64("l", "r").alias("key"), "node", "n"),
        "keys",
    )
    buckets = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    members = save(keys.join(buckets, "key"), "members")
    drop(keys)

    ids = save(members.select(F.col("node").alias("doc_id")).distinct(), "candidates")
    sets = save(docs.join(ids, "doc_id", "left_semi").mapInPandas(_sets, "id long, n int, shingles array<long>, fine array<long>"), "sets")
    drop(ids)

    ends = members.select(F.col("low").alias("a"), F.col("node").alias("b")).union(members.select(F.col("node").alias("a"), F.col("high").alias("b")))
    tried = save(ends.filter("a < b").distinct(), "pairs")
    links = save(confirmed(tried, sets, percent), "confirmed")
    labels = save(components(links), "labels")

    # Members of a bucket that are still apart. A pair meets once for each left value that it shares, and is taken at
    # the smallest of them if it also shares a right value, and if its minhashes agree as those of similar sets do.
    named = members.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    apart = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key")
    rest = named.join(apart, "key").select("node", "component").distinct().join(nodes, "node")
    rest = rest.join(sets.select(F.col("id").alias("node"), "fine"), "node")
    left, right = F.slice("cells", 1, width), F.slice("cells", width + 1, width)
    rest = save(rest.select("node", "n", "component", "codes", "fine", left.alias("left"), right.alias("right")), "apart")
    if not rest.isEmpty():
        a, b = (rest.select(*[F.col(c).alias(f"{c}_{side}") for c in rest.columns], F.explode("left").alias("value")) for side in "ab")
        pairs = (
            a.join(b, "value")
            .filter("node_a < node_b AND component_a <> component_b")
            .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .filter(unlike("codes_a", "codes_b", 2 * width * HALF // 16) <= most_unlike(2 * width * HALF, percent))
            .filter(F.arrays_overlap("right_a", "right_b"))
            .filter(F.col("value") == F.array_min(F.array_intersect("left_a", "left_b")))
            .filter(unlike("fine_a", "fine_b", FINE // 16) <= most_unlike(FINE, percent))
        )
        pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).join(tried, ["a", "b"], "left_anti")
        more = save(confirmed(pairs, sets, percent), "confirmed")
        if not more.isEmpty():
            labels = save(components(links.union(more)), "labels")
    drop(members, sets, tried, rest)

    by_set = nodes.select("set_hash", "node").join(labels, "node", "left").select("set_hash", F.coalesce("component", "node").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        sketches.join(by_set, "set_hash", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )
