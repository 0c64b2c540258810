"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A document's features are the hashed n-grams it has, at 1 + ln of their number. On labelled texts the log ratio of the
shares of toxic and other documents that have a feature is its scale, and a logistic regression, in which both labels
weigh the same, is fitted on the scaled features. The model is fitted on a bounded sample of labelled rows, those with
the smallest hashes of their ids: at most `PER_CLASS` of either label. It is an array of `2**BITS` weights whatever the
corpus, mostly zero, so it is sent to all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atmolake.llm.common import crc_mod

BITS = 20
ORDERS = (4, 6, 8)
PER_CLASS = 3000
MIN_DOCS = 5
MIN_RATIO = 1.5
L2 = 1e-3
STEPS = 200
HELD_OUT_FOLDS = 5


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def grams(text: str | None) -> np.ndarray:
    """Buckets of all n-grams of a text, with repeats. Blanks in a row count as one; the text is set in blanks."""
    if not text:
        return np.empty(0, np.int32)
    codes = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out = []
    for order in ORDERS:
        n = len(codes) - order + 1
        if n < 1:
            break
        acc = np.full(n, order, np.uint32)
        for j in range(order):
            acc = (acc ^ codes[j : j + n]) * np.uint32(0x9E3779B1)
            acc ^= acc >> np.uint32(15)
        out.append((acc >> np.uint32(32 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def features(text: str | None, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, of those with a weight if weights are given, and their values."""
    buckets = grams(text)
    if weights is not None:
        buckets = buckets[weights[buckets] != 0]
    buckets, times = np.unique(buckets, return_counts=True)
    return buckets, 1 + np.log(times)


def fit(texts: list[str | None], toxic: np.ndarray) -> Model:
    """From texts and their labels. With one label alone, or none, every text scores that label, or 0.

    The texts are gone through twice, so that only features that the model uses are held.
    """
    size = 2**BITS
    toxic = np.asarray(toxic, np.float64)
    if not 0 < toxic.sum() < len(toxic):
        return Model(np.zeros(size, np.float32), 10.0 if toxic.sum() else -10.0)
    counts = [np.zeros(size), np.zeros(size)]
    for text, label in zip(texts, toxic):
        counts[int(label)][np.unique(grams(text))] += 1
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    ratio = np.log((counts[1] + 1) / (n1 + 2)) - np.log((counts[0] + 1) / (n0 + 2))
    chosen = np.flatnonzero((counts[0] + counts[1] >= MIN_DOCS) & (np.abs(ratio) >= MIN_RATIO))
    place = np.full(size, -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    scale = ratio[chosen]
    found = [features(text, place + 1) for text in texts]
    rows = np.repeat(np.arange(len(found)), [len(buckets) for buckets, _ in found])
    columns = place[np.concatenate([buckets for buckets, _ in found])]
    values = scale[columns] * np.concatenate([x for _, x in found])
    weights, bias = np.zeros(len(chosen)), 0.0
    share = np.where(toxic > 0, 0.5 / n1, 0.5 / n0)
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, STEPS + 1):  # Adam
        logit = np.bincount(rows, values * weights[columns], len(toxic)) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - toxic) * share
        gradient = np.append(np.bincount(columns, values * error[rows], len(chosen)) + L2 * weights, error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
        weights, bias = weights - move[:-1], bias - move[-1]
    out = np.zeros(size, np.float32)
    out[chosen] = scale * weights
    return Model(out, float(bias))


def score(model: Model, text: str | None) -> float:
    buckets, values = features(text, model.weights)
    logit = float((model.weights[buckets] * values).sum()) + model.bias
    return float(1 / (1 + np.exp(-min(max(logit, -500.0), 500.0))))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on labelled documents outside the held-out fold. docs: doc_id, text. labels: doc_id, toxic; null labels don't count."""
    labels = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(crc_mod("doc_id", HELD_OUT_FOLDS) != 0)
    # An id is one row of the sample, however often it comes; one with both labels has none.
    labels = labels.groupBy(F.col("doc_id").alias("id")).agg(F.min(F.col("toxic").cast("int")).alias("toxic"), F.max(F.col("toxic").cast("int")).alias("most"))
    labels = labels.filter("toxic = most").drop("most")
    chosen = [labels.filter(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(per_class) for k in (0, 1)]

    # The sample is bounded by per_class, so its ids are broadcast and its texts collected, of a repeated id the least one.
    sample = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen[0].union(chosen[1])), "id")
    sample = sample.groupBy("id", "toxic").agg(F.min("text").alias("text"))
    rows = sorted((r["id"], r["toxic"], r["text"]) for r in sample.collect())
    return fit([text for *_, text in rows], np.array([toxic for _, toxic, _ in rows]))


def scored(docs: DataFrame, model: Model, into: str = "toxicity") -> DataFrame:
    """docs with a score between 0 and 1. Null and empty texts get the score of no features; rows are scored one by one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series([score(sent.value, text) for text in texts], dtype="float64")

    return docs.withColumn(into, apply(F.col("text")))
