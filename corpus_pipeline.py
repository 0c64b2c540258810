"""From raw documents to packed training sequences.

Each stage takes the documents that the one before it kept, read from its Parquet output, and works on all of them:
quality rules (documents that fail go, lines of boilerplate are cut out), toxicity (toxic documents go), near-duplicate
removal (one document of each group stays), pseudonyms for personal data, and packing into sequences. All but the
last return the columns of documents; where a stage changes the text, n_chars follows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake.llm import near_dedup, packing, pii, quality, toxicity
from atmolake.llm.common import drop, noted, save, table, unused
from atmolake.sinks import folders

#: Texts of this similarity in percent of five-word shingles are near duplicates; op6 has 85 by its own contract.
DEDUP_PERCENT = 80


#: Tables that a stage has left for its result to be read from; they go when the next stage begins, as that reads the
#: result from where it was written.
_left: list[str] = []


def _remove_left(spark: SparkSession) -> None:
    while _left:
        folders.remove(spark, _left.pop())


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _remove_left(spark)
        with noted() as tables:
            out = function(spark, docs, sf_dir)
        _left.extend(tables)
        return out

    return staged


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of docs, from rows whose text may have changed."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the lines that the rules remove are cut out of the kept ones.

    Lines go by numbers of documents and not by a share of the host, as op5 has it in its SQL.
    """
    into = unused(docs, "_quality")
    judged = quality.judge(docs, save(quality.shared_lines(docs), "shared-lines"), into)
    text = F.col(into)["text"]
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    row = F.struct(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
    # Not a filter: Spark would push it below the steps of judge() and with it compute all of them again and again.
    return judged.select(F.inline(F.when(F.col(into)["kept"], F.array(row))))


@_stage
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go. The classifier learns from the labelled ones among docs."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    into = unused(docs, "_toxicity")
    return toxicity.scored(docs, model, into).filter(F.col(into) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, from a similarity of 0.80 on, the row with the smallest id stays, of equal ids
    that with the smallest hash of its text; so do all rows without an id.

    Each row is judged by its own text: rows that share an id are one only if their texts are linked, or have no words.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = unused(docs, "_row")
    rows = save(docs.withColumn(row, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "numbered")
    found = near_dedup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), DEDUP_PERCENT)
    found = found.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_row"), "component_id", (F.col("n_shingles") == 0).alias("_empty"))
    narrow = rows.filter(F.col(row).isNotNull()).select(F.col(row).alias("_row"), "doc_id", F.xxhash64("text").alias("_text"))
    group = F.struct("_empty", F.when(F.col("_empty"), F.col("doc_id").cast("long")).otherwise(F.col("component_id")).alias("_id"))
    grouped = save(narrow.join(found, "_row").select("_row", "doc_id", "_text", group.alias("_group")), "grouped")
    first = grouped.groupBy("_group").agg(F.min(F.struct("doc_id", "_text", "_row")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    gone = grouped.join(first.filter("_n > 1"), "_group").filter(F.col("_row") != F.col("_first._row")).select(F.col("_row").alias(row))
    return rows.join(save(gone, "near-copies"), row, "left_anti").select(*columns)


@_stage
def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced in all texts."""
    return _with_text(docs, pii.pseudonymize(docs, into=unused(docs, "_pii_found")))


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a sequence."""
    return packing.pack(packing.pieces(docs, packing.byte_bpe_lean, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near-dedup", dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Hashing, learning and tokenizing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        before, docs = docs, save(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        _remove_left(spark)
        if place:
            drop(before)
    return docs
