"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake.llm import ann, bpe, decontaminate, licenses, lm, near_dedup, packing, pii, quality, runs, sharding, toxicity, whitening
from atmolake.llm.common import table
from atmolake.llm.registry import ORACLES, QUERIES, query
from atmolake.llm.sql import DECONTAMINATION_SQL, QUALITY_SQL, SHARDING_SQL, license_sql

__all__ = ["ORACLES", "QUERIES"]


@query()
def op1_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query(SHARDING_SQL)
def op2_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assigned(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query()
def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query(license_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a directory for each source and language."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return licenses.scan(docs.select(F.col("doc_id").alias("id"), path.alias("path"), "text")).withColumnRenamed("id", "doc_id")


@query(QUALITY_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_removed_lines n_removed_words".split()
    return judged.select("doc_id", *[F.col("quality")[name].alias(name) for name in names])


@query()
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, packing.byte_bpe, public_tokenizers.path("byte_bpe_50k.json")))


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", "pii.*")


@query()
def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=False)


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = toxicity.scored(docs, toxicity.train(docs, labels), into="score")
    held_out = toxicity.crc_mod("doc_id", toxicity.HELD_OUT_FOLDS) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query(DECONTAMINATION_SQL)
def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items).drop("spans")


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.detected(table(spark, sf_dir, "documents"), alter=True, with_text=False)
