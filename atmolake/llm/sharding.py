"""Sharding by extendible hashing.

A document's hash is a string of bits, and a shard is all documents that begin with the shard's bits. All begin in one
shard; only shards over the byte limit are split, on one more bit, until each fits. The directory is worked out from
sums over hash prefixes, `STEP` bits at a time: a document's shard is its shortest prefix whose documents fit, and the
prefixes that are still too large after a step go on to the next one. Each step works on sums, which are combined
before they are shuffled; texts are not moved to find shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.llm.common import save

STEP, BITS = 12, 60
LIMIT = 1 << 20


def document_hash() -> Column:
    """60 bits of the MD5 of id and text, so that a repeated id does not keep different texts together."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def document_bytes() -> Column:
    return F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")


def prefix(value: Column, depth: int) -> Column:
    """The first bits of a hash, as a number."""
    return F.shiftright(value, BITS - depth)


def directory(docs: DataFrame, limit: int = LIMIT) -> list[tuple[int, DataFrame]]:
    """For each step its number of bits and a table: cell (that many first bits of a hash), shard_prefix, shard_depth,
    shard_bytes, shard_docs. Each document is in one cell of one of the tables.

    The table of the first step has at most 2**STEP rows. Only one long document, or rows that repeat a document, make
    a shard over the limit; such a shard is split off from all others and no further.
    """
    hashes = docs.select(document_hash().alias("hash"), document_bytes().alias("bytes"))
    hashes = hashes.groupBy("hash").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
    hashes = save(hashes, "hashes")
    found = []
    for top in range(0, BITS, STEP):
        bottom = top + STEP
        cells = hashes.groupBy(prefix(F.col("hash"), bottom).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("hashes")
        )
        cells = save(cells, "cells")
        depths = range(top + 1 if top else 0, bottom + 1)
        levels = [
            cells.groupBy(F.shiftright("cell", bottom - depth).alias("shard_prefix"))
            .agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"), F.sum("hashes").alias("hashes"))
            .withColumn("shard_depth", F.lit(depth))
            for depth in depths
        ]
        sums = save(reduce(DataFrame.union, levels), "prefixes")
        fits = sums.filter((F.col("shard_bytes") <= limit) | (F.col("hashes") == 1))
        # What is below a prefix that fits, fits too. Shards are those whose parent does not.
        parents = fits.select((F.col("shard_depth") + 1).alias("d"), F.col("shard_prefix").alias("p"))
        child = (F.col("shard_depth") == F.col("d")) & (F.shiftright("shard_prefix", 1) == F.col("p"))
        shards = fits.join(parents, child, "left_anti").drop("hashes")
        ways = cells.select("cell", F.explode(F.array(*map(F.lit, depths))).alias("shard_depth"))
        ways = ways.withColumn("shard_prefix", F.expr(f"shiftright(cell, {bottom} - shard_depth)"))
        found.append((bottom, save(ways.join(shards, ["shard_depth", "shard_prefix"]), "directory")))
        large = sums.filter((F.col("shard_depth") == bottom) & (F.col("shard_bytes") > limit) & (F.col("hashes") > 1))
        large = large.select(F.col("shard_prefix").alias("cell"))
        hashes = save(hashes.withColumn("cell", prefix(F.col("hash"), bottom)).join(large, "cell", "left_semi").drop("cell"), "unsplit")
        if hashes.isEmpty():
            break
    return found


def assigned(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """docs (with doc_id and text) and the columns shard (bits as text), shard_depth, shard_bytes, shard_docs, doc_bytes.

    Null texts have 0 bytes, null ids count as ''. Rows that repeat a document are in the same shard. The first table of
    the directory is broadcast, as it cannot grow; later ones are joined as their size allows.
    """
    out = docs.withColumns({"_s_hash": document_hash(), "_s_bytes": document_bytes()})
    names = ["shard_prefix", "shard_depth", "shard_bytes", "shard_docs"]
    steps = directory(docs, limit)
    for n, (bits, table) in enumerate(steps):
        table = table.select(F.col("cell").alias(f"_s_cell{n}"), *[F.col(c).alias(f"_s_{c}{n}") for c in names])
        out = out.join(F.broadcast(table) if n == 0 else table, prefix(F.col("_s_hash"), bits) == F.col(f"_s_cell{n}"), "left")
    pick = {c: F.coalesce(*[F.col(f"_s_{c}{n}") for n in range(len(steps))]) for c in names}
    bits = F.when(pick["shard_depth"] == 0, "").otherwise(F.lpad(F.bin(pick["shard_prefix"]), pick["shard_depth"], F.lit("0")))
    shard = [bits.alias("shard"), *[pick[c].alias(c) for c in names[1:]], F.col("_s_bytes").alias("doc_bytes")]
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *shard)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """A folder for each shard. Rows of a shard come together in one task, which its limit bounds."""
    assigned(docs, limit).repartition("shard").write.partitionBy("shard").parquet(path)
