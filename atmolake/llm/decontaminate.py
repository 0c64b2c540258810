"""Benchmark passages in documents, found by winnowing.

A window is `length` consecutive words of an item; an item of fewer words is one window. Of every window, on either
side, the rightmost smallest hash of its runs of k words is a fingerprint, so two texts that share a window share a
fingerprint inside it: no shared window is missed. Documents' fingerprints meet those of the items in a join; what meets
is extended to the windows around it, and these are compared word by word.

Texts move only in the stretches around fingerprints. Tasks leave out fingerprints that are not in a bitmap of those of
all items; it has 16 MiB at most, however many items there are, and what it lets through wrongly goes in the join.
Windows are distinct and stand for their set of items, so a passage of many items and many documents never makes a row
for each pair; documents with the same sets share one digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atmolake.llm.common import Memo, save

LENGTH = 10
#: Bits of the bitmap for each fingerprint of the items, and bits at most (16 MiB).
BITS_EACH, MAX_BITS = 256, 1 << 27
#: Words that a task works on at a time; a longer text is worked on alone.
SLAB_WORDS = 1 << 17

_TABLE = bytes(c | 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(data: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z in lower case, parted by ASCII characters that are neither letters nor digits."""
    return data.translate(_TABLE).split() if data else []


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def _hasher() -> Memo:
    import xxhash

    return Memo(lambda word: xxhash.xxh64_intdigest(word))


def winnowed(hashes: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints for windows of `length` words.

    hashes has one hash for each word, text the number of its text; windows do not reach over the end of a text. Of k
    words (half of a window, rounded up) the hash is one number; each window keeps the rightmost smallest of them.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    k = (length + 1) // 2
    grams = np.full(len(hashes) - k + 1, length, np.uint64)
    for j in range(k):
        grams = grams * _ODD + hashes[j : len(hashes) - k + 1 + j]
    grams = _mixed(grams)
    least, place = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, length - k + 1):
        beside = grams[j : n + j]
        smaller = beside <= least
        least[smaller], place[smaller] = beside[smaller], j
    inside = np.flatnonzero(text[:n] == text[length - 1 :])
    places = np.unique(inside + place[inside])
    return places, grams[places]


def _windows(words: list[bytes], length: int) -> list[bytes]:
    return [b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)]


def _items(items: DataFrame, length: int) -> DataFrame:
    """item, length, windows and fps of every item with words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hasher()
        for batch in batches:
            out = {"item": [], "length": [], "windows": [], "fps": []}
            for item, data in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(data)
                if not words:
                    continue
                n = min(length, len(words))
                _, fps = winnowed(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), np.zeros(len(words), np.int8), n)
                for name, value in zip(out, (item, n, sorted({w.decode() for w in _windows(words, n)}), np.unique(fps).view(np.int64))):
                    out[name].append(value)
            types = {"item": pa.string(), "length": pa.int32(), "windows": pa.list_(pa.string()), "fps": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([pa.array(out[name], kind) for name, kind in types.items()], names=list(types))

    items = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").cast("binary").alias("text"))
    return save(items.mapInArrow(cut, "item string, length int, windows array<string>, fps array<bigint>"), "items")


def _bitmap(fps: DataFrame) -> np.ndarray:
    """The lowest bits of all fingerprints as a set of bits, put together by Spark in words of 32 bits."""
    size = 1 << 16
    n = fps.count()
    while size < MAX_BITS and size < BITS_EACH * n:
        size *= 2
    low = fps.select(F.col("fp").bitwiseAND(F.lit(size - 1)).alias("low"))
    bits = low.groupBy(F.shiftright("low", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(low & 31 AS INT))")).alias("bits"))
    out = np.zeros(size // 32, np.uint32)
    found = bits.toArrow()
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out


def _documents(docs: DataFrame, lengths: list[int], bitmap) -> DataFrame:
    """row, doc_id, n_words and near: the fingerprints that the bitmap has, each with the words of the windows around it."""

    kinds = {"fp": pa.int64(), "length": pa.int32(), "first": pa.int64(), "words": pa.string()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = _hasher(), bitmap.value
        last = np.uint64(len(bits) * 32 - 1)

        def near(texts: list[list[bytes]]) -> list[list[dict]]:
            found = [[] for _ in texts]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            values = np.fromiter((h for words in texts for h in map(hashes.__getitem__, words)), np.uint64, int(sizes.sum()))
            text, ends = np.repeat(np.arange(len(texts), dtype=np.int32), sizes), np.cumsum(sizes)
            for length in lengths:
                places, fps = winnowed(values, text, length)
                low = fps & last
                known = (bits[low >> np.uint64(5)] >> (low & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1
                k = (length + 1) // 2
                for place, fp in zip(places[known].tolist(), fps[known].view(np.int64).tolist()):
                    t = int(text[place])
                    i = place - int(ends[t] - sizes[t])
                    first = max(0, i + k - length)
                    words = texts[t][first : i + length]
                    found[t].append({"fp": fp, "length": length, "first": first, "words": b" ".join(words).decode()})
            return found

        for batch in batches:
            texts, counts, rows, held = [], [], [], 0
            for data in batch["text"]:
                texts.append(words_of(data.as_py()))
                counts.append(len(texts[-1]))
                held += counts[-1]
                if held >= SLAB_WORDS:
                    rows += near(texts)
                    texts, held = [], 0
            rows += near(texts)
            arrays = [batch["row"], batch["doc_id"], pa.array(counts, pa.int64()), pa.array(rows, pa.list_(pa.struct(kinds)))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_words", "near"])

    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = "row bigint, doc_id bigint, n_words bigint, near array<struct<fp: bigint, length: int, first: bigint, words: string>>"
    return save(docs.mapInArrow(cut, schema), "winnowed")


def contaminated(docs: DataFrame, items: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and spans for every row of docs (doc_id, text).

    items has item_id and text. A word is hit if it lies inside an occurrence of a window; spans are the stretches of
    hit words as (start, length). n_items counts the distinct ids of items that have an occurring window, items_sha256
    is the digest of these ids as strings, sorted and comma-joined. Null, empty and wordless texts have no words, no
    spans and the digest of nothing; as items they have no windows. A null item_id counts as one item whose id is ''.
    Repeated rows are judged each for itself; repeated item ids are one item with the windows of all its texts. Other
    columns take no part, whatever their names. An empty table of items hits nothing.
    """
    spark = docs.sparkSession
    cut = _items(items.select("item_id", "text"), length)
    lengths = sorted(row["length"] for row in cut.select("length").distinct().collect())
    fps = save(cut.select(F.explode("fps").alias("fp")).distinct(), "fingerprints")
    bitmap = spark.sparkContext.broadcast(_bitmap(fps))
    rows = _documents(docs, lengths, bitmap)

    # Windows, each with a name for the set of its items: their number and two sums of hashes.
    item = F.coalesce("item", F.lit(""))
    pairs = save(cut.select(F.explode("windows").alias("window"), item.alias("item")).distinct(), "windows")
    name = F.concat_ws(".", F.count(F.lit(1)), F.hex(F.bit_xor(F.xxhash64("item"))), F.hex(F.bit_xor(F.xxhash64(F.lit(1), "item"))))
    windows = save(pairs.groupBy("window").agg(name.alias("set")), "window-sets")
    members = windows.groupBy("set").agg(F.min("window").alias("window")).join(pairs, "window").select("set", "item")

    # Fingerprints that meet, and the windows around them.
    near = rows.select("row", F.inline("near")).join(fps, "fp", "left_semi")
    words = F.split("words", " ")
    each = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    window = lambda i: F.array_join(F.slice("words", i + 1, F.col("length")), " ")
    around = F.transform(each, lambda i: F.struct((F.col("first") + i).alias("start"), window(i).alias("window")))
    around = near.withColumn("words", words).select("row", "length", F.inline(around)).distinct()
    hits = save(around.join(windows, "window").select("row", "start", (F.col("start") + F.col("length")).alias("end"), "set"), "hits")

    # Stretches of hit words: one begins where no window before it reaches.
    before = Window.partitionBy("row").orderBy("start", "end")
    places = hits.select("row", "start", "end").distinct()
    places = places.withColumn("reach", F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1)))
    begins = F.when(F.col("reach") >= F.col("start"), 0).otherwise(1)
    places = places.withColumn("span", F.sum(begins).over(before))
    stretches = places.groupBy("row", "span").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    spans = stretches.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"), F.sum("length").alias("n_hit")
    )

    # Documents with the same sets of items are one class, which has one digest.
    sets = hits.groupBy("row").agg(F.sort_array(F.collect_set("set")).alias("sets"))
    sets = save(sets.withColumn("class", F.sha2(F.array_join("sets", ","), 256)), "classes")
    classes = sets.groupBy("class").agg(F.first("sets").alias("sets")).select("class", F.explode("sets").alias("set"))
    ids = classes.join(members, "set").select("class", "item").distinct().groupBy("class").agg(
        F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256")
    )
    found = spans.join(sets.select("row", "class").join(ids, "class"), "row").select("row", "n_hit", "n_items", "items_sha256", "spans")
    return (
        rows.select("row", "doc_id", "n_words")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
            F.coalesce("spans", F.array().cast("array<struct<start:bigint,length:bigint>>")).alias("spans"),
        )
    )
