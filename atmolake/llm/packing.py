"""Packing of tokenized documents into sequences by minimum bin slack.

A document is cut into full sequences, which need no partner, and one remaining piece shorter than a sequence. The
remaining pieces of all documents are counted by length, so the packing problem has at most `capacity - 1` numbers
whatever the corpus. For one window after the other, dynamic programming over subset sums, held as bits of an integer,
finds the multiset of remaining lengths that fills it closest to capacity; it begins with the longest length left.
A multiset is repeated for as many windows as the counts allow and so uses one of its lengths up: the plan has about as
many rows as there are lengths, and assigning pieces to it is a join on (length, rank). What no window can take whole
is never forced: slack stays as padding.
"""

from __future__ import annotations

import functools
import json
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atmolake.llm.common import LATIN_PARTS, NOT_LATIN, Memo, crc32, give_back, save

CAPACITY = 1024


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, within counts and with the longest one in it, whose sum is closest to capacity.

    Bit s of `reach[i]` tells that s is a sum of the first i lengths. A count is split into powers of two, so each
    length takes a few shifts. Going back from the best sum gives how often each length is used.
    """
    lengths = sorted(counts, reverse=True)
    first = lengths[0]
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    items = []
    for length in lengths:
        left = min(counts[length] - (length == first), room // length)
        step = 1
        while left > 0:
            take = min(step, left)
            items.append((length, take))
            left, step = left - take, step * 2
    reach = [1]
    for length, take in items:
        reach.append((reach[-1] | reach[-1] << (length * take)) & mask)
        if reach[-1] >> room & 1:
            break
    best = reach[-1].bit_length() - 1
    used = {first: 1}
    for i in range(len(reach) - 1, 0, -1):
        length, take = items[i - 1]
        if not reach[i - 1] >> best & 1:
            best -= length * take
            used[length] = used.get(length, 0) + take
    return used


@dataclass
class Pattern:
    """`times` sequences beginning with sequence `start`; each holds counts of lengths, the longest first."""

    start: int
    times: int
    counts: dict[int, int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    counts = {length: n for length, n in counts.items() if n > 0}
    patterns, start = [], 0
    while counts:
        used = fill(counts, capacity)
        times = min(counts[length] // n for length, n in used.items())
        patterns.append(Pattern(start, times, dict(sorted(used.items(), reverse=True))))
        start += times
        for length, n in used.items():
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
    return patterns


def slots(patterns: list[Pattern]) -> pd.DataFrame:
    """One row for each length in each pattern: the pieces of that length with a rank not below `first` and below
    `upto` stand, `each` of them to a sequence, from offset `at` on in the sequences from `sequence` on."""
    rows, next_rank = [], {}
    for pattern in patterns:
        offset = 0
        for length, n in pattern.counts.items():
            rank = next_rank.get(length, 0)
            next_rank[length] = rank + n * pattern.times
            rows.append((length, rank, rank + n * pattern.times, n, offset, pattern.start))
            offset += length * n
    return pd.DataFrame(rows, columns=["length", "first", "upto", "each", "at", "sequence"]).astype("int64")


def pieces(docs: DataFrame, encode: Callable[[str], Callable[[str], bytes]], path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens. docs: doc_id, text; a null text is empty.

    encode(path) is called once per task and gives the function from a text to its ids as little-endian 32-bit integers.
    Every document ends with the id 0, so each has a piece.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to_ids = encode(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                data = (to_ids(text) if text else b"") + b"\0\0\0\0"
                n = len(data) // 4
                for start in range(0, n, capacity):
                    part = data[4 * start : 4 * (start + capacity)]
                    out.append((doc_id, start, len(part) // 4, crc32(part), n))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        give_back()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInPandas(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def ranked(parts: DataFrame, keys: list[str]) -> DataFrame:
    """parts with `rank`: a number from 0 without gaps within keys, in no given order.

    Rows are numbered inside small cells of a key (by a hash of the row), whose sizes are summed up for the cells
    before them; so a key that most rows share is split over many tasks. Equal rows get different numbers, and
    which of them gets which makes no difference.
    """
    parts = parts.withColumn("_cell", F.pmod(F.xxhash64(*parts.columns), F.lit(256)))
    sizes = parts.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_cell")) - F.col("_n")
    sizes = sizes.select(*keys, "_cell", before.alias("_before"))
    inner = F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy(*[c for c in parts.columns if c not in (*keys, "_cell")]))
    numbered = parts.withColumn("_inner", inner)
    return numbered.join(sizes, [*keys, "_cell"]).withColumn("rank", F.col("_before") + F.col("_inner") - 1).drop("_cell", "_inner", "_before")


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """parts with sequence_id and offset. Pieces of full length are sequences by themselves; equal rows are pieces of their own.

    An empty table gives an empty one. sequence_id runs from 0 without gaps over full sequences, then packed ones.
    """
    parts = save(parts, "pieces")
    spark = parts.sparkSession
    sizes = {row["length"]: row["n"] for row in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    n_full = sizes.pop(capacity, 0)
    full = ranked(parts.filter(F.col("length") == capacity), ["length"])
    full = full.select(*parts.columns, F.col("rank").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not sizes:
        return full
    rest = ranked(parts.filter(F.col("length") < capacity), ["length"])
    # About as many patterns as there are lengths, with few lengths each: a table of a size bound by the capacity.
    table = F.broadcast(spark.createDataFrame(slots(plan(sizes, capacity))))
    within = F.col("rank") - F.col("first")
    packed = rest.join(table, "length").filter("rank >= first AND rank < upto")
    return full.union(
        packed.select(
            *parts.columns,
            (n_full + F.col("sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("at") + F.pmod(within, F.col("each")) * F.col("length")).cast("long").alias("offset"),
        )
    )


class ByteBpe:
    """Ids of a byte-level BPE file of the tokenizers library; texts of special tokens are ordinary texts.

    The library splits a text before its merges; a part's ids depend on the part alone and are kept in a bounded
    cache. Texts with characters for which tables of letters may differ go to the library whole. A part that is not in
    the cache is merged by the same ranks in tiktoken, which costs a third of a call of the library; a file for which
    the two are not sure to be the same (see `_merger`) has all its parts merged by the library.
    """

    def __init__(self, path: str, kept: int):
        self.tokenizer, self.merger = _tokenizer(path)
        self.known = Memo(self._direct if self.merger is None else self._merged, kept)

    def _direct(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merged(self, part: str) -> bytes:
        ids = self.merger.encode_ordinary(part)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        return self._direct(text) if NOT_LATIN(text) else b"".join(map(self.known.__getitem__, LATIN_PARTS(text)))


def _merger(model: dict, tokenizer):
    """The merges of a file as tiktoken's ranks, or None if their ids could differ from the library's.

    The library joins listed pairs only, tiktoken all neighbours that make a token, each the lowest rank first and the
    leftmost of equal ones. They are the same if ids rise with the merges and every token is, as a text, that one token:
    neighbours that make a token have come there by merges within it, so they are its listed pair.
    """
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    # The stand-in characters of the 256 bytes, in the order of the library's: those that print, then the others.
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    joined = [vocab.get(a + b) for a, b in merges]
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    tokens = {*byte_of, *(a + b for a, b in merges)}
    if not plain or set(byte_of) != set(ByteLevel.alphabet()) or None in joined or joined != sorted(set(joined)) or tokens != set(vocab):
        return None
    if any([token.id for token in tokenizer.model.tokenize(text)] != [i] for text, i in vocab.items()):
        return None
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("merges", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    with open(path, encoding="utf-8") as file:
        return tokenizer, _merger(json.load(file)["model"], tokenizer)


@functools.lru_cache(2)
def _kept(path: str) -> ByteBpe:
    return ByteBpe(path, 700_000)


def byte_bpe(path: str) -> ByteBpe:
    """The encoder of this process, with a large cache that is kept from task to task."""
    encoder = _kept(path)
    encoder.known.alone()
    return encoder


def byte_bpe_lean(path: str) -> ByteBpe:
    """An encoder with a small cache of its own, for tasks that share their memory with those of other stages."""
    encoder = ByteBpe(path, 300_000)
    encoder.known.alone()
    return encoder
