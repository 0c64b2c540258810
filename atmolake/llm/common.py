"""What the operators share: words, tokenizer files, tables in the shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import weakref
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake.session import scratch_path
from atmolake.sinks import folders

#: The six ASCII characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NO_BLANK = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back, which cuts the lineage.

    Files outlive lost executors. The size of a read table is known, so that Spark broadcasts it below
    spark.sql.autoBroadcastJoinThreshold and shuffles it beyond.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for tables in _noting:
        tables.append(path)
    df.write.parquet(path)
    saved = spark.read.schema(df.schema).parquet(path)
    saved.scratch = path
    return saved


def drop(*saved: DataFrame) -> None:
    """Remove tables of save() that nothing reads any more."""
    for df in saved:
        folders.remove(df.sparkSession, df.scratch)


_noting: list[list[str]] = []


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of all tables that are saved meanwhile."""
    tables: list[str] = []
    _noting.append(tables)
    try:
        yield tables
    finally:
        _noting.remove(tables)


def unused(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of df has, in any case of letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo a number: the folds of training and held-out rows. A null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % divisor


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z in lower case. bytes.lower and bytes.split know ASCII alone, as the contracts do."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Memo(dict):
    """A bounded cache of a pure function of texts. When half of it is new, only what was used since the last time
    stays; long texts are not kept, so the bound is one of memory."""

    #: Those of this process. A worker lives on from stage to stage, so an operator that begins empties those of others.
    _all: list[weakref.ref[Memo]] = []

    def __init__(self, function: Callable, limit: int = 400_000):
        super().__init__()
        self.function, self.half, self.old = function, limit // 2, {}
        Memo._all.append(weakref.ref(self))

    __hash__ = object.__hash__

    def alone(self) -> None:
        """Empty all other caches of the process."""
        for other in [reference() for reference in Memo._all]:
            if other is not None and other is not self:
                other.clear()
                other.old = {}

    def __missing__(self, key):
        if len(key) > 64:
            return self.function(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


def give_back() -> None:
    """Give memory that Arrow holds for later back to the system; a worker that waits for the next stage needs none."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()


#: Characters outside those for which LATIN_PARTS splits as public_tokenizers.PATTERN does.
NOT_LATIN = re.compile("[^\x00-\x1b\x20-\u024f\u2010-\u2027\u20ac]").search
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
LATIN_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+").findall
