"""Quality rules over whole texts and over the lines that many documents of a host share.

All of it is DataFrame expressions. `frequent_lines` hashes the normalised lines of all documents and counts, for
each host, in how many distinct documents a line stands; exact copies of one text are one document. `judge` then
removes such lines, but from the document with the smallest id, so that a text never goes with all its copies, and
rejects documents that are short, repetitive or depleted by the removal. `shared_lines`, which the pipeline takes
instead, has limits that do not grow with a host, and counts long lines across hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.llm.common import BLANK_RUN, BLANKS, NO_BLANK, save
from atmolake.operators.lookups import broadcast_if_small

#: A line goes if more documents of its host have it than both of these.
MIN_DOCS, MIN_SHARE = 20, 0.05
#: Without a share: a line goes if more documents of its host have it than MIN_DOCS; a line of more words than LONG_WORDS,
#: if more documents of any host have it than MIN_DOCS_LONG.
LONG_WORDS, MIN_DOCS_LONG = 50, 5
#: Rules on a single document.
MIN_WORDS, MAX_REPEAT_PERCENT, MAX_REMOVED_PERCENT = 50, 50, 50


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _host() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def line_hash(line: Column) -> Column:
    """Hash of the line in lower case, digits as 0, blanks in a row as one."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, "[0-9]", "0")), BLANK_RUN, F.lit(" "))))


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """One row for each host that has them: host, lines (hashes) and owners (smallest doc_id that has the line).

    docs has doc_id, text and source. A null text has no lines, a null source is the host ''. The distinct count
    combines by (host, line, document) before it shuffles, so a line of a hot host has no task of its own. A host's
    list is bounded: its lines each stand in a min_share of its documents, so there are at most 1/min_share times
    as many as a document has on average.
    """
    lines = docs.select(
        _host().alias("host"),
        "doc_id",
        F.xxhash64(_text()).alias("document"),
        F.explode(F.array_distinct(F.transform(F.split(_text(), "\n"), line_hash))).alias("line"),
    ).filter(F.col("line") != F.xxhash64(F.lit("")))
    counts = (
        lines.groupBy("host", "line")
        .agg(F.count_distinct("document").alias("n"), F.min("doc_id").alias("owner"))
        .filter(F.col("n") > min_docs)
    )
    hosts = docs.groupBy(_host().alias("host")).agg(F.count_distinct(F.xxhash64(_text())).alias("host_docs"))
    return (
        counts.join(hosts, "host")
        .filter(F.col("n") > F.col("host_docs") * min_share)
        .groupBy("host")
        .agg(F.collect_list(F.struct("line", "owner")).alias("frequent"))
        .select("host", F.col("frequent.line").alias("lines"), F.col("frequent.owner").alias("owners"))
    )


def shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_docs_long: int = MIN_DOCS_LONG) -> DataFrame:
    """One row for each text of a host that has them: host, document (hash of the text), lines (hashes) and owners.

    The limits are numbers of distinct documents at any size of a host. Lines meet their counts in a join, so no list
    is longer than the lines of a text. Copies are one row before they shuffle; a hot line has one row for each text.
    """
    each = lambda s: F.struct(line_hash(s).alias("line"), (F.regexp_count(s, F.lit(NO_BLANK + "+")) > LONG_WORDS).alias("long"))
    lines = docs.select(_host().alias("host"), "doc_id", F.xxhash64(_text()).alias("document"), F.inline(F.transform(F.split(_text(), "\n"), each)))
    lines = lines.filter(F.col("line") != F.xxhash64(F.lit(""))).groupBy("host", "document", "line", "long").agg(F.min("doc_id").alias("doc_id"))
    place = F.when(F.col("long"), F.xxhash64("line")).otherwise(F.xxhash64("line", "host"))
    lines = save(lines.withColumn("place", place), "lines")
    counts = lines.groupBy("place", "long").agg(F.count_distinct("document").alias("n"), F.min("doc_id").alias("owner"))
    counts = counts.filter(F.col("n") > F.when(F.col("long"), min_docs_long).otherwise(min_docs)).select("place", "owner")
    found = lines.join(counts, "place").groupBy("host", "document").agg(F.collect_list(F.struct("line", "owner")).alias("shared"))
    return found.select("host", "document", F.col("shared.line").alias("lines"), F.col("shared.owner").alias("owners"))


def judge(docs: DataFrame, frequent: DataFrame, into: str = "quality") -> DataFrame:
    """All rows and columns of docs, and a struct column of the name `into`. frequent is of frequent_lines or shared_lines.

    Its fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_lines, n_removed_words, text
    (without the removed lines), base_failed, depleted and kept. Null and empty texts have no words, so they are
    base_failed. Repeated rows are judged alike; a null doc_id owns no line. Columns of docs may have any names but
    those beginning with `_q_`.
    """
    # Few texts have shared lines, so their lists are small for long; while they are, the texts stay where they are.
    lines = broadcast_if_small(frequent.select(*[F.col(c).alias(f"_q_{c}") for c in frequent.columns]))
    on = F.col("_q_host") == _host()
    if "document" in frequent.columns:
        on &= F.col("_q_document") == F.xxhash64(_text())
    trimmed = F.trim(_text(), F.lit(BLANKS))
    df = docs.join(lines, on, "left")
    df = df.withColumns(
        {
            "_q_words": F.when(trimmed != "", F.split(trimmed, BLANK_RUN)).otherwise(F.array().cast("array<string>")),
            "_q_split": F.split(_text(), "\n"),
        }
    )

    # Hashes of the 3-word windows; only documents with a repeated one go on to sort them.
    n = F.size("_q_words")
    window = lambda w, i: F.xxhash64(w, F.get("_q_words", i + 1), F.get("_q_words", i + 2))
    df = df.withColumn("_q_windows", F.slice(F.transform("_q_words", window), F.lit(1), F.greatest(n - 2, F.lit(0))))
    repeats = F.size(F.array_distinct("_q_windows")) < F.size("_q_windows")
    places = F.sort_array(F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_q_places", F.when(repeats, places))
    beside = lambda x, j: F.coalesce(F.get("_q_places", j)["h"] == x["h"], F.lit(False))
    twice = F.filter("_q_places", lambda x, j: beside(x, j - 1) | beside(x, j + 1))
    df = df.withColumn("_q_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.transform("_q_starts", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("_q_starts", j + 1) - i, F.lit(3))))

    # A line goes if the host's list has it and another document owns it.
    none = F.array().cast("array<string>")
    df = df.withColumn("_q_hashes", F.when(F.col("_q_lines").isNotNull(), F.transform("_q_split", line_hash)))
    owner = lambda i: F.get("_q_owners", F.array_position("_q_lines", F.get("_q_hashes", i)).cast("int") - 1)
    goes = lambda line, i: F.coalesce(owner(i).isNotNull() & ~owner(i).eqNullSafe(F.col("doc_id")), F.lit(False))
    df = df.withColumn("_q_gone", F.when(F.col("_q_lines").isNull(), none).otherwise(F.filter("_q_split", goes)))
    gone = F.size("_q_gone")
    n_gone_words = F.aggregate("_q_gone", F.lit(0), lambda total, s: total + F.regexp_count(s, F.lit(NO_BLANK + "+")))
    stay = F.filter("_q_split", lambda s: ~F.array_contains("_q_gone", s))
    df = df.withColumn("_q_with_word", F.filter("_q_split", lambda s: s.rlike(NO_BLANK)))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_q_words", "")),
        "n_symbols": F.regexp_count(_text(), F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("_q_with_word") - F.size(F.array_distinct("_q_with_word")),
        "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)),
        "n_removed_lines": gone,
        "n_removed_words": n_gone_words,
    }
    df = df.withColumn("_q_counts", F.struct(*[c.cast("long").alias(k) for k, c in counts.items()]))
    q = F.col("_q_counts")
    failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    depleted = 100 * q["n_removed_words"] > MAX_REMOVED_PERCENT * q["n_words"]
    clean = F.when(q["n_removed_lines"] == 0, F.col("text")).otherwise(F.array_join(stay, "\n"))
    quality = (
        q.withField("text", clean).withField("base_failed", failed).withField("depleted", depleted).withField("kept", ~failed & ~depleted)
    )
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], quality.alias(into))


def quality_rules(docs: DataFrame) -> DataFrame:
    """judge() with the frequent lines of docs itself; these are written once to the shared scratch folder."""
    return judge(docs, save(frequent_lines(docs), "frequent-lines"))
