"""License scan: TF-IDF cosine of lines to license templates, then inheritance from the nearest licensed directory.

A line is compared with every template by the cosine of TF-IDF vectors of words. The weights of the templates' words
come from the lines of all files; any other word weighs as one that stands in no line. Before a cosine is worked out,
a bound by Cauchy and Schwarz drops lines that cannot reach the threshold: the template's words in the line must hold
its square of the template's norm. A file with a close line has that license by itself. A file that mostly is such
lines is a license file and gives its license to its directory; files without a license of their own inherit from the
nearest ancestor directory that has one. All of it is DataFrame expressions.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atmolake.llm.common import save

#: Names of licenses and the usual short notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
]
THRESHOLD = 0.8
#: Percent of a license file's words that stand in close lines.
FILE_PERCENT = 25

COUNTS = {name: Counter(re.findall("[a-z0-9]+", text.lower())) for name, text in TEMPLATES}
VOCABULARY = sorted(set().union(*COUNTS.values()))


def line_words(line: Column) -> Column:
    """Words of ASCII letters and digits in lower case, with repeats and in order."""
    return F.array_remove(F.split(F.lower(line), "[^a-z0-9]+"), "")


def _lines(files: DataFrame) -> DataFrame:
    lines = files.select("id", F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("line", "content"))
    return lines.select("id", "line", line_words(F.col("content")).alias("words")).filter(F.size("words") > 0)


def inverse_frequencies(files: DataFrame) -> tuple[dict[str, float], float]:
    """ln((1 + lines) / (1 + lines with the word)) + 1 for each word of the templates, and that of a word in no line.

    Counted over all lines of all files; what comes to the driver is one number for each of these words."""
    known = F.array(*map(F.lit, VOCABULARY))
    lines = _lines(files).select(F.array_intersect("words", known).alias("found"))
    counts = lines.select(F.explode(F.concat(F.col("found"), F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = {row["word"]: row["n"] for row in counts.collect()}
    n = found.pop("", 0)
    return {w: math.log((1 + n) / (1 + found.get(w, 0))) + 1 for w in VOCABULARY}, math.log(1 + n) + 1


def notices(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, line, template, score, n_words): lines from 0 on that reach the threshold, with their closest template.

    The score is rounded to 6 digits; equal scores go to the template whose name comes first.
    """
    weight, rare = inverse_frequencies(files)
    vectors = {name: {w: n * weight[w] for w, n in counts.items()} for name, counts in COUNTS.items()}
    norms = {name: math.sqrt(sum(x * x for x in vector.values())) for name, vector in vectors.items()}

    def may_reach(name: str) -> Column:
        held = reduce(Column.__add__, [F.when(F.array_contains("known", w), x * x).otherwise(0.0) for w, x in vectors[name].items()])
        return held >= 0.999999 * (threshold * norms[name]) ** 2

    # A line is met with the words of all templates once; most lines have none or few, and only these are looked for again.
    # Generators, as a filter would be pushed below the words and split the line again for each word of a template.
    lines = _lines(files).withColumn("known", F.array_intersect("words", F.array(*map(F.lit, VOCABULARY))))
    lines = lines.select("id", "line", "words", F.explode(F.when(F.size("known") > 0, F.array("known"))).alias("known"))
    reach = reduce(Column.__or__, [may_reach(name) for name in vectors])
    candidates = lines.select("id", "line", "words", F.explode(F.when(reach, F.array(F.lit(True)))).alias("reach"))
    rows = candidates.select("id", "line", F.size("words").alias("n_words"), F.explode("words").alias("word"))
    rows = rows.groupBy("id", "line", "n_words", "word").agg(F.count(F.lit(1)).alias("times"))
    spark = files.sparkSession
    weights = F.broadcast(spark.createDataFrame(list(weight.items()), "word string, weight double"))
    rows = rows.join(weights, "word", "left").withColumn("x", F.col("times") * F.coalesce("weight", F.lit(rare)))
    lengths = rows.groupBy("id", "line", "n_words").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    entries = [(name, w, x / norms[name]) for name, vector in vectors.items() for w, x in vector.items()]
    entries = F.broadcast(spark.createDataFrame(entries, "template string, word string, y double"))
    dots = rows.join(entries, "word").groupBy("id", "line", "template").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    scores = dots.join(lengths, ["id", "line"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    best = F.min(F.struct((-F.col("score")).alias("minus"), "template"))
    closest = scores.filter(F.col("score") >= threshold).groupBy("id", "line", "n_words").agg(best.alias("best"))
    return closest.select("id", "line", F.col("best.template").alias("template"), (-F.col("best.minus")).alias("score"), "n_words")


def folder(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, path, own_license, score, notice_line, license, inherited_from) for each row of files (id, path, text).

    own_license is that of the closest line, of equal ones the first. license is it, or what is inherited; null if there
    is none. inherited_from is the directory. Null texts have no lines, a null path lies in the directory ''. Of several
    license files in a directory the most frequent license counts, of equal ones the first by name. A null id is an id
    like others; rows that repeat an id are files of their own by their paths and texts, and equal rows come out alike.
    """
    files = files.select("id", F.coalesce("path", F.lit("")).alias("path"), "text")
    files = files.withColumn("key", F.to_json(F.struct("id", "path", F.xxhash64("text").alias("text"))))
    found = save(notices(files.select(F.col("key").alias("id"), "text"), threshold), "notices")
    by_file = found.groupBy("id").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "line", "template")).alias("best"), F.sum("n_words").alias("notice_words")
    )
    n_words = F.size(line_words(F.coalesce(F.col("text"), F.lit(""))))
    narrow = files.select("id", "key", "path", folder(F.col("path")).alias("folder"), n_words.alias("n_words"))
    own = narrow.join(by_file.withColumnRenamed("id", "key"), "key", "left")
    own = save(own.select("id", "path", "folder", "n_words", "notice_words", "best"), "files")

    license_files = own.filter(100 * F.col("notice_words") >= FILE_PERCENT * F.col("n_words"))
    counts = license_files.groupBy("folder", F.col("best.template").alias("template")).agg(F.count(F.lit(1)).alias("n"))
    given = counts.groupBy("folder").agg(F.min(F.struct((-F.col("n")).alias("minus"), "template")).alias("pick"))
    given = given.select(F.col("folder").alias("ancestor"), F.col("pick.template").alias("given"))

    # Each directory meets its ancestors once, however many files it has.
    parts = F.split("folder", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("ancestor")))
    folders = own.select("folder").distinct().select("folder", F.inline(ancestors))
    nearest = folders.join(given, "ancestor").groupBy("folder").agg(F.max(F.struct("depth", "ancestor", "given")).alias("nearest"))

    inherits = F.col("best").isNull() & F.col("nearest").isNotNull()
    return own.join(nearest, "folder", "left").select(
        "id",
        "path",
        F.col("best.template").alias("own_license"),
        (-F.col("best.minus")).alias("score"),
        F.col("best.line").alias("notice_line"),
        F.coalesce("best.template", "nearest.given").alias("license"),
        F.when(inherits, F.col("nearest.ancestor")).alias("inherited_from"),
    )
