"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of words with smallest period q and a length of at least 4 q and 6 that no neighbouring word extends.
Re-Pair replaces the most frequent pairs of symbols by new ones until no pair occurs twice. A run lies across the middle
of exactly one lowest node of the derivation, so what crosses the middle of each nonterminal is computed once, at its
first place, and moved to all places that the nonterminal derives. There it may be a part of a longer run, which a higher
node has: intervals of one period that share a period of words are merged.

Three occurrences of every three-word window are needed in a run, so words without one are cut away before; that is exact
and leaves little of ordinary prose. Rows are worked on where they are, many texts at a time; nothing is shuffled.
"""

from __future__ import annotations

import collections
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atmolake.llm.common import crc32

MIN_LENGTH, MIN_PERIODS = 6, 4
#: Words that a task works on at a time; a longer text is worked on alone.
SLAB_WORDS = 1 << 17
#: Pairs of a node and a period that are tested at a time.
SLAB_TESTS = 1 << 21
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h.astype(np.uint64) * _ODD
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def pruned(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that may lie in a run, and for each the number of its stretch of such words.

    Every three-word window of a run occurs three times in it. Windows are told apart by hashes; equal hashes of other
    windows only keep more.
    """
    places, part = np.arange(len(ids)), text
    for _ in range(12):
        if len(places) < MIN_LENGTH:
            return places[:0], part[:0]
        w = ids[places]
        inside = np.flatnonzero(part[:-2] == part[2:])
        h = _mixed(_mixed(_mixed(_mixed(w[:-2]) + w[1:-1].astype(np.uint64)) + w[2:].astype(np.uint64)) + part[:-2].astype(np.uint64))[inside]
        _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        first = inside[counts[inverse] >= 3]
        keep = np.zeros(len(places), bool)
        for j in range(3):
            keep[first + j] = True
        # Stretches of kept words that were neighbours; short ones go.
        kept = np.flatnonzero(keep)
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) > 1) | (np.diff(part[kept]) != 0)
        stretch = np.cumsum(new) - 1
        long = np.bincount(stretch, minlength=1)[stretch] >= MIN_LENGTH if len(kept) else np.zeros(0, bool)
        before, places, part = len(places), places[kept[long]], stretch[long]
        if len(places) == before:
            break
    return places, part


class Grammar:
    """Re-Pair of a sequence of numbers: rules as arrays of left and right symbols, and what is left of the sequence.

    Symbols below `terminals` are those of the sequence. A round replaces the pairs whose count is above half of the
    greatest: the more frequent ones first where they overlap, of equally frequent ones that with the smaller hash, so
    that equal stretches are replaced alike. Of overlapping equal pairs every second one counts.
    """

    def __init__(self, sequence: np.ndarray):
        seq = sequence.astype(np.int64)
        self.terminals = int(seq.max()) + 1 if len(seq) else 0
        n, length = self.terminals, np.ones(self.terminals, np.int64)
        lefts, rights, firsts, self.rounds = [], [], [], []
        while len(seq) > 1:
            code = seq[:-1] * n + seq[1:]
            again = np.zeros(len(code), bool)
            again[1:] = code[1:] == code[:-1]
            index = np.arange(len(code))
            odd = (index - np.maximum.accumulate(np.where(again, 0, index))) & 1 == 1
            free = np.flatnonzero(~odd)
            pairs, inverse, counts = np.unique(code[free], return_inverse=True, return_counts=True)
            top = int(counts.max())
            if top < 2:
                break
            many = (counts * 2 > top) & (counts >= 2)
            rank = np.full(len(pairs), len(pairs), np.int64)
            chosen = np.flatnonzero(many)
            rank[chosen[np.lexsort((_mixed(pairs[chosen]), -counts[chosen]))]] = np.arange(len(chosen))
            order = np.full(len(code) + 2, len(pairs), np.int64)
            order[free + 1] = rank[inverse]
            mine = order[1:-1]
            taken = np.flatnonzero((mine < len(pairs)) & (mine < order[:-2]) & (mine < order[2:]))
            used, first, which = np.unique(code[taken], return_index=True, return_inverse=True)
            size = length[seq]
            start = np.cumsum(size) - size
            self.rounds.append((n, n + len(used)))
            lefts.append(used // n)
            rights.append(used % n)
            firsts.append(start[taken[first]])
            length = np.append(length, length[used // n] + length[used % n])
            seq[taken] = n + which
            n += len(used)
            seq = np.delete(seq, taken + 1)
        none = np.zeros(0, np.int64)
        self.left, self.right = np.concatenate([none, *lefts]), np.concatenate([none, *rights])
        self.first, self.length, self.sequence = np.concatenate([none, *firsts]), length, seq

    def places(self, rules: np.ndarray) -> dict[int, np.ndarray]:
        """All places in the text of the nonterminals in `rules`."""
        wanted = np.zeros(len(self.length), bool)
        wanted[rules] = True
        above = wanted.copy()
        for low, high in self.rounds:
            above[low:high] |= above[self.left[low - self.terminals : high - self.terminals]] | above[self.right[low - self.terminals : high - self.terminals]]
        size = self.length[self.sequence]
        start = np.cumsum(size) - size
        found = collections.defaultdict(list)
        for i in np.flatnonzero(above[self.sequence]).tolist():
            found[int(self.sequence[i])].append(start[i : i + 1])
        out = {}
        for rule in np.flatnonzero(above)[::-1].tolist():
            if rule < self.terminals:
                continue
            at = np.concatenate(found.pop(rule))
            if wanted[rule]:
                out[rule] = at
            left, right = int(self.left[rule - self.terminals]), int(self.right[rule - self.terminals])
            if above[left]:
                found[left].append(at)
            if above[right]:
                found[right].append(at + self.length[left])
        return out


class _Compared:
    """How far stretches of a text are equal, by hashes modulo two primes; the caller checks what it takes from them."""

    PRIMES = (np.uint64(2**31 - 1), np.uint64(2**31 - 19))

    def __init__(self, text: np.ndarray, attempt: int):
        random = np.random.default_rng(attempt)
        self.tables = []
        for p in self.PRIMES:
            base = np.uint64(random.integers(1 << 20, 1 << 30))
            power = np.ones(1, np.uint64)
            step = base
            while len(power) <= len(text):
                power = np.append(power, power * step % p)
                step = step * step % p
            power = power[: len(text) + 1]
            numbers = (_mixed(text + 1) % p) * power[:-1] % p
            self.tables.append((p, power, np.append(np.uint64(0), np.cumsum(numbers) % p)))

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n numbers from i on are those from j on; i is not above j."""
        out = np.ones(len(i), bool)
        for p, power, prefix in self.tables:
            a, b = (prefix[i + n] + p - prefix[i]) % p, (prefix[j + n] + p - prefix[j]) % p
            out &= a * power[j - i] % p == b
        return out

    def ahead(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers from i on equal those from j on, at most limit."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            same = self.equal(np.minimum(i, j), np.maximum(i, j), half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def behind(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers before i equal those before j, at most limit."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            same = self.equal(np.minimum(i, j) - half, np.maximum(i, j) - half, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def _crossing(text: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs within nodes that lie across their middles, as node, first word, end and smallest period.

    A run of at least four periods has a whole period left or right of the middle, so it is seen by comparing the words
    around the middle with those one period further right or left.
    """
    nodes, attempt = np.flatnonzero(end - start >= MIN_LENGTH), 0
    found = [[], [], [], []]
    compared = _Compared(text, attempt)
    periods = (end - start) // MIN_PERIODS
    cuts = np.cumsum(periods[nodes]) // SLAB_TESTS
    for slab in np.split(nodes, np.flatnonzero(np.diff(cuts)) + 1):
        count = periods[slab]
        node = np.repeat(slab, count)
        q = np.arange(1, len(node) + 1) - np.repeat(np.cumsum(count) - count, count)
        s, b, e = start[node], middle[node], end[node]
        ahead = np.flatnonzero((b + q <= e) & (text[b - 1] == text[np.minimum(b - 1 + q, len(text) - 1)]))
        behind = np.flatnonzero((b - q >= s) & (text[b] == text[np.maximum(b - q, 0)]))
        while True:
            a, at = b[ahead], q[ahead]
            from_a = a - compared.behind(a, a + at, a - s[ahead])
            to_a = a + at + compared.ahead(a, a + at, e[ahead] - a - at)
            c, by = b[behind], q[behind]
            from_c = c - by - compared.behind(c - by, c, c - by - s[behind])
            to_c = c + compared.ahead(c - by, c, e[behind] - c)
            which = np.concatenate([node[ahead], node[behind]])
            first, last, period = np.concatenate([from_a, from_c]), np.concatenate([to_a, to_c]), np.concatenate([at, by])
            right = last - first >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
            which, first, last, period = which[right], first[right], last[right], period[right]
            # Multiples of a period have the same stretch: the smallest one stays.
            order = np.lexsort((period, last, first, which))
            which, first, last, period = which[order], first[order], last[order], period[order]
            new = np.ones(len(which), bool)
            new[1:] = (np.diff(which) != 0) | (np.diff(first) != 0) | (np.diff(last) != 0)
            which, first, last, period = which[new], first[new], last[new], period[new]
            if all(np.array_equal(text[x : y - p], text[x + p : y]) for x, y, p in zip(first.tolist(), last.tolist(), period.tolist())):
                break
            attempt += 1
            compared = _Compared(text, attempt)
        for out, column in zip(found, (which, first, last, period)):
            out.append(column)
    return tuple(np.concatenate([np.zeros(0, np.int64), *column]) for column in found)


def found_runs(words: np.ndarray, part: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of a text as (start, end, period), by start, then period. part numbers stretches, none of whose runs
    reaches into another; it rises along the text."""
    if not len(words):
        return []
    # Each stretch ends in a symbol of its own, which is in no pair that occurs twice.
    _, symbols = np.unique(words, return_inverse=True)
    stretches, sizes = np.unique(part, return_counts=True)
    ends = np.cumsum(sizes)
    text = np.insert(symbols, ends, symbols.max() + 1 + np.arange(len(ends)))
    word_at = np.delete(np.arange(len(text)), ends + np.arange(len(ends)))
    back = np.zeros(len(text) + 1, np.int64)
    back[word_at] = np.arange(len(words))
    back[word_at + 1] = np.arange(len(words)) + 1

    grammar = Grammar(text)
    rules = len(grammar.left)
    start, middle = grammar.first, grammar.first + grammar.length[grammar.left]
    end = start + grammar.length[grammar.terminals :]
    # What is left of the sequence is halved and halved again: a node of its own for each two neighbours.
    size = grammar.length[grammar.sequence]
    a, z = np.cumsum(size) - size, np.cumsum(size)
    own = grammar.sequence > symbols.max()
    own &= grammar.sequence < grammar.terminals
    stretch = np.cumsum(own) - own
    a, z, stretch = a[~own], z[~own], stretch[~own]
    tops = []
    while len(a) > len(np.unique(stretch)):
        place = np.arange(len(a))
        begin = np.ones(len(a), bool)
        begin[1:] = np.diff(stretch) != 0
        even = (place - np.maximum.accumulate(np.where(begin, place, 0))) & 1 == 0
        joined = np.flatnonzero(even[:-1] & ~even[1:] & (stretch[:-1] == stretch[1:]))
        tops.append((a[joined], z[joined], z[joined + 1]))
        z = z.copy()
        z[joined] = z[joined + 1]
        a, z, stretch = a[even], z[even], stretch[even]
    start = np.concatenate([start, *[t[0] for t in tops]])
    middle = np.concatenate([middle, *[t[1] for t in tops]])
    end = np.concatenate([end, *[t[2] for t in tops]])

    node, first, last, period = _crossing(text, start, middle, end)
    of_rule = node < rules
    at = grammar.places(np.unique(node[of_rule]) + grammar.terminals)
    moved = []
    for x, f, l, q in zip(node[of_rule].tolist(), first[of_rule].tolist(), last[of_rule].tolist(), period[of_rule].tolist()):
        to = at[x + grammar.terminals] - start[x]
        moved.append((f + to, l + to, np.full(len(to), q)))
    first = np.concatenate([first[~of_rule], *[m[0] for m in moved]])
    last = np.concatenate([last[~of_rule], *[m[1] for m in moved]])
    period = np.concatenate([period[~of_rule], *[m[2] for m in moved]])

    merged: list[list[int]] = []
    order = np.lexsort((last, first, period))
    for f, l, q in zip(first[order].tolist(), last[order].tolist(), period[order].tolist()):
        if merged and merged[-1][2] == q and f + q <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], l)
        else:
            merged.append([f, l, q])
    smallest: dict[tuple[int, int], int] = {}
    for f, l, q in merged:
        smallest[f, l] = min(q, smallest.get((f, l), q))
    return sorted(((int(back[f]), int(back[l]), q) for (f, l), q in smallest.items()), key=lambda run: (run[0], run[2]))


def altered(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a periodic tail in one of ten documents, by the checksum of the id; a null id alters nothing."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return (words[:a] + words[a : a + p] * -(-(n - a) // p))[:n]


def periodic_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of many texts as (start, length, period), by start, then period."""
    numbers = collections.defaultdict(itertools.count().__next__)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.fromiter((i for words in texts for i in map(numbers.__getitem__, words)), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    places, part = pruned(ids, text)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, last, period in found_runs(ids[places], part):
        at = int(places[first])
        t = int(text[at])
        out[t].append((at - int(starts[t]), last - first, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\1" * (length - period)
    return [word for word, out in zip(words, gone) if not out]


FIELDS = {"n_runs": "long", "start": "long", "length": "long", "period": "long", "exponent_milli": "long", "runs_sha256": "string", "collapsed_sha256": "string"}


def detected(docs: DataFrame, alter: bool = False, with_text: bool = True) -> DataFrame:
    """doc_id, the FIELDS, runs as (start, length, period) and the collapsed text, for every row of docs (doc_id, text).

    start, length, period and exponent_milli are those of the run with the greatest length / period, of equal ones the
    first, then that with the smallest period; null without runs. `alter` first gives texts a periodic tail, as altered()
    says. Null and wordless texts have no runs and collapse to ''. Repeated rows each have their row; other columns take
    no part. with_text=False leaves out runs and collapsed.
    """
    kinds = {name: pa.int64() if kind == "long" else pa.string() for name, kind in FIELDS.items()}
    if with_text:
        kinds |= {"runs": pa.list_(pa.struct({"start": pa.int64(), "length": pa.int64(), "period": pa.int64()})), "collapsed": pa.string()}

    def row(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        best = (None, None, None, None)
        if runs:
            top = runs[0]
            for run in runs[1:]:
                if run[1] * top[2] > top[1] * run[2]:
                    top = run
            best = (*top, 1000 * top[1] // top[2])
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        text = b" ".join(collapsed(words, runs))
        out = (len(runs), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest())
        return (*out, [dict(zip(("start", "length", "period"), run)) for run in runs], text.decode()) if with_text else out

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, held = [], [], 0
            for doc_id, data in zip(batch["doc_id"].to_pylist(), batch["text"]):
                data = data.as_py()
                words = data.split() if data else []
                texts.append(altered(words, doc_id) if alter else words)
                held += len(words)
                if held >= SLAB_WORDS:
                    rows += map(row, texts, periodic_runs(texts))
                    texts, held = [], 0
            rows += map(row, texts, periodic_runs(texts))
            columns = zip(*rows) if rows else [[] for _ in kinds]
            arrays = [batch["doc_id"], *[pa.array(list(column), kind) for column, kind in zip(columns, kinds.values())]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *kinds])

    schema = "doc_id bigint, " + ", ".join(f"{name} {kind}" for name, kind in FIELDS.items())
    schema += ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string" if with_text else ""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return docs.mapInArrow(detect, schema)
