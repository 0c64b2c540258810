"""Operators against brute force on small data."""

from __future__ import annotations

import collections
import datetime
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from atmolake.llm import ann, attention, bpe, licenses, lm, near_dedup, packing, pii, quality, sharding, toxicity
from atmolake.llm.queries import QUERIES
from tests.llm.conftest import EDGE, SF_DIR


# Nearest neighbours


def test_neighbours_find_nine_of_ten(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    data = {r["vec_id"]: np.array(r["embedding"], float) for r in vectors.collect()}
    ids, matrix = np.array(list(data)), np.array(list(data.values()))
    queries = [i for i in data if i % 10 == 0]
    found = collections.defaultdict(list)
    for r in ann.nearest(vectors, vectors.filter("vec_id % 10 = 0")).orderBy("rank").collect():
        assert r["score"] == pytest.approx(np.sqrt(((data[r["vec_id"]] - data[r["query_id"]]) ** 2).sum()), abs=1e-12)
        found[r["query_id"]].append(r["vec_id"])
    hits = 0
    for q in queries:
        d = np.sqrt(((matrix - data[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, d))[:10]]) & set(found[q]))
    assert hits >= 9 * len(queries)


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, df.filter("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 1, 0.0), (2, 2, 0.0)]


def test_chi_square_quantile():
    draws = (np.random.default_rng(0).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    assert (draws < ann.chi_square_quantile(0.95)).mean() == pytest.approx(0.95, abs=0.003)


# Sharding


def test_shards_fit_and_only_large_ones_are_split(spark, edge):
    limit = 700
    rows = sharding.assigned(edge, limit).collect()
    shards = collections.defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r)
    for bits, group in shards.items():
        size = sum(r["doc_bytes"] for r in group)
        assert size == group[0]["shard_bytes"] and len(group) == group[0]["shard_docs"] and len(bits) == group[0]["shard_depth"]
        assert size <= limit or len({(r["doc_id"], r["text"]) for r in group}) == 1
        if bits:  # the parent would not fit
            parent = [r for r in rows if r["shard"].startswith(bits[:-1])]
            assert sum(r["doc_bytes"] for r in parent) > limit and len({(r["doc_id"], r["text"]) for r in parent}) > 1


def test_repeated_documents_stay_together(spark):
    df = spark.createDataFrame([(1, "x" * 100)] * 20 + [(2, "y" * 50)], "doc_id long, text string")
    rows = {(r["doc_id"], r["shard_bytes"]) for r in sharding.assigned(df, 300).collect()}
    assert rows == {(1, 2000), (2, 50)}


# Quality


def test_frequent_lines_go_but_from_their_first_document(spark):
    rows = [(i, f"Menu  {i % 10}\n" + " ".join(f"t{i}w{j}" for j in range(60)), "h") for i in range(30)]
    rows += [(100 + i, "MENU 7\nshort", "h") for i in range(5)] + [(200, "menu 3\n" + "k " * 60, "other")]
    judged = {r["doc_id"]: r["quality"] for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert judged[0]["text"].startswith("Menu") and judged[0]["n_removed_lines"] == 0
    assert not judged[1]["text"].startswith("Menu") and judged[1]["kept"] and judged[1]["n_removed_words"] == 2
    assert not judged[100]["kept"] and judged[200]["n_removed_lines"] == 0


def test_copies_of_one_text_count_as_one_document(spark):
    text = "\n".join(" ".join(f"a{i}b{j}" for j in range(12)) for i in range(6))
    df = spark.createDataFrame([(i, text, "h") for i in range(60)], "doc_id long, text string, source string")
    assert all(r["quality"]["kept"] and r["quality"]["text"] == text for r in quality.quality_rules(df).collect())


def test_depleted_documents_are_rejected(spark):
    shared = "\n".join(f"line {chr(97 + i)} " + " ".join(f"s{i}x{j}y" for j in "abcdefghij") for i in range(8))
    rows = [(i, shared + f"\nown {'q' * (i + 1)} end", "h") for i in range(30)]
    judged = {r["doc_id"]: r["quality"] for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert judged[0]["kept"] and all(judged[i]["depleted"] and not judged[i]["kept"] and not judged[i]["base_failed"] for i in range(1, 30))


def test_shared_lines_at_any_size_of_a_host(spark):
    """The same boilerplate goes from a host of 60 and from one of 900; a passage is counted across hosts."""
    letters = str.maketrans("0123456789", "abcdefghij")  # digits count as 0
    own = lambda i: " ".join(f"t{i}w{j}".translate(letters) for j in range(120))
    passage = " ".join(f"passage{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(55))
    rows = [(i, ("Click here now\n" if i < 30 else "") + own(i), "small") for i in range(60)]
    rows += [(1000 + i, ("Read our news\n" if i < 30 else "Twenty only\n" if i < 50 else "") + own(1000 + i), "large") for i in range(900)]
    rows += [(3000 + i, passage + "\n" + own(3000 + i), f"host{i}") for i in range(6)] + [(3000, passage + "\n" + own(3000), "host0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = quality.judge(docs, quality.shared_lines(docs)).collect()
    assert len(out) == len(rows)
    gone = {r["doc_id"] for r in out if r["quality"]["n_removed_lines"]}
    assert gone == {*range(1, 30), *range(1001, 1030), *range(3001, 3006)}
    assert all(r["quality"]["kept"] and r["quality"]["text"] == own(r["doc_id"]) for r in out if r["doc_id"] in gone)


# Near duplicates


def brute_force(docs):
    sets = []
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        sets.append((doc_id, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()))
    label = {doc_id: doc_id for doc_id, _ in sets}
    changed = True
    links = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if s and t and 100 * len(s & t) >= 85 * len(s | t)]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {doc_id: (len(s), label[doc_id]) for doc_id, s in sets}


def test_near_duplicates_of_all_documents(spark, documents):
    rows = near_dedup.near_duplicates(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_force(documents)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for i in range(250):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            words[rng.randrange(150)] = f"e{rng.randrange(1000)}"
        docs.append((i, " ".join(words)))
    rows = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_force(docs)


def test_chains_are_one_component(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in near_dedup.components(links).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and got[101] == 100


def test_near_duplicates_of_odd_rows(edge):
    rows = near_dedup.near_duplicates(edge).collect()
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in rows}
    assert {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True), (6, 6, True), (7, 7, True), (8, 7, False), (None, None, True)} <= got


# Packing


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_filled_as_well_as_can_be(seed):
    rng = random.Random(seed)
    capacity = 40
    counts = collections.Counter(rng.randint(1, capacity - 1) for _ in range(rng.choice([1, 5, 60])))
    left = dict(counts)
    for pattern in packing.plan(counts, capacity):
        reach = {0}
        longest = max(k for k, n in left.items() if n)
        for length, n in left.items():
            for _ in range(n - (length == longest)):
                reach |= {s + length for s in reach if s + length <= capacity - longest}
        assert sum(k * n for k, n in pattern.counts.items()) == longest + max(reach)
        for length, n in pattern.counts.items():
            left[length] -= n * pattern.times
    assert not any(left.values())


def test_every_id_is_in_one_place(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = {i: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0] for i, text in documents}
    rows = QUERIES["op7_packing"](spark, SF_DIR).collect()
    starts, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        starts[r["doc_id"]].append((r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for group, total in [(starts, None), (places, 1024)]:
        for key, spans in group.items():
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at == len(ids[key]) if total is None else at <= total
    assert set(starts) == set(ids) and len(places) <= math.ceil(sum(map(len, ids.values())) / 1024) + 2


def test_unseen_parts_are_merged_as_the_library_does(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    encoder = packing.ByteBpe(path, 100)
    encoder.tokenizer = None  # a Latin text needs no call of the library
    rng = random.Random(5)
    letters = "aeinst éßŽ'\n 0.," + "thinger" * 3
    for _ in range(500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 120)))
        assert encoder(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    # "abc" is listed as a + bc, but "ab" comes first, so that it is never made; tiktoken would make it of ab + c.
    vocab = {c: i for i, c in enumerate(sorted(pre_tokenizers.ByteLevel.alphabet()))} | {"ab": 256, "bc": 257, "abc": 258}
    odd = Tokenizer(models.BPE(vocab, [("a", "b"), ("b", "c"), ("a", "bc")]))
    odd.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    odd.save(str(tmp_path / "odd.json"))
    encoder = packing.ByteBpe(str(tmp_path / "odd.json"), 100)
    assert encoder.merger is None
    assert encoder("abc bc") == np.array(odd.encode("abc bc").ids, "<u4").tobytes()


# Pseudonyms


def test_pseudonyms_keep_format_validity_and_links():
    text = "a.b1@mail5.example.com +1 (743) 555-3824 4316522678525456 233.233.171.252 2024-02-29 GB82 WEST 1234 5698 7654 32 123-45-6789"
    new, found = pii.pseudonymized(text)
    assert [kind for *_, kind, _ in found] == ["email", "phone", "card", "ipv4", "date", "iban", "ssn"]
    assert len(new) >= len(text) - 8 and pii.pseudonymized(text + " x")[0] == new + " x"
    values = {kind: value for *_, kind, value in found}
    assert pii.luhn(values["card"]) == 0 and pii._mod97(values["iban"].replace(" ", "")) == 1
    assert all(0 <= int(x) < 256 for x in values["ipv4"].split("."))
    assert [kind for *_, kind, _ in pii.pseudonymized(new)[1]] == ["email", "phone", "card", "ipv4", "date", "iban", "ssn"]
    assert pii.pseudonymized(text, b"other")[0] != new


def test_what_is_not_valid_stays():
    text = "1234567890123456, 999.1.1.1, 2023-02-30, 000-12-3456, v1.2.3, a@b, 3,000, 12:30, Version 2.0."
    assert pii.pseudonymized(text) == (text, []) and pii.pseudonymized(None) == (None, []) and pii.pseudonymized("") == ("", [])


def test_numbers_behind_brackets_and_marks():
    values = {"date": "1985-03-12", "ipv4": "192.168.0.1", "phone": "555-323-4567", "card": "4316522678525456", "ssn": "123-45-6789"}
    for kind, value in values.items():
        for form in ("({})", "see f({}).", "[({})]", "_{}_", "x/{}", "--{}", "@{}", "..{}", "+{}"):
            text = form.format(value)
            new, found = pii.pseudonymized(text)
            if form == "+{}" and kind in ("phone", "ssn"):
                assert value not in new  # a telephone number of another country
            else:
                assert [f[2] for f in found] == [kind] and text[found[0][0] : found[0][1]] == value, text
    for text in ("2020-01-01/2020-02-01", "2020-01-01-2020-02-01", "(2020-01-01)-(2020-02-01)"):
        assert [f[2] for f in pii.pseudonymized(text)[1]] == ["date", "date"]
    for text in ("1.2.3.4.5", "v1.2.3.4", "7/12/31/2020", "0000-2020-01-01", "9-555-323-4567-1"):
        assert pii.pseudonymized(text) == (text, [])


def test_ibans_before_other_words():
    ibans = ["AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "LU28 0019 4006 4475 0000", "PL61109010140000071219812874", "SE45 5000 0000 0583 9825 7466", "GB82 WEST 1234 5698 7654 32"]
    for iban in ibans:
        for behind in ("", " EUR", " 500", " EURO 12", " 1234 5678", " and", ", EUR"):
            text = f"to {iban}{behind}"
            spans = [f for f in pii.spans(text) if f[2] == "iban"]
            assert [(a, b) for a, b, *_ in spans] == [(3, 3 + len(iban))], text
            assert pii._mod97(spans[0][3].replace(" ", "")) == 1
    assert [f[2] for f in pii.spans(" ".join(ibans))] == ["iban"] * len(ibans)


def test_same_number_in_other_formats_stays_linked():
    digits = lambda s: "".join(c for c in s if c.isdigit())[-10:]
    assert digits(pii.pseudonymized("call +1 (743) 555-3824")[0]) == digits(pii.pseudonymized("743-555-3824")[0])
    dates = [pii.pseudonymized(s)[0] for s in ("2024-02-05", "05.02.2024", "2024/02/05")]
    assert dates[0].split("-") == dates[1].split(".")[::-1] == dates[2].split("/")


@pytest.mark.parametrize("left,right", [(1, 10), (10, 10), (7, 13)])
def test_feistel_is_a_permutation(left, right):
    assert sorted(pii.feistel(i, left, right, b"k", "t") for i in range(left * right)) == list(range(left * right))


def test_a_day_has_one_pseudonym_in_all_forms():
    """Read as it was written, the day is the same whatever the form, and no other day comes to it."""

    def read(text):
        a, b, c = (int(p) for p in text.replace("/", " ").replace(".", " ").replace("-", " ").split())
        if a > 99:
            return (a, b, c)
        return (c, b, a) if "." in text or a > 12 else (c, a, b)

    seen = set()
    for n in range(0, pii._DAYS, 11):
        d = datetime.date.fromordinal(pii._FIRST + n)
        forms = [f"{d:%Y-%m-%d}", f"{d:%Y/%m/%d}", f"{d:%d.%m.%Y}", f"{d:%m/%d/%Y}"] + [f"{d:%d/%m/%Y}"] * (d.day > 12)
        new = {read(pii._date(form, b"k")) for form in forms}
        assert len(new) == 1 and not new & seen, forms
        seen |= new


def test_the_key_comes_from_the_session(spark):
    docs = spark.createDataFrame([("call 743-555-3824", 1)], "text string, _pii int")
    with pytest.warns(UserWarning, match="known to all"):
        plain = pii.pseudonymize(docs).first()
    spark.conf.set(pii.KEY_SETTING, "of a deployment")
    try:
        keyed = pii.pseudonymize(docs, into="found").first()
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert keyed["text"] == pii.pseudonymized("call 743-555-3824", b"of a deployment")[0] != plain["text"]
    assert keyed["_pii"] == 1 and keyed["found"]["phone"] == 1


def test_the_query_replaces_whole_texts(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op8_pii"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        new, found = pii.pseudonymized(text)
        assert rows[doc_id]["text"] == new and rows[doc_id]["date"] == sum(f[2] == "date" for f in found)


def test_dates_are_permuted():
    days = [datetime.date.fromordinal(pii._FIRST + i).isoformat() for i in range(0, pii._DAYS, 7)]
    new = {pii._date(d, b"k") for d in days}
    assert len(new) == len(days) and all(1900 <= int(d[:4]) <= 2099 for d in new)


# Byte-level BPE


def test_codec_equals_the_library(documents):
    import tiktoken

    codec = bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.transducer.ranks, special_tokens={})
    texts = [t for _, t in documents if t] + [t for _, t, _ in EDGE if t] + ["a" * 700, "ab" * 300 + "\n\n\n  x", "привет мир ελληνικά 한국어", "'s ''s !'s 12½ ²"]
    for text in texts:
        ids = codec.encode(text)
        assert ids == np.array(encoding.encode_ordinary(text), "<u4").tobytes()
        assert codec.decode(ids) == text
    assert codec.encode(None) == codec.encode("") == b"" and codec.decode(b"") == ""


def test_transducer_on_random_bytes_and_tables():
    rng = random.Random(1)
    for _ in range(40):
        ranks = {bytes([b]): b for b in range(97, 101)}
        while len(ranks) < 30:  # merges of tokens that are there, so every token can be reached
            ranks.setdefault(rng.choice(list(ranks)) + rng.choice(list(ranks)), 200 + len(ranks))
        transducer = bpe.Transducer(ranks, max_states=50)
        for _ in range(40):
            data = bytes(rng.choice(b"aabcd") for _ in range(rng.randint(1, 30)))
            parts = [data[i : i + 1] for i in range(len(data))]
            while found := [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]:
                i = min(found)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            expected = [ranks[data]] if data in ranks else [ranks[p] for p in parts]
            if not transducer.odd:
                assert transducer.encode(data) == expected


def test_utf8_machine_equals_pythons_decoder():
    rng = random.Random(2)
    decoder = bpe.Decoder({i: bytes([i]) for i in range(256)})
    for _ in range(3000):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC3, 0xA9, 0xE0, 0xE2, 0x82, 0xAC, 0xED, 0xF0, 0x9F, 0x98, 0x80, 0xF4, 0xFF, 0xC0]) for _ in range(rng.randint(0, 9)))
        assert decoder.decode(data) == data.decode("utf-8", "replace")


# Toxicity and the language model


def test_toxicity_on_held_out_rows():
    rng = random.Random(3)
    plain, bad = [f"{a}{b}" for a in ("on", "er", "ti", "an") for b in ("th", "re", "ly", "in", "st")], ["idiotic", "moronic", "scummy"]
    texts, toxic = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(60)]
        toxic.append(i % 4 == 0)
        for _ in range(3 * toxic[-1]):
            words[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(words))
    model = toxicity.fit(texts[:300], np.array(toxic[:300]))
    right = sum((toxicity.score(model, t) >= 0.5) == y for t, y in zip(texts[300:], toxic[300:]))
    assert right >= 97 and 0 <= toxicity.score(model, None) < 0.5
    assert toxicity.score(toxicity.fit([], np.array([])), "x") < 0.5 and toxicity.score(toxicity.fit(["a"], np.array([1])), "x") > 0.5


def test_attention_gradient_and_sums():
    counts = np.random.default_rng(0).integers(0, 50, attention.SLOTS)
    flat = attention.initial(counts).astype(np.float64)
    windows = np.random.default_rng(1).integers(0, attention.SLOTS, (2, attention.SPAN + 1))
    loss, g = attention.gradient(flat, windows[:, :-1], windows[:, 1:])
    p = attention.unpack(flat)
    assert loss == pytest.approx(-attention.log_probability(p, windows[:, :-1], windows[:, 1:]).mean())
    for j in np.random.default_rng(2).integers(0, len(flat), 20):
        step = np.zeros(len(flat))
        step[j] = 1e-4
        slope = (attention.gradient(flat + step, windows[:, :-1], windows[:, 1:])[0] - attention.gradient(flat - step, windows[:, :-1], windows[:, 1:])[0]) / 2e-4
        assert g[j] == pytest.approx(slope, abs=1e-7)
    one = np.repeat(windows[:1, :-1], attention.SLOTS, axis=0)
    target = np.tile(windows[0, 1:], (attention.SLOTS, 1))
    target[:, -1] = np.arange(attention.SLOTS)
    assert np.exp(attention.log_probability(p, one, target)[:, -1]).sum() == pytest.approx(1)


def test_all_groups_share_their_exponentials(monkeypatch):
    """One call for the attention, one for the groups and one for the members, not one for each group; repeated and rare
    slots and groups that do not occur give the sums of the plain formulas."""
    rng = np.random.default_rng(4)
    windows = np.where(rng.random((3, attention.SPAN + 1)) < 0.5, 7, rng.integers(0, 200, (3, attention.SPAN + 1)))
    flat = attention.initial(rng.integers(0, 50, attention.SLOTS)).astype(np.float64)
    p, slots, targets = attention.unpack(flat), windows[:, :-1], windows[:, 1:]
    z = attention._hidden(p, slots, 0)[-1].reshape(-1, attention.WIDTH)
    groups = z @ p["group"] + p["group_bias"]
    members = np.einsum("nw,nwm->nm", z, p["member"][targets.reshape(-1) // attention.MEMBERS]) + p["member_bias"][targets.reshape(-1) // attention.MEMBERS]
    ln = lambda t, at: t[np.arange(len(at)), at] - np.log(np.exp(t).sum(axis=1))
    plain = ln(groups, targets.reshape(-1) // attention.MEMBERS) + ln(members, targets.reshape(-1) % attention.MEMBERS)
    calls = collections.Counter()

    class Counted:
        def __getattr__(self, name):
            calls[name] += 1
            return getattr(np, name)

    monkeypatch.setattr(attention, "np", Counted())
    assert attention.log_probability(p, slots, targets).reshape(-1) == pytest.approx(plain) and calls["exp"] == 3
    loss, g = attention.gradient(flat, slots, targets)
    assert calls["exp"] == 6 and loss == pytest.approx(-plain.mean())
    unseen = np.setdiff1d(np.arange(attention.SLOTS), slots)
    assert not attention.unpack(g)["embed"][unseen].any() and attention.unpack(g)["embed"][7].any()


def test_the_gradient_of_an_embedding_sums_all_its_places():
    """Numbers are added two at a time, in the order of places, as by rows; logits are cut only where one is over the bound."""
    flat = attention.initial(np.ones(attention.SLOTS)) * np.float32(30)
    windows = np.random.default_rng(7).integers(0, 9, (4, attention.SPAN + 1))
    loss, g = attention.gradient(flat, windows[:, :-1], windows[:, 1:])
    assert np.isfinite(loss) and attention.EMBED.shape == (attention.SLOTS, attention.WIDTH // 2)
    embed = attention.unpack(g)["embed"]
    assert embed[:9].any(axis=1).all() and not embed[9:].any()
    for logits in ([[-50.0, 3.0]], [[2.0, 90.0]], [[1.0, -1.0]]):
        e = np.array(logits)
        attention._exp(e)
        assert (e == np.exp(np.clip(logits, -40, 40))).all()


def test_language_model_base_scores(spark, documents):
    counts, n = collections.Counter(), 0
    for i, text in documents:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*(text or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    texts = dict(documents)
    rows = QUERIES["op3_attention_lm"](spark, SF_DIR).collect()
    assert len(rows) == len(documents)
    for r in rows:
        tokens = [*(texts[r["doc_id"]] or "").encode().lower().split(), b""]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) and r["score"] < 0


def test_windows_cover_whole_training_texts(monkeypatch):
    """Every id of every text is predicted in exactly one window, however long the text is."""
    import pandas as pd

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    subwords = lm.Subwords(path)
    texts = [" ".join(f"word{i} and more" for i in range(3000)), None, "", "one two", " ".join(["again"] * 700)]
    expected = collections.Counter(i for t in texts for i in subwords.encode((t or "").encode().split()))
    for held in (20_000, 7):
        monkeypatch.setattr(lm, "HELD_WINDOWS", held)
        out = pd.concat(lm._gather(path)([pd.DataFrame({"doc_id": range(5), "text": texts})]))
        windows = [w for w in out["ids"] if w is not None]
        assert {len(w) for w in windows} == {attention.SPAN + 1}
        predicted = collections.Counter(int(i) for w in windows for i in w[1:])
        del predicted[subwords.end]
        assert predicted == expected


@pytest.mark.parametrize("part", [4_000_000, 40])
def test_a_word_is_encoded_once_for_all_texts(monkeypatch, part):
    """The ids are those of whole texts, also where a match of the tokenizer's pattern goes over the end of a word."""
    import pandas as pd

    path, encoded = public_tokenizers.path("byte_bpe_50k.tiktoken"), []

    class Counted(lm.Subwords):
        def __init__(self, path):
            super().__init__(path)
            self.plain, self.encoding = self.encoding, self

        def encode_ordinary(self, text):
            encoded.append(len(text))
            return self.plain.encode_ordinary(text)

    monkeypatch.setattr(lm, "Subwords", Counted)
    monkeypatch.setattr(lm, "PART_CHARS", part, raising=False)
    odd = ["a\u3000 \u3000b", " a\xa0 \xa0\xa0c\x1c 's", None, "", " \n", "don't It's 12a \ufffd", "\x85 \x85 \u65e5\u672c \u00c9\u00e9 \U0001f600"]
    texts = [*odd, *["Some words AGAIN and again\n " * 300] * 30]
    subwords, stream, words = lm.Subwords(path), [], collections.Counter({b"": len(texts)})
    for text in texts:
        split = (text or "").encode().lower().split()
        words.update(split)
        stream += [subwords.end, *(subwords.plain.encode_ordinary(" " + b" ".join(split).decode()) if split else [])]
    out = pd.concat(lm._gather(path)([pd.DataFrame({"text": texts})]))
    found = np.concatenate([w[:-1] for w in out["ids"] if w is not None])
    assert found[: len(stream)].tolist() == stream and (found[len(stream) :] == subwords.end).all()
    assert {w: n for w, n in zip(out["word"], out["n"]) if w is not None} == words
    assert part < 1_000 or sum(encoded) < 1_000


def test_scores_in_blocks_are_those_of_all_windows(monkeypatch):
    rng = np.random.default_rng(5)
    windows = rng.integers(0, attention.SLOTS, (70, attention.SPAN + 1))
    p = attention.unpack(attention.initial(rng.integers(0, 50, attention.SLOTS)))
    whole = attention.log_probability(p, windows[:, :-1], windows[:, 9:], 8)
    sizes = []
    hidden = attention._hidden
    monkeypatch.setattr(attention, "_hidden", lambda p, slots, first: (sizes.append(len(slots)), hidden(p, slots, first))[1])
    monkeypatch.setattr(attention, "BLOCK", 32, raising=False)
    assert attention.log_probability(p, windows[:, :-1], windows[:, 9:], 8) == pytest.approx(whole) and sizes == [32, 32, 6]


def test_windows_are_packed_and_dealt_as_lists_were(spark):
    """Windows are bytes and no lists; their hashes are Spark's of the lists, so the same windows come first and in a round."""
    import pandas as pd
    import pyarrow as pa

    path, texts = public_tokenizers.path("byte_bpe_50k.tiktoken"), ["some words and more " * 40, None, "", "one"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    rows = docs.mapInArrow(lm._gather_arrow(path), "word binary, n long, ids binary, place long, deal long").collect()
    found = [r for r in rows if r["ids"] is not None]
    ids = [np.frombuffer(r["ids"], lm._kind(50_256)).tolist() for r in found]
    assert len(ids) > 4 and {len(w) for w in ids} == {attention.SPAN + 1}
    assert ids == [w.tolist() for w in pd.concat(lm._gather(path)([pd.DataFrame({"text": texts})]))["ids"] if w is not None]
    hashes = spark.createDataFrame([(w,) for w in ids], "ids array<int>").select(F.xxhash64("ids"), F.xxhash64("ids", F.lit(1))).collect()
    assert [(r["place"], r["deal"]) for r in found] == [tuple(h) for h in hashes]
    assert all(r["place"] is None and r["deal"] is None for r in rows if r["ids"] is None) and lm._kind(1 << 16) == "<i4"
    column = pa.array([r["ids"] for r in found], pa.binary())
    assert lm._unpacked(column, "<u2").tolist() == ids and lm._unpacked(column[2:4], "<u2").tolist() == ids[2:4]


def test_a_round_is_the_average_of_its_tasks(spark):
    """Also with more tasks than add up, and with tasks that have no windows. Weights reach the driver as a few sums."""
    windows = np.random.default_rng(6).integers(0, 60, (90, attention.SPAN + 1)).astype("<u2")
    model = lm.Model(np.arange(100.0))
    parts = [windows[:40], windows[:0], *np.split(windows[40:], 10)]
    table = spark.sparkContext.parallelize([[(bytearray(w.tobytes()),) for w in part] for part in parts], len(parts)).flatMap(list).toDF("ids binary")
    expected = sum(attention.train(model.flat, model.slot[part], 1, 0.01) * np.float64(len(part)) for part in parts if len(part)) / 90
    assert lm._round(table, model, 0.01) == pytest.approx(expected, abs=1e-6)
    assert lm._round(table.filter("ids IS NULL"), model, 0.01) is None


def test_the_driver_gets_the_head_alone_and_windows_go(spark, monkeypatch):
    """Words too rare for the head are left out before its sort, windows are removed before the texts are scored, and rows
    are the same with words in the head and behind it."""
    texts = ["often often often twice", "often twice once", "more words once each"] * 3 + ["seldom"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path, sorted_, removed, DataFrame = public_tokenizers.path("byte_bpe_50k.tiktoken"), [], [], type(docs)
    monkeypatch.setattr(lm, "FIRST_STEPS", 1)
    wanted = {r["doc_id"]: tuple(r)[1:-1] for r in lm.scored(docs, path).collect()}
    order, remove = DataFrame.orderBy, lm.folders.remove
    monkeypatch.setattr(lm, "HEAD", 3)
    monkeypatch.setattr(DataFrame, "orderBy", lambda self, *c: (sorted_.append(self), order(self, *c))[1])
    monkeypatch.setattr(lm.folders, "remove", lambda spark, path: (removed.append(path), remove(spark, path)))
    found = {r["doc_id"]: tuple(r)[1:-1] for r in lm.scored(docs, path).collect()}
    assert found.keys() == wanted.keys() and all(found[i] == pytest.approx(wanted[i]) for i in wanted)
    (head,) = [df for df in sorted_ if "word" in df.columns]
    assert 3 <= head.count() < len(set(" ".join(texts).split())) and len(removed) == 2


def test_scores_of_odd_rows_are_finite(edge):
    rows = lm.scored(edge, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert len(rows) == len(EDGE) and all(math.isfinite(r["score"]) for r in rows)


def test_rounds_grow_with_the_windows():
    assert [lm.n_rounds(n) for n in (0, 10, 50_000, 60_000, 3_200_000)] == [1, 1, 1, 2, 8]


# Toxicity


def test_the_toxicity_query_learns_outside_its_fold_and_from_texts_alone(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op10_toxicity"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for doc_id, _ in documents:
        assert rows[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert rows[doc_id]["predicted"] == int(rows[doc_id]["score"] >= 0.5) and 0 <= rows[doc_id]["score"] <= 1
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    scores = lambda d, lab: {r["text"]: r["s"] for r in toxicity.scored(d, toxicity.train(d, lab), "s").collect()}
    plain = scores(docs, labels)
    # Labels of the held-out fold, other columns and the order of rows make no difference.
    turned = labels.withColumn("toxic", F.when(toxicity.crc_mod("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert scores(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}).repartition(7), turned) == plain
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in truth if i in rows and rows[i]["held_out"]]
    assert len(held) > 5 and sum(rows[i]["predicted"] == truth[i] for i in held) >= 0.9 * len(held)


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    rows = [(i, ("nice day friend " if i % 2 else "vile awful scum ") * 5) for i in range(40)]
    labels = [(i, 1 - i % 2) for i in range(40)]
    make = lambda r, lab: toxicity.train(spark.createDataFrame(r, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, toxic int"))
    once = make(rows, labels)
    many = make([*rows, *rows[:7] * 30], [*labels, *labels[:9] * 20, (100, 0), (100, 1)])
    assert np.array_equal(once.weights, many.weights) and once.bias == many.bias


# Near duplicates


@pytest.mark.parametrize("n, percent", [(96, 85), (144, 80), (1024, 85), (1024, 80)])
def test_pairs_are_told_apart_by_the_exact_tail(n, percent):
    from fractions import Fraction

    rate = (1 - Fraction(percent, 100)) * Fraction(15, 16)
    tail = lambda k: sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1, n + 1))
    most = near_dedup.most_unlike(n, percent)
    assert float(tail(most)) <= near_dedup.MISSED < float(tail(most - 1))


# Licenses


def test_null_and_repeated_ids_are_files_of_their_own(spark):
    mit, bsd = "Released under the MIT License.", "Released under the BSD 2-Clause License."
    prose = " ".join(f"word{i}" for i in range(200))
    rows = [
        (None, "a/x", f"{prose}\n{mit}\n{prose}"), (None, "a/y", prose), (1, "a/z", f"{prose}\n{mit}"), (1, "a/z", f"{prose}\n{bsd}"),
        (2, "a/w", f"{prose}\n{bsd}"), (2, "a/w", f"{prose}\n{bsd}"), (3, None, None),
    ]
    out = licenses.scan(spark.createDataFrame(rows, "id long, path string, text string"))
    assert sorted(((r["id"], r["path"], r["license"]) for r in out.collect()), key=repr) == sorted(
        [(None, "a/x", "MIT"), (None, "a/y", None), (1, "a/z", "MIT"), (1, "a/z", "BSD-2-Clause"), (2, "a/w", "BSD-2-Clause"),
         (2, "a/w", "BSD-2-Clause"), (3, "", None)], key=repr
    )


def test_a_license_comes_from_the_nearest_ancestor_that_has_one(spark):
    mit, bsd = "Released under the MIT License.", "Released under the BSD 2-Clause License."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c/d/file", "text"), (3, "a/b/c/LICENSE", bsd), (4, "a/b/file", "text"), (5, "z/file", "text"), (6, "a/file", "text"),
    ]
    out = licenses.scan(spark.createDataFrame(rows, "id long, path string, text string"))
    found = {r["id"]: (r["license"], r["inherited_from"]) for r in out.collect()}
    assert found == {1: ("MIT", None), 2: ("BSD-2-Clause", "a/b/c"), 3: ("BSD-2-Clause", None), 4: ("MIT", "a"), 5: (None, None), 6: ("MIT", "a")}
