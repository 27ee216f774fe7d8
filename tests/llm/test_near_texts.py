"""The pipeline's near duplicates against brute force over all pairs."""

import collections

import numpy as np
from pyspark.sql import functions as F
import pytest

pytest.importorskip("duckdb")

from tallymark.llm import near_texts, simhash  # noqa: E402
from tallymark.llm.common import text_key  # noqa: E402


def plain(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_no_near_pair_is_missed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r["key"]: plain(r["text"]) for r in docs.select(text_key(docs["text"]).alias("key"), "text").collect()}
    posted = collections.defaultdict(list)
    for key, every in sets.items():
        for one in every:
            posted[one].append(key)
    met = {(a, b) for keys in posted.values() for i, a in enumerate(keys) for b in keys[:i]}
    pairs = [(a, b) for a, b in met if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r["key"]: r["root"] for r in near_texts.groups(docs).collect()}
    want = {k: find(k) for pair in pairs for k in pair}
    assert len(pairs) >= 5 and got == want


def test_one_of_near_copies_stays(spark):
    words = [f"w{i}" for i in range(200)]
    # 195 of 201 shingles are shared with the first text; 150 of 250 with the last.
    near = [" ".join([*words[:i], "x", *words[i + 1 :]]) for i in range(50, 150)]
    far = " ".join([*words[:154], *(f"y{i}" for i in range(46))])
    docs = spark.createDataFrame([(1, " ".join(words)), *((i, t) for i, t in enumerate(near, 2)), (500, far)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == [1, 500]


def test_sketches_never_rule_out_a_near_pair():
    rng = np.random.default_rng(4)
    for n in (3, 40, 700, 1100, 5000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.unique(np.r_[a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 63, n // 10).astype(np.uint64)])
            differ = len(np.setxor1d(a, b))
            assert near_texts.apart(near_texts.sketch(a), near_texts.sketch(b)) <= differ
    a, b = (rng.integers(0, 1 << 63, 3000).astype(np.uint64) for _ in "ab")
    assert 9 * near_texts.apart(near_texts.sketch(a), near_texts.sketch(b)) > 6000


def test_hashes_are_those_of_the_words(monkeypatch):
    texts = ["", " \n", "a", "A  b", "a b c d e", "x A\tb c d E y", "a b c d e f " * 30, "ß Ü ü 字 x y z"]
    sets = {i: set(s.tolist()) for i, s in near_texts.shingle_sets([t.encode() for t in texts])}
    monkeypatch.setattr(near_texts, "TOGETHER", 8)
    assert sets == {i: set(s.tolist()) for i, s in near_texts.shingle_sets([t.encode() for t in texts])}
    assert [len(sets[i]) for i in range(len(texts))] == [len(plain(t)) for t in texts]
    assert sets[0] == sets[1] and sets[4] < sets[5] and not sets[2] & sets[3]


def test_a_passage_in_thousands_of_texts_forms_no_pairs(spark):
    # One passage of 40 words in 4,000 otherwise different texts, some of them near copies.
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(map(str, rng.integers(0, 1 << 40, 60))) + f" {passage} " + " ".join(map(str, rng.integers(0, 1 << 40, 60)))) for i in range(4000)]
    rows += [(10_000 + i, rows[i][1] + " end") for i in range(0, 4000, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = docs.select(text_key(docs["text"]).alias("key"), "text")
    places = near_texts.at_shingles(texts, near_texts.often_shared(texts))
    assert places.groupBy("shingle").count().agg({"count": "max"}).first()[0] < 50
    assert near_texts.groups(docs).count() == 80


def test_short_near_copies_do_not_meet_at_what_they_share(spark):
    # One word less each: similarity well below 4/5 in every pair, with nearly all shingles in common.
    base = [f"b{i}" for i in range(25)]
    rows = [(i * 1000 + j, " ".join(base[:j] + base[j + 1 :] + [f"t{i}"])) for i in range(40) for j in range(1, 24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = docs.select(text_key(docs["text"]).alias("key"), "text")
    places = near_texts.at_shingles(texts, near_texts.often_shared(texts))
    rooted = places.withColumn("root", places["key"])
    met = set(map(tuple, near_texts.meeting(rooted.withColumns(dict.fromkeys(near_texts.SHORT, F.lit(0)))).collect()))
    assert len(met) < len(rows) ** 2 / 20
    # Short sketches tell some of them apart where they meet, and no near ones.
    signs = near_texts.signatures(texts).select("key", *near_texts.SHORT)
    kept = set(map(tuple, near_texts.meeting(rooted.join(signs, "key")).collect()))
    keys = [r["key"] for r in texts.collect()]
    members = dict(near_texts.shingle_sets([r["text"].encode() for r in texts.collect()]))
    sets = {key: members[i] for i, key in enumerate(keys)}
    assert kept < met and not any(near_texts.near(sets[a], sets[b]) for a, b in met - kept)


def test_short_sketches_differ_in_no_more_bits_than_the_sets_in_members():
    rng = np.random.default_rng(8)
    for n in (3, 40, 600, 5000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for changed in (0, 1, n // 10, n):
            b = np.concatenate((a[changed:], rng.integers(0, 1 << 63, changed).astype(np.uint64)))
            differ = near_texts.parities(a, near_texts.MEETING) != near_texts.parities(b, near_texts.MEETING)
            assert differ.sum() <= len(np.setxor1d(a, b))
