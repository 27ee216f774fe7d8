"""The registered queries against plain Python, on the smallest given tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

duckdb = pytest.importorskip("duckdb")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tallymark.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def result(spark, name):
    return {r["doc_id"]: r.asDict() for r in queries.QUERIES[name](spark, SF).collect()}


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public_tokenizers.path(name)))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=repr)


def test_token_files_match_the_library(spark, docs):
    tokenizer, got, start = library("word_bpe_49k.json"), result(spark, "op3_token_files"), 0
    for doc_id, text, _ in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want = {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        assert got[doc_id] == want
        start += len(ids)


def test_token_counts_match_the_library(spark, docs):
    tokenizer, got = library("byte_bpe_50k.json"), result(spark, "op4_token_counts")
    for doc_id, text, _ in docs:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert got[doc_id] == {"doc_id": doc_id, "n_bytes": len((text or "").encode()), "n_tokens": n, "over_limit": n > 512}


def plain_fingerprint(text, k=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_all_pairs(spark, docs):
    got = result(spark, "op9_simhash")
    prints = {doc_id: plain_fingerprint(text) for doc_id, text, _ in docs}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for d in ids:
        assert got[d] == {"doc_id": d, "fingerprint": f"{prints[d]:016x}", "component_id": find(d)}


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(full.values())) / (sum(weight[s] for s in rest) or 1)
        over = [s for s in rest if weight[s] * level > 3 * sizes[s]]
        if not over:
            return full | {s: weight[s] * level for s in rest}
        full |= {s: 3.0 * sizes[s] for s in over}


def test_mixing_meets_its_targets(spark, docs):
    got = result(spark, "op6_mixing")
    size = {d: len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for d, t, _ in docs}
    by_source, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for d, _, s in docs:
        by_source[s] += size[d]
        taken[s] += got[d]["taken"]
        largest[s] = max(largest[s], size[d])
    targets = plain_targets(by_source)
    for d, _, s in docs:
        assert got[d]["size"] == size[d] and got[d]["source_size"] == by_source[s]
        assert math.isclose(got[d]["target"], targets[s], rel_tol=1e-9)
        assert got[d]["taken"] <= 3 * size[d] and got[d]["taken"] % max(size[d], 1) == 0
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in by_source)
    assert result(spark, "op6_mixing") == got


def plain_quality(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "base_failed": len(words) < 50 or 100 * len(hit) > 50 * len(words),
    }


def test_quality_matches_plain_python(spark, docs):
    got = result(spark, "op1_quality")
    good = {d for d, q in duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall() if q == 1}
    first = [xxhash.xxh64_intdigest(w, 42) for w in ("a", "b")]
    order = spark.sql("SELECT xxhash64('a', 'b') AS h").first()["h"] % (1 << 64)
    ab, ba = xxhash.xxh64_intdigest("b", first[0]), xxhash.xxh64_intdigest("a", first[1])
    pair = (lambda a, b: xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42))) if order == ab else (lambda a, b: xxhash.xxh64_intdigest(a, xxhash.xxh64_intdigest(b, 42)))
    assert order in (ab, ba)
    grams = {}
    for d, text, _ in docs:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        grams[d] = [xxhash.xxh64_intdigest(w, 42) % 32768 for w in words] + [pair(a, b) % 32768 for a, b in zip(words, words[1:])]
    raw, trusted = collections.Counter(), collections.Counter()
    for d, g in grams.items():
        raw.update(g)
        if d in good:
            trusted.update(g)
    n_raw, n_good = sum(raw.values()), sum(trusted.values())
    weight = [math.log((trusted[b] + 10) / n_good) - math.log((raw[b] + 10 * n_raw / n_good) / n_raw) for b in range(32768)]
    threshold = -(0.05 + 32768 / (2 * (n_good + 10 * 32768)))
    for d, text, _ in docs:
        want, row = plain_quality(text), got[d]
        assert {k: row[k] for k in want} == want
        score = sum(weight[b] for b in grams[d]) / len(grams[d]) if grams[d] else 0.0
        assert abs(row["score"] - score) < 1e-5
        if abs(score - threshold) > 1e-5:
            assert row["kept"] == (not want["base_failed"] and bool(grams[d]) and score > threshold)


def test_digest_of_no_items_is_that_of_an_empty_text(spark):
    rows = queries.QUERIES["op5_decontaminate"](spark, SF).filter("n_items = 0").select("items_sha256").distinct().collect()
    assert [r[0] for r in rows] == [hashlib.sha256(b"").hexdigest()]
