"""Documents looked up in token files, and notices among stray words."""

import math
import zlib

import numpy as np
import pytest

pytest.importorskip("duckdb")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tallymark.llm import licenses, token_files  # noqa: E402

WORD = str(public_tokenizers.path("word_bpe_49k.json"))


def test_documents_by_select_equal_the_whole_reading(spark):
    rows = [(i, " ".join(f"word{j} of {i}" for j in range(i % 9))) for i in range(300)] + [(7, "again seven"), (None, "no id"), (400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = token_files.token_blocks(docs, WORD, 2, block_ids=500).cache()
    assert blocks.count() > 3
    asked = spark.createDataFrame([(i,) for i in (0, 7, 7, 150, 299, 400, 999)] + [(None,)], "doc_id long")
    got = token_files.documents_of(blocks, asked).collect()
    assert sorted(r["doc_id"] for r in got) == [0, 7, 7, 150, 299, 400]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    want = {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_blocks(blocks).collect() if r["doc_id"] in (0, 7, 150, 299, 400)}
    assert {(r["doc_id"], r["n_tokens"], crc(r["ids"])) for r in got} == want
    assert token_files.documents_of(blocks, asked.limit(0)).count() == 0


def test_stray_rare_words_take_no_votes(spark):
    """A shortened notice keeps its label when its missing words stand elsewhere."""
    notice = "redistribution and use in source and binary forms"
    stray = "modification here permitted there without end"
    filler = [(i, "redistribution source binary forms") for i in range(10, 15)]
    texts = [(1, notice), (2, f"{stray} filler {notice} filler"), (3, stray), (4, f"{stray} source forms and binary")]
    docs = spark.createDataFrame(texts + filler, "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in licenses.scanned(docs).collect()}
    assert found == {1: "bsd", 2: "bsd", 3: "", 4: ""} | {i: "" for i, _ in filler}


def test_votes_against_plain_python(spark):
    """Labels of random texts of template words, whose whole index votes on every beginning."""
    rng = np.random.default_rng(5)
    pool = sorted({w for _, t, _ in licenses.TEMPLATES for w in t.split()}) + ["x", "y"]
    rows = []
    for i in range(200):
        _, spelled, _ = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        words = [w if rng.random() < 0.93 else "x" for w in spelled.split()]
        rows.append((i, " ".join([*rng.choice(pool, rng.integers(0, 30)), *words, *rng.choice(pool, rng.integers(0, 30))])))
    n = len(rows)
    df = {w: sum(w in t.split() for _, t in rows) for w in pool}
    idf = {w: math.log((n + 1) / (df[w] + 1)) + 1e-3 for w in pool}
    want = {}
    for i, text in rows:
        words, labels = text.split(), set()
        for phrase, label in licenses.PHRASES.items():
            if f" {phrase} " in f" {text} ":
                labels.add(label)
        for label, template, key in licenses.TEMPLATES:
            spelled, key = template.split(), key.split()
            index = sorted(set(spelled), key=lambda w: (-idf[w], w))[:6]
            shift = next(k for k in range(len(spelled)) if spelled[k : k + len(key)] == key)
            at = lambda j: words[j] if 0 <= j < len(words) else None  # noqa: B023, E731
            for off in range(-len(spelled), len(words)):
                votes = sum(any(at(off + k) == w for k, x in enumerate(spelled) if x == w) for w in index)
                if votes >= 3 and all(at(off + shift + k) == w for k, w in enumerate(key)):
                    labels.add(label)
        want[i] = ",".join(sorted(labels))
    got = {r["doc_id"]: r["labels"] for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(set(got.values())) > 8
