"""Training of the language model with the production parameters."""

import collections
import math
import zlib

import numpy as np
import pytest

pytest.importorskip("duckdb")

from tallymark.llm import lm_score  # noqa: E402


def test_rounds_take_every_place_once():
    ids = np.random.default_rng(1).integers(0, 1024, 20_000).astype(np.int32)
    taken = np.concatenate([lm_score.masked_places(ids, number, lm_score.MASKED) for number in range(lm_score.ROUNDS)])
    assert sorted(taken.tolist()) == list(range(len(ids)))


def test_production_model_gains_on_held_out_texts(spark):
    rng = np.random.default_rng(2)
    nouns, verbs = [f"n{i}" for i in range(20)], [f"v{i}" for i in range(20)]

    def sentence():
        return " ".join(f"the {rng.choice(nouns)} {rng.choice(verbs)}" for _ in range(30))

    train = spark.createDataFrame([(i, sentence()) for i in range(2000)], "doc_id long, text string")
    held = spark.createDataFrame([(i, sentence()) for i in range(20)], "doc_id long, text string")
    known = lm_score.vocabulary(train)
    rows = lm_score.as_ids(held, known)
    learnt, first = (
        {r["doc_id"]: r["mean_score"] for r in lm_score.scored(rows, known, vector).collect()}
        for vector in (lm_score.trained(lm_score.as_ids(train, known), known), lm_score.initial(lm_score.Shape(), known.counts))
    )
    assert all(learnt[i] > first[i] + 0.3 for i in range(20))


def test_scores_against_plain_python(spark):
    """Every word's probability anew, with a few common words, so that most shares come from the table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, " \n"), (-3, "one"), (-3, "unseen Unseen the"), (None, "ünï the")], docs.schema))
    shape = lm_score.Shape(words=96, hashed=32)
    known = lm_score.vocabulary(docs, shape=shape, common=300)
    unseen = spark.createDataFrame([(-9, "neverseenbefore the")], docs.schema)
    rows = lm_score.as_ids(docs.unionByName(unseen), known, shape=shape)
    vector = lm_score.trained(rows, known, shape)
    every = collections.Counter(w for r in docs.collect() for w in (r["text"] or "").encode().lower().split())
    assert every == {bytes(r["word"]): r["n"] for r in known.table.collect()}
    own = {w.encode(): i for i, w in enumerate(known.words)}
    assert sorted(own, key=own.get) == sorted(every, key=lambda w: (-every[w], w))[:96]
    bucket = lambda w: shape.words + zlib.crc32(w) % shape.hashed
    total, kinds = collections.Counter(), collections.Counter()
    for w, n in every.items():
        total[bucket(w)] += n * (w not in own)
        kinds[bucket(w)] += w not in own
    parts = shape.views(vector.astype(np.float32).astype(float))
    want = []
    for r in [*docs.collect(), *unseen.collect()]:
        words = (r["text"] or "").encode().lower().split()
        ids = [own.get(w, bucket(w)) for w in words]
        around = [shape.edge] * 2 + ids + [shape.edge] * 2
        score = 0.0
        for i, (w, x) in enumerate(zip(words, ids, strict=True)):
            near = np.concatenate([parts["embed"][around[i + k]] for k in (0, 1, 3, 4)])
            hidden = np.tanh(near @ parts["mix"] + parts["mix_bias"])
            c, m = divmod(x, lm_score.CLASS)
            for logits, k in ((hidden @ parts["classes"] + parts["class_bias"], c), (hidden @ parts["members"][c] + parts["member_bias"][c], m)):
                score += logits[k] - np.log(np.exp(logits).sum())
            if w not in own:
                score += math.log((every[w] + 1) / (total[x] + kinds[x] + 1))
        want.append((str(r["doc_id"]), len(words), score))
    got = [(str(r["doc_id"]), r["n_words"], r["score"]) for r in lm_score.scored(rows, known, vector, shape).collect()]
    assert len(got) == len(want)
    for x, y in zip(sorted(got), sorted(want), strict=True):
        assert x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-4 * (x[1] + 1)


def test_words_of_the_corpus_score_above_gibberish(spark):
    """A rare word's share of its bucket counts: words that occur score above words that never did."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j * 13) % 3000}" for j in range(60))) for i in range(1000)], "doc_id long, text string")
    known = lm_score.vocabulary(docs)
    texts = [" ".join(f"w{2990 - i - j}" for j in range(20)) for i in range(5)] + [" ".join(f"zz{i}x{j}" for j in range(20)) for i in range(5)]
    rows = lm_score.as_ids(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), known)
    score = {r["doc_id"]: r["mean_score"] for r in lm_score.scored(rows, known, lm_score.initial(lm_score.Shape(), known.counts)).collect()}
    assert min(score[i] for i in range(5)) > max(score[i] for i in range(5, 10)) + 0.5
