"""Ranked search in document trees against plain scoring, and odd inputs."""

import math
import re

import numpy as np
import pytest

from tallymark.llm import tree_search

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, item, k=10):
    """(score, doc_id) of the k best."""
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, n_terms, out = len(held), sum(len(t) for _, t in held), []
    for doc_id, own in held:
        m, score = 25 + 75 * len(own) * n_docs // n_terms, 0
        for t in terms(item):
            if tf := own.count(t):
                df = sum(t in other for _, other in held)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        if score > 0:
            out.append((score, doc_id))
    return sorted(out, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]


def prose(rng, n, kinds=60):
    return " ".join(f"W{int(x)}" for x in np.minimum(rng.zipf(1.4, n), kinds))


DOCS = "doc_id long, text string, rank string, score string, item_id string, n string, terms string"
ITEMS = "item_id long, text string, doc_id string, score string, rank string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "r", "s", "i", "n", "t") for i, t in rows], DOCS)


def asked(spark, rows):
    return spark.createDataFrame([(i, t, "d", "s", "r") for i, t in rows], ITEMS)


def test_odd_inputs_match_plain_scoring(spark):
    rng = np.random.default_rng(3)
    rows = [(i, prose(rng, int(rng.integers(1, 80)))) for i in range(150)]
    rows += [(3, rows[5][1])] * 30 + [(None, rows[5][1]), (None, None), (200, None), (201, ""), (202, "...!"), (203, "long text w7 " * 3_000), (204, "Ünï ß w3 ÜNÏ"), (205, rows[9][1] + " w59")]
    items = [(1, rows[5][1]), (2, "w3 w3 W9"), (3, None), (4, "--"), (None, "ünï ÜNÏ"), (6, "unknown"), (2, "w50 w51 w52 w53"), (1, rows[5][1]), (7, prose(rng, 300))]
    got = {}
    for r in tree_search.ranked(documents(spark, rows), asked(spark, items)).orderBy("rank").collect():
        got.setdefault((r["item_id"], r["item_key"]), []).append((r["score"], r["doc_id"]))
        assert len(got[r["item_id"], r["item_key"]]) == r["rank"]
    want = [plain(rows, t) for _, t in {*items}]
    assert sorted(map(repr, got.values())) == sorted(repr(w) for w in want if w)


def test_blocks_of_items_change_nothing(spark):
    rng = np.random.default_rng(4)
    docs, items = documents(spark, [(i, prose(rng, 30)) for i in range(60)]), asked(spark, [(i, prose(rng, 6)) for i in range(20)])
    one, many = (sorted(map(tuple, tree_search.ranked(docs, items, block_bytes=b).collect())) for b in (1 << 20, 600))
    assert one == many and one


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "a b")]), asked(spark, [(1, "a")])
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        out = tree_search.ranked(d, i)
        assert out.columns == ["item_id", "item_key", "rank", "doc_id", "score"] and out.count() == 0


@pytest.mark.parametrize("leaf", [1, 4, 48])
def test_tree_finds_the_best_without_scoring_all(leaf):
    rng = np.random.default_rng(8)
    n, lists = 800, []
    # Two kinds of documents that share only the commonest term.
    for i in range(n):
        lists.append(np.unique(np.r_[0, 1 + i % 2, rng.integers(3, 60, 12) + 60 * (i % 2)]))
    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    every, tfs, norms = np.concatenate(lists), rng.integers(1, 5, starts[-1]), rng.integers(25, 200, n)
    tree = tree_search.DocumentTree(list(range(n)), norms, starts, every, tfs, leaf)
    assert sorted(tree.order.tolist()) == list(range(n))
    weights = np.zeros(200, np.int64)
    weights[[1, 5, 9, 20, 31, 44]] = [300, 9000, 7000, 5000, 6000, 8000]
    best, scored = tree.search(weights, [], 10)
    plain_scores = [int((weights[x] * tree_search.share(tfs[a:b], norms[i])).sum()) for i, (x, a, b) in enumerate(zip(lists, starts, starts[1:], strict=False))]
    assert best == sorted(((s, i) for i, s in enumerate(plain_scores) if s), key=lambda x: (-x[0], x[1]))[:10]
    # No document of the other kind holds a wanted term.
    assert scored <= n / 2
