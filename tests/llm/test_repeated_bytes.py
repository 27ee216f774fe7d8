"""Repeated strings against a plain index of all windows."""

import collections
import hashlib

import numpy as np
import pytest

from tallymark.llm import queries, repeated_bytes

duckdb = pytest.importorskip("duckdb")
WIDTH = repeated_bytes.WIDTH


def plain(texts):
    """Removed runs of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + WIDTH] for b in raw for i in range(len(b) - WIDTH + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - WIDTH + 1):
            if seen[b[i : i + WIDTH]] > 1:
                gone[i : i + WIDTH] = True
        edges = np.flatnonzero(np.diff(np.r_[False, gone]))
        out.append(edges.tolist())
    return raw, out


SCHEMA = "doc_id long, text string, key string, wanted string, name string, c string, kept string"


def found(spark, rows, parts=4):
    frame = spark.createDataFrame([(i, t, "k", "w", "n", "c", "x") for i, t in rows], SCHEMA).repartition(parts)
    out = collections.defaultdict(list)
    for r in repeated_bytes.without_repeats(frame).collect():
        out[r["doc_id"]].append((r["n_bytes"], r["n_removed"], r["spans"], bytes(r["kept"])))
    return out


def check(spark, rows, parts=4):
    got, (raw, spans) = found(spark, rows, parts), plain([t for _, t in rows])
    want = collections.defaultdict(list)
    for (i, _), b, s in zip(rows, raw, spans, strict=True):
        at = [0, *s, len(b)]
        kept = b"".join(b[x:y] for x, y in zip(at[::2], at[1::2], strict=True))
        want[i].append((len(b), len(b) - len(kept), s, kept))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(1, 9)))) for _ in range(n))


@pytest.fixture(params=[4, 60])
def ranges(spark, request):
    """So many ranges of the sorted arrays, few or many rows in each."""
    held = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_planted_repeats_and_odd_texts(spark, ranges):
    rng = np.random.default_rng(11)
    base = [prose(rng, 150) for _ in range(12)]
    passage, shared = prose(rng, 90), base[3][100:500]
    rows = list(enumerate(base))
    for n in (199, 200, 201, 260, 320, 333):
        # The same string in different surroundings, at its very start and end too.
        rows += [(100 + n, prose(rng, 9) + shared[:n] + prose(rng, 30)), (1100 + n, shared[:n]), (2100 + n, prose(rng, 40) + base[5][700 - n : 700])]
    rows += [(5000 + i, prose(rng, int(rng.integers(1, 60))) + passage + prose(rng, int(rng.integers(1, 60)))) for i in range(40)]
    near = base[7]
    rows += [(6000 + i, near[: 40 * i] + "#" + near[40 * i :]) for i in range(15)]
    rows += [(None, base[0]), (None, None), (7000, None), (7001, ""), (7002, "x"), (7003, "a" * 700), (7004, "ab" * 99), (7005, "abc" * 150), (7006, base[9]), (7006, base[9]), (7007, "ß" * 90 + "ü" + "ß" * 150), (7008, base[2] + base[2])]
    check(spark, rows)


def test_few_letters(spark, ranges):
    rng = np.random.default_rng(12)
    # Long stretches without much to tell apart, with chance repeats of every length.
    rows = [(i, "".join(rng.choice(["a" * 60, "b" * 50, "ab" * 40, "aab" * 30], 12))) for i in range(25)]
    check(spark, rows, parts=7)


def test_long_texts_are_cut_at_no_loss(monkeypatch):
    rng = np.random.default_rng(13)
    texts = [prose(rng, 400).encode(), b"", b"x" * 199, prose(rng, 300).encode()]
    whole = [repeated_bytes.stretches(p) for p in repeated_bytes.pieces_of(texts)]
    cut = [repeated_bytes.stretches(p) for p in repeated_bytes.pieces_of(texts, 300)]
    starts = [sorted((i, s, t, k) for i, a, t, b, k in (z for part in x for z in zip(*(v.tolist() for v in part))) for s in range(a, b + 1)) for x in (whole, cut)]
    assert starts[0] == starts[1] and len(cut) > 5
    assert [(i, s) for i, s, _, _ in starts[0]] == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - WIDTH + 1)]
    assert all(s <= t <= s + WIDTH - repeated_bytes.KEY for _, s, t, _ in starts[0])


def test_no_documents(spark):
    assert repeated_bytes.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_matches_plain_windows(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    raw, spans = plain([t for _, t in rows])
    want = {}
    for (i, _), b, s in zip(rows, raw, spans, strict=True):
        at = [0, *s, len(b)]
        kept = b"".join(b[x:y] for x, y in zip(at[::2], at[1::2], strict=True))
        want[i] = (i, len(b), len(b) - len(kept), len(s) // 2, hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op12_repeated_bytes"](spark, sf).collect()}
    assert got == want and sum(w[2] for w in want.values())
