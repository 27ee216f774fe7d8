"""Codes by cover trees against plain Lloyd rounds, and odd vectors."""

import hashlib
import math

import numpy as np
import pytest

from tallymark.llm import cover_codes, queries

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


def plain(rows):
    """(vec_id, vector, label) -> code, error and label error of each row, and the digest of the codebooks."""
    ints = np.array([[math.floor(4096 * x) for x in v] for _, v, _ in rows], np.int64)
    first = sorted(range(len(rows)), key=lambda i: rows[i][0])[:16]
    width = ints.shape[1] // 8
    books = [ints[first, k * width : (k + 1) * width] for k in range(8)]

    def nearest(k):
        part = ints[:, k * width : (k + 1) * width]
        return part, np.array([((books[k] - p) ** 2).sum(axis=1).argmin() for p in part])

    for _ in range(6):
        for k in range(8):
            part, found = nearest(k)
            books[k] = np.array([part[found == j].sum(axis=0) // (found == j).sum() if (found == j).any() else books[k][j] for j in range(len(first))])
    errors, codes = np.zeros(len(rows), np.int64), [""] * len(rows)
    for k in range(8):
        part, found = nearest(k)
        errors += ((part - books[k][found]) ** 2).sum(axis=1)
        codes = [c + f"{j:02x}" for c, j in zip(codes, found, strict=True)]
    by_label = {}
    for (_, _, label), e in zip(rows, errors.tolist(), strict=True):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return sorted((r[0], c, e, by_label[r[2]], digest) for r, c, e in zip(rows, codes, errors.tolist(), strict=True))


def test_query_matches_plain_lloyd(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    got = queries.QUERIES["op11_vector_codes"](spark, SF)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_trees_decide_as_exact_comparison():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(size=(6000, 4)) * 300 + rng.integers(0, 6, (6000, 1)) * 2000).astype(np.int64)
    points[1000:3000] = points[0]
    tree, entries = cover_codes.CoverTree.of(points), np.concatenate((points[:12], points[3:5]))
    want = ((points[:, None, :] - entries) ** 2).sum(axis=2).argmin(axis=1)
    got = np.empty(len(points), np.int64)
    got[tree.order] = tree.codes(entries)
    assert (got == want).all()
    sums, counts = tree.sums(entries)
    assert all((sums[j] == points[want == j].sum(axis=0)).all() and counts[j] == (want == j).sum() for j in range(len(entries)))
    whole, _, leaves = tree.assigned(entries)
    # Most of the copies and clusters never come to a comparison.
    assert (tree.end - tree.start)[leaves].sum() < len(points) / 2 < (tree.end - tree.start)[whole].sum()
    again = cover_codes.CoverTree.unpacked(tree.packed())
    assert (again.codes(entries) == tree.codes(entries)).all()


def test_every_point_lies_within_its_nodes():
    points = np.random.default_rng(6).integers(-500, 500, (3000, 3))
    tree = cover_codes.CoverTree.of(points)
    for s, e, r, c, n in zip(tree.start, tree.end, tree.radius, tree.child, tree.children, strict=True):
        assert np.sqrt(((tree.points[s:e] - tree.points[s]) ** 2).sum(axis=1)).max() <= r
        if n:
            assert tree.start[c] == s and tree.end[c + n - 1] == e and (tree.radius[c : c + n] <= r / 2 + 1e-6).all()


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, vector string, part int"


def test_odd_vectors(spark):
    rng = np.random.default_rng(7)
    nan, inf = float("nan"), float("inf")
    good = [(i, rng.normal(size=16).tolist(), None if i % 3 else i % 5) for i in range(40)]
    good += [good[7], good[7], (5, good[6][1], 1)]
    bad = [(1, None, 1), (2, [], 1), (3, [1.0] * 15 + [None], 1), (4, [nan] + [0.0] * 15, 1), (5, [inf] * 16, 1), (6, [-inf] * 16, 1), (7, [0.5] * 8, 1)]
    frame = spark.createDataFrame([(*r, "c", "e", "v", 9) for r in good + bad], SCHEMA)
    codes, books = cover_codes.compressed(frame)
    assert codes.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert codes.count() == len(good) and [b.shape for b in books] == [(16, 2)] * 8
    total = {r["label"]: r["n"] for r in codes.groupBy("label").sum("error").withColumnRenamed("sum(error)", "n").collect()}
    assert all(r["label_error"] == total[r["label"]] for r in codes.collect())
    as_float = [(i, np.float32(v).tolist(), x) for i, v, x in good if True]
    distinct = [r for k, r in enumerate(as_float) if k < 40]
    few, _ = cover_codes.compressed(spark.createDataFrame([(*r, "c", "e", "v", 9) for r in distinct], SCHEMA))
    want = plain(distinct)
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in few.collect()) == [w[:4] for w in want]


def test_few_huge_and_uneven_vectors(spark):
    frame = spark.createDataFrame([(None, [1e30] * 9, 1, "", "", "", 0), (2, [-1e30] * 9, 1, "", "", "", 0), (1, [0.25] * 9, None, "", "", "", 0)], SCHEMA)
    codes, books = cover_codes.compressed(frame)
    got = {r["vec_id"]: (r["code"], r["error"]) for r in codes.collect()}
    # Three vectors are their own entries, in the order of their ids, the null id last.
    assert got == {1: ("00" * 8, 0), 2: ("01" * 8, 0), None: ("02" * 8, 0)}
    assert sum(b.shape[1] for b in books) == 9 and books[0][2].tolist() == [cover_codes.LIMIT]


def test_no_vectors(spark):
    codes, books = cover_codes.compressed(spark.createDataFrame([], SCHEMA))
    assert codes.count() == 0 and books == []
