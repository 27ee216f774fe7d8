"""Operators against plain Python, including groups that hold most rows."""

import hashlib
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import lookup, ranking, reconcile, rollup


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in group 0, many repeated values, one outlier."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        g = 0 if i % 3 == 0 else rng.randrange(1, 40)
        data.append((g, i, rng.choice([1.5, 2.0, 7.25]) if i % 2 else rng.random() * 100, f"m{rng.randrange(400)}"))
    data.append((0, 3000, 1e12, "m-out"))
    return data, spark.createDataFrame(data, "g int, pos int, v double, name string").coalesce(2).cache()


def groups(data, key, value):
    out = {}
    for r in data:
        out.setdefault(r[key], []).append(r[value])
    return out


def test_first_n_and_described(skewed):
    data, df = skewed
    got = {r.g: (r.n, r.head) for r in ranking.described(df, ["g"], "name").collect()}
    for g, names in groups(data, 0, 3).items():
        distinct = sorted(set(names))
        assert got[g] == (len(distinct), distinct[:5])


def test_numbered_in_small_stretches(skewed):
    data, df = skewed
    out = ranking.numbered(df, ["g"], [F.floor(F.col("pos") / 64)], ["pos"])
    got = {(r.g, r.pos): r.seq for r in out.collect()}
    for g, places in groups(data, 0, 1).items():
        for seq, pos in enumerate(sorted(places), 1):
            assert got[(g, pos)] == seq


@pytest.mark.parametrize("stretch", [1, 16, 65536])
def test_segments_cross_stretches(skewed, stretch):
    data, df = skewed
    out = ranking.segment_by_marker(df, ["g"], "pos", F.col("pos") % 37 == 5, stretch=stretch)
    got = {(r.g, r.pos): r.block for r in out.collect()}
    for g, places in groups(data, 0, 1).items():
        block = None
        for pos in sorted(places):
            block = pos if pos % 37 == 5 else block
            assert got[(g, pos)] == block


def test_edges_per_key(skewed):
    data, df = skewed
    last = {r.g: r.pos for r in ranking.last_per_key(df, ["g"], ["pos"]).collect()}
    first = {r.g: r.pos for r in ranking.first_per_key(df, ["g"], ["pos"]).collect()}
    for g, places in groups(data, 0, 1).items():
        assert (first[g], last[g]) == (min(places), max(places))


def test_later_occurrences(skewed):
    data, df = skewed
    got = sorted(r.pos for r in ranking.later_occurrences(df, ["g", "name"], ["pos"]).collect())
    seen, want = set(), []
    for g, pos, _, name in data:
        if (g, name) in seen:
            want.append(pos)
        seen.add((g, name))
    assert got == sorted(want)


def test_stable_sample(skewed):
    data, df = skewed
    one = rows(ranking.stable_sample(df, ["g"], "name", 3, "s"))
    two = rows(ranking.stable_sample(df.repartition(7), ["g"], "name", 3, "s"))
    assert one == two
    for g, names in groups(data, 0, 3).items():
        mine = [r for r in one if r[0] == g]
        assert len(mine) == min(3, len(set(names)))
        assert [r[1] for r in mine if r[2] == 1] == [min(names)]


@pytest.mark.parametrize("weights", [[5, 3, 1, 1], [1] * 400, [0, 0], [10**9, 1, 1], [7]])
def test_milestones(spark, weights):
    df = spark.createDataFrame([(w,) for w in weights], "w bigint")
    got = {r.target: r["items"] for r in ranking.milestones(df, "w").collect()}
    total, running, want = sum(weights), 0, {}
    for i, w in enumerate(sorted(weights, reverse=True), 1):
        running += w
        for t in (50, 75, 90):
            if total and t not in want and running >= total * t / 100:
                want[t] = i
    assert got == want


@pytest.mark.parametrize("cells, per_cell", [(65536, 4_000_000), (4, 3), (64, 1)])
def test_quantiles_match_linear_interpolation(skewed, cells, per_cell):
    data, df = skewed
    got = {r.g: r for r in rollup.quantiles(df, ["g"], "v", cells=cells, per_cell=per_cell).collect()}
    for g, values in groups(data, 0, 2).items():
        values = sorted(values)
        for name, f in (("q0", 0), ("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("q100", 1)):
            p = f * (len(values) - 1)
            lo = int(p)
            hi = min(lo + 1, len(values) - 1)
            assert got[g][name] == pytest.approx(values[lo] + (values[hi] - values[lo]) * (p - lo), rel=1e-12)
        assert got[g].n == len(values)


def test_quantiles_of_odd_values(spark):
    df = spark.createDataFrame(
        [("a", math.nan), ("a", 2.0), ("b", math.inf), ("b", 1.0), ("b", 3.0), ("c", None)], "g string, v double"
    )
    got = {r.g: (r.n, r.q0, r.q50, r.q100) for r in rollup.quantiles(df, ["g"], "v").collect()}
    assert got == {"a": (1, 2.0, 2.0, 2.0), "b": (3, 1.0, 3.0, math.inf)}


def test_histogram_trims_edges_and_keeps_inner_zeros(spark):
    df = spark.createDataFrame([("s", v) for v in (6.0, 7.0, 14.0, 31.0, 5.0, -1.0)], "s string, v double")
    got = [(r.low, r.n, r.bar) for r in rollup.histogram(df, ["s"], "v").orderBy("bucket").collect()]
    assert got == [(5.0, 3, 30), (10.0, 1, 10), (15.0, 0, 0), (20.0, 0, 0), (30.0, 1, 10)]


def test_fingerprint_small_and_large_subjects(skewed):
    data, df = skewed
    members = df.select("g", F.concat_ws(":", "name", "pos").alias("item"))
    tree = lambda d: {r.g: (r["count"], r.digest) for r in rollup.set_fingerprint(d, ["g"], "item").collect()}
    digest = lambda lines: "sha256:" + hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()
    found = tree(members)
    for g, names in groups([(r[0], f"{r[3]}:{r[1]}") for r in data], 0, 1).items():
        parts = {}
        for name in set(names):
            parts.setdefault(hashlib.sha256(name.encode()).hexdigest()[:4], []).append(f"{name}\t{names.count(name)}")
        assert found[g] == (len(names), digest(f"{part}:{digest(lines)}" for part, lines in parts.items()))
    assert found == tree(members.repartition(5))
    assert tree(members.filter("item <> 'm-out:3000'"))[0] != found[0]


def test_fingerprint_of_a_large_subject_is_defined_the_same_way(spark):
    big = spark.range(120_000).select(F.when(F.col("id") < 110_000, "big").otherwise("small").alias("g"), F.col("id").cast("string").alias("item"))
    copies = big.unionByName(spark.range(60_000).select(F.lit("big").alias("g"), F.lit("same").alias("item")))
    tree = lambda d: {r.g: (r["count"], r.digest) for r in rollup.set_fingerprint(d, ["g"], "item").collect()}
    found = tree(copies)
    assert found["big"][0] == 170_000 and found["small"] == tree(copies.filter("g = 'small'"))["small"]
    assert found == tree(copies.repartition(3, "item"))


def test_missing_share_warns_strictly_above(spark):
    wanted = spark.createDataFrame([("a", "x", 99), ("a", "y", 1), ("b", "x", 50), ("b", "y", 50), ("c", "x", 1)], "s string, k string, w bigint")
    have = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "s string, k string")
    got = {r.s: (r.n_missing, r.severity, r.largest[0]["key"]) for r in rollup.missing_share(wanted, have, ["s"], "k", "w").collect()}
    assert got == {"a": (1, "info", "y"), "b": (1, "warn", "y")}


def test_extremes_prefer_the_smallest_name(spark):
    df = spark.createDataFrame([("s", "b", 1.0), ("s", "a", 1.0), ("s", "d", 9.0), ("s", "c", 9.0)], "s string, n string, v double")
    r = rollup.extremes(df, ["s"], "n", "v").first()
    assert (r.low_name, r.high_name) == ("a", "c")


def test_counts_with_zeros_and_constants(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2)], "k string, v int")
    assert rows(rollup.counts_with_zeros(df, "k", ("x", "z")), "k", "n") == [("x", 2), ("z", 0)]
    assert rows(rollup.constant_column(df, ["k"], "v")) == [("x", 1, 1), ("y", 1, 2)]


def test_metrics_are_typed_and_merged(spark):
    qc = spark.createDataFrame([("s1", "15.5", "3000000000"), ("s2", "n/a", "7.5")], "sample string, depth string, reads string")
    het = spark.createDataFrame([("s1", "0.7"), ("s3", "0.1")], "sample string, F string")
    long = [
        rollup.long_metrics(qc, ["sample"], {"depth": ("mean_depth", "double"), "reads": ("total_reads", "bigint")}),
        rollup.long_metrics(het, ["sample"], {"F": ("f_inbreeding", "double")}),
    ]
    got = rows(rollup.merge_metrics(long, ["sample"], ["mean_depth", "total_reads", "f_inbreeding"]))
    assert got == [("s1", 15.5, 3e9, 0.7), ("s3", None, None, 0.1)]


def test_reconcile_sets(skewed, spark):
    data, df = skewed
    left, right = df.filter("pos % 2 = 0"), df.filter("pos % 5 < 3")
    got = {r.g: r for r in reconcile.reconcile_sets(left, right, ["g"], "name").collect()}
    a = groups([(r[0], r[3]) for r in data if r[1] % 2 == 0], 0, 1)
    b = groups([(r[0], r[3]) for r in data if r[1] % 5 < 3], 0, 1)
    for g in set(a) | set(b):
        x, y = set(a.get(g, ())), set(b.get(g, ()))
        assert got[g].n_left == len(x) and got[g].n_right == len(y)
        only = sorted(x - y)
        more = f" (+{len(only) - 5} more)" if len(only) > 5 else ""
        assert got[g].only_left == ", ".join(only[:5]) + more
    assert reconcile.reconcile_sets(left, left, ["g"], "name").isEmpty()


def test_sequences(spark):
    data = [
        ("same", "a", 1, "x", "1"), ("same", "b", 1, "x", "1"),
        ("rows", "a", 1, "x", "1"), ("rows", "b", 1, "x", "2"),
        ("keys", "a", 1, "x", "1"), ("keys", "b", 1, "y", "1"),
        ("more", "a", 1, "x", "1"), ("more", "a", 2, "x", "1"), ("more", "b", 1, "x", "1"),
    ]
    df = spark.createDataFrame(data, "s string, side string, seq int, k string, v string")
    got = rows(reconcile.sequences_differ(df, ["s"], "side", ("a", "b"), "seq", ["k", "v"], "k"))
    assert got == [("keys", "different keys"), ("more", "same keys"), ("rows", "same keys"), ("same", "same")]


def test_map_differences_treat_null_as_unknown(spark):
    left = spark.createDataFrame([("s", "a", 1), ("s", "b", 2), ("s", "c", 3)], "s string, k string, v bigint")
    right = spark.createDataFrame([("s", "a", None), ("s", "b", 9), ("s", "d", 4)], "s string, k string, v bigint")
    r = reconcile.map_differences(left, right, ["s"], "k", "v").first()
    assert (r.only_left_names, r.only_right_names, r.value_names) == ("c", "d", "b")
    unknown = spark.createDataFrame([("s", "a", None), ("s", "b", 2), ("s", "c", None)], "s string, k string, v bigint")
    assert reconcile.map_differences(left, unknown, ["s"], "k", "v").isEmpty()


def test_unlike_first(spark):
    data = [("s", m, k) for m, ks in {"a": "xy", "b": "yx", "c": "x", "d": "xyz", "e": "xz"}.items() for k in ks]
    got = rows(reconcile.unlike_first(spark.createDataFrame(data, "s string, m string, k string"), ["s"], "m", ["k"]))
    assert [(m, d) for _, m, d in got] == [("a", False), ("b", False), ("c", True), ("d", True), ("e", True)]


def test_set_equals_and_two_sided(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 2), ("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert rows(reconcile.set_equals(left, right, ["k"], "v")) == [("a", True), ("b", False)]
    l2 = spark.createDataFrame([("a", "t"), ("b", "t"), ("c", "t")], "k string, a string")
    r2 = spark.createDataFrame([("a", "t"), ("b", "u"), ("d", "t")], "k string, b string")
    assert rows(reconcile.two_sided(l2, r2, ["k"], "a", "b"), "k", "side") == [
        ("a", "same"), ("b", "differ"), ("c", "left only"), ("d", "right only")
    ]


def test_schemes(spark):
    schemes = spark.createDataFrame(
        [("gb", "CM1"), ("gb", "CM2"), ("rs", "NC1"), ("rs", "NC2"), ("nm", "1"), ("nm", "CM1")], "scheme string, k string"
    )
    seen = spark.createDataFrame(
        [("s", "NC1"), ("s", "NC2"), ("s", "CM2"), ("s", "??"), ("tie", "CM1"), ("none", "??")], "s string, k string"
    )
    order = ("gb", "rs", "nm")
    named = lookup.named_schemes(seen, schemes, ["s"], "k")
    best = lookup.best_scheme(named, ["s"], order)
    assert rows(best) == [("none", "gb", 1, 0), ("s", "rs", 4, 2), ("tie", "gb", 1, 1)]
    strays = lookup.scheme_strays(named, best, ["s"], "k", order)
    assert rows(strays) == [("none", "??", None), ("s", "??", None), ("s", "CM2", "gb")]


def test_lookups(spark):
    runs = spark.createDataFrame([("R1", "X1"), ("R2", "X1"), ("X9", "X8")], "run string, experiment string")
    wanted = spark.createDataFrame([("R1",), ("X1",), ("X9",), ("nope",), (None,)], "input string")
    got = rows(lookup.resolve_runs(wanted, runs, "input"), "input", "run", "path")
    assert got == [("R1", "R1", "run"), ("X1", "R1", "experiment"), ("X1", "R2", "experiment"), ("X9", "X9", "run")]

    subjects = spark.createDataFrame([("a", "sus-scrofa"), ("b", "fringilla-coelebs"), ("c", "two"), ("d", "gone")], "subject string, slug string")
    authority = spark.createDataFrame(
        [("sus-scrofa", "sus-scrofa", "A1"), ("sus-scrofa-x", "sus-scrofa", "A2"), ("fringilla-coelebs-palmae", "fringilla-coelebs", "A3"),
         ("two-a", "two", "A4"), ("two-b", "two", "A5")],
        "slug string, binomial string, accession string",
    )
    assert rows(lookup.authority_entry(subjects, authority), "subject", "accession") == [("a", "A1"), ("b", "A3")]

    declared = spark.createDataFrame([("s", "GCF_000000001.1"), ("t", "GCA_000000002.1"), ("u", None)], "subject string, declared string")
    published = spark.createDataFrame([("GCA_000000001.1",)], "accession string")
    assert rows(lookup.resolve_published(declared, published), "subject", "accession") == [
        ("s", "GCA_000000001.1"), ("t", None), ("u", None)
    ]


def test_contained_words_against_all_pairs(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    passages = [(i, rng.sample(vocab, rng.randrange(1, 4))) for i in range(40)] + [(99, [])]
    # A third of the texts are copies of one.
    texts = [(i, ["w0", "w1", "w2", "w3"] if i % 3 == 0 else rng.sample(vocab, rng.randrange(0, 12))) for i in range(90)]
    got = rows(
        lookup.contained_words(
            spark.createDataFrame(passages, "p int, words array<string>"), spark.createDataFrame(texts, "t int, words array<string>"), "p", "t"
        ),
        "p", "t",
    )
    assert got == sorted(((p, t) for p, a in passages for t, b in texts if a and set(a) <= set(b)), key=repr)


def test_project_weight_counts_a_sample_once_per_subject(spark):
    used = spark.createDataFrame([("P1", "s", "a"), ("P1", "s", "a"), ("P1", "t", "a"), ("P2", "s", "b")], "p string, s string, x string")
    named = spark.createDataFrame([("P1", "u"), ("P3", "s")], "p string, s string")
    assert rows(rollup.project_weights(used, named, "p", "s", "x")) == [("P1", 2, 3), ("P2", 1, 1), ("P3", 0, 1)]
