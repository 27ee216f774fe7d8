"""Review decisions never get lost and never come back unasked."""

from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import curation as cu

PROJECT = "bioproject string, status string, title string, submitter string, weight bigint, n_subjects bigint"
CITED = "bioproject string, doi string, reference string, verified boolean"


def test_decisions(spark):
    df = spark.createDataFrame(
        [(True, 2, False), (False, 2, True), (False, 0, True), (False, 0, False)], "m boolean, k bigint, n boolean"
    )
    got = df.select(cu.decide(F.col("m"), F.col("k"), F.col("n")).alias("s"), cu.undecided_by_silence(F.col("m"), F.col("k"), F.col("n")).alias("c")).collect()
    assert [tuple(r) for r in got] == [("unreviewed", False), ("confirmed", False), ("not_found", False), ("unreviewed", True)]


def test_overlay_never_undecides(spark):
    pair = "bioproject string, status string"
    record = spark.createDataFrame([("a", "confirmed"), ("b", "unreviewed"), ("c", "not_found"), ("d", "confirmed")], pair)
    queue = spark.createDataFrame([("a", "unreviewed"), ("b", "unreviewed"), ("c", "confirmed"), ("e", "not_found")], pair)
    assert rows(cu.overlay(record, queue)) == [
        ("a", "confirmed", "record", False), ("b", "unreviewed", "queue", False), ("c", "confirmed", "queue", True),
        ("d", "confirmed", "record", False), ("e", "not_found", "queue", True),
    ]


def test_look_ups_are_ranked_and_limited(spark):
    weights = spark.createDataFrame([("a", 5, 1), ("b", 9, 1), ("c", 9, 2), ("d", 1, 1)], "bioproject string, weight bigint, n_subjects bigint")
    index = spark.createDataFrame([("d", "confirmed"), ("z", "not_found")], "bioproject string, status string")
    kept = spark.createDataFrame([("a", "10.1/x")], "bioproject string, doi string")
    assert [r[0] for r in cu.to_look_up(weights, index, kept).collect()] == ["c", "b", "z"]
    assert [r[0] for r in cu.to_look_up(weights, index, kept, limit=1).collect()] == ["c"]


def test_merge_proposals_only_fills(spark):
    queued = spark.createDataFrame(
        [("a", "unreviewed", "", "kept", 1, 1), ("b", "confirmed", "", "", 1, 1), ("c", "unreviewed", "T", "S", 2, 1), ("x", "unreviewed", "", "", 3, 1)], PROJECT
    )
    proposed = spark.createDataFrame(
        [("a", "unreviewed", "New", "other", 1, 1), ("b", "unreviewed", "New", "New", 4, 1), ("c", "unreviewed", "U", "V", 2, 1), ("n", "unreviewed", "N", "", 1, 1)], PROJECT
    )
    assert rows(cu.merge_proposals(queued, proposed)) == [
        ("a", "unreviewed", "New", "kept", 1, 1, True),
        ("b", "confirmed", "", "", 4, 1, True),
        ("c", "unreviewed", "T", "S", 2, 1, False),
        ("n", "unreviewed", "N", "", 1, 1, True),
        ("x", "unreviewed", "", "", 3, 1, False),
    ]


def test_rejected_candidates_do_not_return(spark):
    cand = "bioproject string, doi string, reference string, starred boolean"
    queued = spark.createDataFrame([("a", "d1", "r", False)], cand)
    proposed = spark.createDataFrame([("a", "d1", "other", True), ("a", "d2", "r2", True), ("a", "d3", "r3", False), ("b", "d4", "", False)], cand)
    pair = "bioproject string, doi string"
    out = cu.merge_candidates(queued, proposed, spark.createDataFrame([("b",)], "bioproject string"), spark.createDataFrame([("a", "d3")], pair))
    assert rows(out) == [("a", "d1", "r", False, False), ("a", "d2", "r2", True, True)]


def test_reopen_needs_unseen_evidence(spark):
    pair = "bioproject string, doi string"
    settled = spark.createDataFrame([("n", "not_found"), ("c", "confirmed"), ("m", "not_found")], "bioproject string, status string")
    found = spark.createDataFrame([("n", "old"), ("n", "new"), ("n", "new"), ("c", "new"), ("m", "old")], pair)
    down = spark.createDataFrame([("n", "old"), ("m", "old")], pair)
    accepted = spark.createDataFrame([], pair)
    assert rows(cu.reopened(settled, found, accepted, down)) == [
        ("n", "new", "considered"), ("n", "new", "kept"), ("n", "old", "considered")
    ]


def test_filing_twice_keeps_what_was_learned(spark):
    record = spark.createDataFrame([("a", "d1", "fetched", True), ("a", "d0", "", False), ("k", "d9", "r", True)], CITED)
    decided = spark.createDataFrame([("a", "d1", ""), ("a", "d2", "typed")], "bioproject string, doi string, reference string")
    once = cu.file_decisions(record, decided)
    assert rows(once) == [("a", "d1", "fetched", True), ("a", "d2", "typed", False), ("k", "d9", "r", True)]
    assert rows(cu.file_decisions(once, decided)) == rows(once)


def test_verification_and_outage(spark):
    record = spark.createDataFrame([("a", "d1", "", False), ("a", "d2", "mine", False), ("b", "bad", "", False), ("b", "late", "", False), ("c", "done", "", True)], CITED)
    works = spark.createDataFrame(
        [("d1", True, None, "fetched"), ("d2", True, None, "fetched"), ("bad", False, None, None), ("late", None, "timed out", None)],
        "doi string, found boolean, error string, reference string",
    )
    out = cu.verify(record, works)
    assert rows(out, "doi", "outcome", "reference") == [("bad", "bad", ""), ("d1", "resolved", "fetched"), ("d2", "resolved", "mine"), ("late", "outage", "")]
    assert rows(cu.any_outage(out)) == [(True, 1)]
    assert rows(cu.any_outage(out.filter("outcome <> 'outage'"))) == [(False, 0)]


def test_progress_and_lines(spark):
    projects = spark.createDataFrame([("confirmed", 60, True), ("confirmed", 10, False), ("not_found", 10, False), ("unreviewed", 20, False)], "status string, weight bigint, has_doi boolean")
    assert [float(x) for x in cu.progress(projects).first()] == [2, 1, 1, 100, 80, 60]
    weights = spark.createDataFrame([("s", "a", 3), ("s", "b", 2), ("s", "c", 1)], "subject string, bioproject string, weight bigint")
    index = spark.createDataFrame([("a", "confirmed"), ("b", "not_found")], "bioproject string, status string")
    cites = spark.createDataFrame([("a", "d1", "Ref"), ("a", "d2", ""), ("b", "d3", "x")], "bioproject string, doi string, reference string")
    assert rows(cu.citation_lines(weights, index, cites), "bioproject", "doi", "line") == [
        ("a", "d1", "Ref"), ("a", "d2", "d2"), ("b", None, "no publication found"), ("c", None, "citation not yet reviewed")
    ]
