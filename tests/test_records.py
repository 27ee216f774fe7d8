"""Verdicts, staleness, gates and change-only writing."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import gates
from tallymark.operators.records import (
    assess,
    build_records,
    corpus_summary,
    corpus_table,
    derive_state,
    exit_codes,
    file_digests,
    in_report_order,
    mark_stale,
    skip_reasons,
)
from tallymark.operators.upsert import change_only, read_current, without_failed, write_changes

SUBJECTS = [(s,) for s in ("clean", "warned", "noted", "failed", "partial", "failed-partial", "unknown", "skips")]


@pytest.fixture(scope="module")
def world(spark):
    subjects = spark.createDataFrame(SUBJECTS, "subject string").coalesce(1)
    findings = spark.createDataFrame(
        [
            ("warned", "G017", "warn"), ("warned", "R017", "info"), ("noted", "R017", "info"), ("failed", "S001", "error"),
            ("failed", "E002", "warn"), ("failed-partial", "S001", "error"), ("partial", "G010", "warn"),
            ("skips", "E001", "skipped"), ("skips", "E002", "skipped"),
        ],
        "subject string, id string, severity string",
    ).coalesce(1)
    status = spark.createDataFrame(
        [(s, "partial" if "partial" in s else "complete", "A1", ["bams"] if "partial" in s else []) for (s,) in SUBJECTS if s != "unknown"],
        "subject string, state string, accession string, missing array<string>",
    ).coalesce(1)
    files = spark.createDataFrame(
        [(s, n, f"{s} {n}") for (s,) in SUBJECTS for n in ("config.yaml", "sample_sheet.csv", "other.txt")],
        "subject string, name string, content string",
    ).coalesce(1)
    data = status.select("subject", F.struct(F.lit(True).alias("published"), "accession").alias("data"))
    return subjects, findings, status, file_digests(files), data


@pytest.fixture(scope="module")
def records(world):
    subjects, findings, status, digests, data = world
    return build_records(
        derive_state(subjects, findings, status), digests, data, status,
        checks_run=["S001", "G017", "G018", "R020", "E001", "E002", "E003"], checks_available=44,
        catalog="c1", tool_version="1", validated_at="2024-01-01T00:00:00Z",
    ).cache()


def test_states(records):
    assert rows(records, "subject", "state") == [
        ("clean", "PASS"), ("failed", "FAIL"), ("failed-partial", "FAIL"), ("noted", "PASS WITH NOTES"),
        ("partial", "PENDING"), ("skips", "PASS"), ("unknown", "PENDING"), ("warned", "PASS WITH WARNINGS"),
    ]
    r = records.filter("subject = 'clean'").first()
    assert sorted(r.inputs) == ["config.yaml", "sample_sheet.csv"] and r.is_partial


def reasons(world, records, digests=None, **kw):
    out = assess(world[0], records, digests if digests is not None else world[3], **kw)
    return {r.subject: r.reason for r in out.collect()}


def test_first_reason_wins(spark, world, records):
    got = reasons(world, records, catalog="c1")
    assert got["clean"] is None and got["noted"] is None
    assert got["failed"] == "last validation was FAIL"
    assert got["warned"] == "last validation raised warnings"
    assert reasons(world, records.filter("subject <> 'clean'"))["clean"] == "no previous report"
    assert reasons(world, records, catalog="c2")["failed"] == "the check catalog changed"
    # One input changed, one removed, one added.
    digests = (
        world[3].filter("NOT (subject = 'clean' AND name = 'config.yaml')")
        .withColumn("digest", F.when(F.expr("subject = 'failed' AND name = 'config.yaml'"), "new").otherwise(F.col("digest")))
        .unionByName(spark.createDataFrame([("noted", "README.txt", "d")], "subject string, name string, digest string"))
    )
    got = reasons(world, records, digests, catalog="c2")
    assert got["clean"] == got["failed"] == "config.yaml changed since validation"
    assert got["noted"] == "README.txt changed since validation"
    assert got["warned"] == "the check catalog changed"


def test_data_reasons(world, records):
    moved = world[4].withColumn("data", F.struct(F.lit(True).alias("published"), F.lit("A9").alias("accession")))
    assert reasons(world, records, data=moved)["clean"] == "published data changed since validation"
    assert reasons(world, records, data=world[4])["clean"] is None
    unpublished = records.withColumn("data", F.struct(F.lit(False).alias("published"), F.lit("A1").alias("accession")))
    published = world[2].select("accession")
    assert reasons(world, unpublished, published=published)["clean"] == "data has been published since validation"
    assert reasons(world, records, published=published)["clean"] is None


def test_stamping_keeps_the_first_verdict(spark, world, records):
    why = spark.createDataFrame(
        [("clean", "config.yaml changed since validation"), ("failed", "the check catalog changed"), ("warned", None)],
        "subject string, reason string",
    )
    once = mark_stale(records, why)
    again = mark_stale(once, spark.createDataFrame([("clean", "README.txt changed since validation")], "subject string, reason string"))
    for df in (once, again):
        got = {r.subject: r for r in df.collect()}
        assert (got["clean"].state, got["clean"].superseded.state) == ("STALE", "PASS")
        assert got["clean"].stale_reason == "config.yaml changed since validation"
        assert got["failed"].state == "FAIL" and got["failed"].superseded is None
    assert reasons(world, once)["clean"] == "last validation was STALE"


def test_gates(spark, world, records):
    subjects, findings, _, digests, _ = world
    moved = spark.createDataFrame([("clean", "A2"), ("noted", "A1")], "subject string, harvested_accession string")
    kept = records.filter("subject <> 'noted'")
    got = {r.subject: r for r in gates.evaluate(subjects, kept, findings, digests, moved).collect()}
    codes = lambda s: [(b.code, b.detail) for b in got[s].blockers]
    assert codes("noted") == [("no_record", "no validation record")]
    assert (got["noted"].cited, got["noted"].provenance) == (False, "missing")
    assert codes("clean") == [("accession_moved", "harvested A2, validated A1")]
    assert (got["clean"].mode, got["clean"].cited, got["clean"].provenance) == ("truncated", True, None)
    assert codes("failed") == [("validation_errors", "S001")] and got["failed"].provenance == "wrong"
    assert codes("failed-partial") == [("incomplete_upload", "missing bams"), ("validation_errors", "S001")]
    assert codes("unknown") == [("incomplete_upload", "missing unknown")]
    assert codes("warned") == [] and got["warned"].mode == "full" and got["warned"].provenance == "missing"
    assert {g.check: g.outcome for g in got["skips"].gating} == {
        "G017": "passed", "G018": "passed", "R020": "passed", "E001": "skipped", "E002": "skipped", "E003": "passed"
    }
    assert got["skips"].provenance == "missing"
    report = rows(gates.gate_report(gates.evaluate(subjects, kept, findings, digests, moved)))
    assert ("blocked", "missing", 2) in report and ("truncated", "no_record", 1) in report


def test_unrun_checks_are_unknown(spark):
    ran = spark.createDataFrame([("s", ["G017"])], "subject string, checks_run array<string>")
    none = spark.createDataFrame([], "subject string, id string, severity string")
    gating = gates.gate_outcomes(ran, none).first().gating
    assert [g.outcome for g in gating] == ["passed"] + ["not_run"] * 5


def test_changed_inputs_and_stale_block(world, records, spark):
    subjects, findings, _, digests, _ = world
    why = spark.createDataFrame([("clean", "config.yaml changed since validation")], "subject string, reason string")
    none = spark.createDataFrame([], "subject string, harvested_accession string")
    changed = digests.filter("name <> 'config.yaml'")
    got = {r.subject: r for r in gates.evaluate(subjects, mark_stale(records, why), findings, changed, none).collect()}
    assert [b.code for b in got["clean"].blockers] == ["stale_record", "inputs_changed"]
    assert got["clean"].leading == "stale_record"


def test_report_tables(spark, records):
    summary = {r.state: (r.n, r.latest) for r in corpus_summary(records).collect()}
    assert summary["PASS"] == (2, "2024-01-01T00:00:00Z") and summary["STALE"][0] == 0 and len(summary) == 6
    assert rows(corpus_table(records).filter("subject = 'failed'"), "n_error", "n_warn") == [(1, 1)]
    found = spark.createDataFrame(
        [("b", "Z2", "info", None), ("a", "Z2", "warn", None), ("a", "Z1", "warn", None), ("a", "Z9", "error", None), ("a", "Z3", "skipped", None), ("a", "Z4", "skipped", "needs x"), ("a", "Z5", "skipped", "needs x")],
        "subject string, id string, severity string, detail string",
    )
    assert [r.id for r in in_report_order(found).collect()] == ["Z9", "Z1", "Z2", "Z3", "Z4", "Z5", "Z2"]
    assert [tuple(r) for r in skip_reasons(found, ["subject"]).collect()] == [("a", "needs x", 2), ("a", "unavailable", 1)]
    assert rows(exit_codes(found)) == [(1, 1)]
    assert rows(exit_codes(found.filter("severity = 'warn'"))) == [(0, 1)]
    assert rows(exit_codes(found.filter("severity = 'none'"))) == [(0, 0)]


# -- change-only writing ----------------------------------------------------

SCHEMA = "k string, v int, m map<string,string>, stamp string"


def test_change_only_and_run_twice(spark, tmp_path):
    old = spark.createDataFrame(
        [("same", 1, {"a": "1", "b": "2"}, "t0"), ("moved", 1, {}, "t0"), ("gone", 1, {}, "t0"), ("nulls", None, None, "t0")], SCHEMA
    ).coalesce(1)
    new = spark.createDataFrame(
        [("same", 1, {"b": "2", "a": "1"}, "t1"), ("moved", 2, {}, "t1"), ("fresh", 1, {}, "t1"), ("nulls", None, None, "t1")], SCHEMA
    ).coalesce(1)
    out = change_only(old, new, ["k"], ["stamp"])
    assert rows(out, "k", "outcome", "v", "stamp") == [
        ("fresh", "new", 1, "t1"), ("gone", "kept", 1, "t0"), ("moved", "changed", 2, "t1"),
        ("nulls", "unchanged", None, "t0"), ("same", "unchanged", 1, "t0"),
    ]
    root = str(tmp_path / "r")
    empty = spark.createDataFrame([], SCHEMA)
    write_changes(change_only(empty, old, ["k"], ["stamp"]), root, 0, ["k"])
    current = lambda: read_current(spark, root, ["k"], empty.schema)
    for _ in range(2):  # a repeated attempt leaves the same result
        write_changes(change_only(read_current(spark, root, ["k"], empty.schema, before=1), new, ["k"], ["stamp"]), root, 1, ["k"])
    assert rows(spark.read.parquet(f"{root}/batch=1"), "k") == [("fresh",), ("moved",)]
    assert rows(current(), "k", "v", "stamp") == [
        ("fresh", 1, "t1"), ("gone", 1, "t0"), ("moved", 2, "t1"), ("nulls", None, "t0"), ("same", 1, "t0")
    ]
    later = new.withColumn("stamp", F.lit("t2"))
    assert change_only(current(), later, ["k"], ["stamp"]).filter("outcome IN ('new', 'changed')").isEmpty()


def test_failed_keys_keep_their_old_row(spark):
    old = spark.createDataFrame([("a", 1, {}, "t0")], SCHEMA)
    new = spark.createDataFrame([("a", None, {}, "t1"), ("b", 1, {}, "t1")], SCHEMA)
    failed = spark.createDataFrame([("a",), ("a",)], "k string")
    out = change_only(old, without_failed(new, failed, ["k"]), ["k"], ["stamp"])
    assert rows(out, "k", "outcome", "v") == [("a", "kept", 1), ("b", "new", 1)]
