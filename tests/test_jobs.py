"""The three jobs end to end on the hand-written corpus."""

import pytest
from conftest import rows
from corpus_data import A1, BAD, GOOD, NEW, read_corpus, write_corpus
from pyspark.sql import functions as F

from tallymark.operators import curation as cu
from tallymark.operators.lookup import resolve_targets
from tallymark.operators.records import file_digests
from tallymark.operators.upsert import change_report
from tallymark.plans import curate, harvest, validation
from tallymark.sources.metadata import subjects_from_files


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs"))
    write_corpus(spark, path)
    return path


def digests(spark, text="x"):
    files = spark.createDataFrame([(s, "config.yaml", text) for s in (GOOD, BAD, NEW)], "subject string, name string, content string")
    return file_digests(files.coalesce(1))


def test_validation_twice(spark, root):
    d = digests(spark)
    go = lambda at: validation.run(read_corpus(spark, root), d, validated_at=at, tool_version="1", only=["R01", "G"])
    first, corpus = go("t1"), read_corpus(spark, root)
    records = first.records.cache()
    assert rows(records, "subject", "state") == [(BAD, "FAIL"), (GOOD, "PASS"), (NEW, "PENDING")]
    data = {r.subject: r.data for r in records.collect()}
    assert data[GOOD].published and data[GOOD].accession == A1 and data[GOOD].bams["count"] == 2
    assert [o.name for o in data[GOOD].objects] == ["raw.vcf.gz", "raw.vcf.gz.tbi"]
    again = validation.outcomes(records, go("t2").records)
    assert rows(again, "outcome", "validated_at") == [("unchanged", "t1")] * 3
    report = change_report(again).first()
    assert (report.unchanged, report.would_change) == (3, False)
    # The full catalogue has another digest, so every record is due again.
    assert {r.reason for r in validation.stale(corpus, records, d).collect()} == {"the check catalog changed"}
    moved = validation.stale(corpus, records, digests(spark, "y"))
    assert {r.reason for r in moved.collect()} == {"config.yaml changed since validation"}
    harvested = spark.createDataFrame([(GOOD, A1)], "subject string, harvested_accession string")
    verdicts = {r.subject: r for r in validation.verdicts(corpus, first, d, harvested).collect()}
    assert (verdicts[GOOD].mode, verdicts[GOOD].cited) == ("full", False)
    assert (verdicts[BAD].leading, verdicts[NEW].leading) == ("incomplete_upload", "no_data")


def lines(spark, text):
    data = [(GOOD, i, v) for i, v in enumerate(text.split("\n"), 1)]
    return spark.createDataFrame(data, "subject string, line int, value string").coalesce(1)


def test_harvest(spark, root):
    corpus = read_corpus(spark, root)
    tables = harvest.sample_rows(
        {
            "qc_report": lines(spark, "sample\tmean_depth\ttotal_reads\tunused\nS1\t15.99\t3000000000\t1\nS2\t4\tx\t2"),
            "imiss": lines(spark, "INDV\tN_DATA\tF_MISS\tN_MISS\nS1\t943\t0.1\t5\nS2\t943\t0.2\t6.5"),
        }
    )
    long = harvest.metrics(tables).cache()
    wide = {r["sample"]: r for r in harvest.wide_metrics(long).collect()}
    assert (wide["S1"].mean_depth, wide["S1"].total_reads, wide["S1"].f_missing, wide["S1"].n_missing) == (15.99, 3e9, 0.1, 5.0)
    assert (wide["S2"].total_reads, wide["S2"].n_missing, wide["S2"].f_inbreeding) == (None, None, None)
    sites = harvest.cohort_sites(tables["imiss"])
    assert rows(sites, "n_sites") == [(943,)]
    assert rows(harvest.depth_extremes(long), "low_name", "high_name") == [("S2", "S1")]
    assert rows(harvest.depth_histogram(long), "low", "n") == [(0.0, 1), (10.0, 0), (15.0, 1), (5.0, 0)]
    assert ("mean_depth", 9.995) in [(r[0], round(r[1], 6)) for r in rows(harvest.summaries(long), "metric", "q50")]
    records = harvest.datasets(corpus, sites.select("subject", "n_sites"), "t", "1").cache()
    good = records.filter(F.col("subject") == GOOD).first()
    assert (good.published, good.objects.size_bams, good.objects.count_vcfs, good.objects.count_all) == (True, 40, 2, 8)
    assert (good.vcf.callers, good.vcf.tool_versions, good.vcf.ploidy, good.cohort.n_sites) == (["gatk"], {"gatk": "4.6.2.0"}, "2", 943)
    assert good.assembly.tax_id == 11
    assert rows(harvest.deviations(corpus, records)) == [(BAD, "accession", "GCF_000000002.1")]
    assert rows(corpus.disagreements) == []


def test_curation(spark, root):
    weights = curate.survey(read_corpus(spark, root)).cache()
    assert rows(weights) == [("PRJNA1", 2, 1), ("PRJNA20", 1, 1), ("PRJNA7", 2, 1), ("PRJNA8", 0, 1)]
    index = spark.createDataFrame([("PRJNA1", "confirmed"), ("PRJNA7", "not_found"), ("PRJNA20", "not_found")], "bioproject string, status string")
    record = spark.createDataFrame(
        [("PRJNA1", "d1", "R", True, "kept"), ("PRJNA7", "old", "", False, "rejected"), ("PRJNA20", "seen", "", False, "rejected")],
        "bioproject string, doi string, reference string, verified boolean, role string",
    )
    no_queue = spark.createDataFrame([], "bioproject string, doi string")
    wanted = cu.to_look_up(weights, index, no_queue)
    assert [r.bioproject for r in wanted.collect()] == ["PRJNA7", "PRJNA20", "PRJNA8"]
    summaries = spark.createDataFrame([("PRJNA7", "T", "Helsinki Lab"), ("PRJNA8", "U", "")], "bioproject string, title string, submitter string")
    candidates = spark.createDataFrame(
        [
            ("PRJNA7", 0, "old", "r0", []), ("PRJNA7", 1, "new", "r1", ["x"]), ("PRJNA7", 2, "star", "r2", ["University of Helsinki"]),
            ("PRJNA20", 0, "seen", "r", []), ("PRJNA8", 0, "n8", "r8", []), ("PRJNA8", 1, "", "r9", []),
        ],
        "bioproject string, pos int, doi string, reference string, affiliations array<string>",
    )
    lookups = spark.createDataFrame([("PRJNA7", None), ("PRJNA8", None), ("PRJNA20", None)], "bioproject string, error string")
    out = curate.propose(wanted, summaries, candidates, lookups, index, record)
    assert rows(out.projects, "bioproject", "title", "weight") == [("PRJNA7", "T", 2), ("PRJNA8", "U", 0)]
    assert [(r.doi, r.starred) for r in out.candidates.collect()] == [("star", True), ("new", False), ("n8", False)]
    assert rows(out.guard) == [(False, 0)]
    failed = curate.propose(wanted, summaries, candidates, lookups.filter("bioproject <> 'PRJNA8'"), index, record)
    assert rows(failed.guard) == [(True, 1)]

    queue = spark.createDataFrame([("PRJNA7", "confirmed"), ("PRJNA8", "unreviewed"), ("PRJNA1", "not_found")], "bioproject string, status string")
    marks = spark.createDataFrame(
        [("PRJNA7", "star", "r2", "kept"), ("PRJNA7", "new", "", "rejected"), ("PRJNA8", "n8", "", "kept")],
        "bioproject string, doi string, reference string, role string",
    )
    filed, left = curate.collect(queue, marks, record)
    assert rows(filed, "bioproject", "doi", "role") == [
        ("PRJNA20", "seen", "rejected"), ("PRJNA7", "new", "rejected"), ("PRJNA7", "old", "rejected"), ("PRJNA7", "star", "kept")
    ]
    assert rows(left, "bioproject") == [("PRJNA8",)]
    per_subject = spark.createDataFrame([("s", "PRJNA1", 3), ("s", "PRJNA8", 1)], "subject string, bioproject string, weight bigint")
    assert rows(cu.coverage(per_subject, index, record.filter("role = 'kept'"))) == [("s", 1, 2, 3, 4)]


def test_subjects_and_targets(spark):
    files = spark.createDataFrame(
        [(f"file:/x/species/{p}",) for p in ("birds/a/config.yaml", "fish/a/config.yaml", "fish/b/config.yaml", "fish/c/README.txt")], "path string"
    )
    subjects = subjects_from_files(files)
    assert rows(subjects, "subject", "clade", "slug") == [("birds/a", "birds", "a"), ("fish/a", "fish", "a"), ("fish/b", "fish", "b")]
    assert rows(subjects_from_files(files, "birds"), "subject") == [("birds/a",)]
    targets = spark.createDataFrame([("species/birds/a",), ("fish/a/",), ("b",), ("a",), ("zz",)], "target string")
    assert rows(resolve_targets(targets, subjects), "target", "outcome", "subject") == [
        ("a", "ambiguous", None), ("b", "resolved", "fish/b"), ("fish/a/", "resolved", "fish/a"),
        ("species/birds/a", "resolved", "birds/a"), ("zz", "missing", None),
    ]
