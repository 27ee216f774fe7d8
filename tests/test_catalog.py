"""The check catalogue: every check fires on the faulty subject and only there."""

import re

import pytest
from conftest import rows
from corpus_data import A1, BAD, CONFIG, GOOD, NEW, obj, read_corpus, sheet_row, write_corpus

from tallymark.plans.catalog import CATALOG, orphans, validate
from tallymark.plans.registry import as_table, pick, run_checks, selection_digest, skipped, slices_of, table_of_checks


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    write_corpus(spark, path)
    return path


@pytest.fixture(scope="module")
def findings(spark, root):
    return validate(read_corpus(spark, root), check_runs=True).cache()


EXPECTED = {
    BAD: {
        "E001", "E002", "E003", "F001", "F002", "F003", "F004", "F005", "F006", "F008", "F021", "F023", "F024",
        "G011", "G013", "G014", "G017", "P001", "P002", "P003", "R001", "R010", "R011", "R012", "R013", "R014",
        "R015", "R016", "R017", "R020", "S001", "S004", "S005", "S006", "S007",
    },
    NEW: {"F022", "G018", "R002", "R003", "X001"},
}


def test_each_check_fires_where_it_should(findings):
    fired = {}
    for subject, id in rows(findings.filter("severity <> 'skipped'"), "subject", "id"):
        fired.setdefault(subject, set()).add(id)
    assert fired.pop(GOOD) == {"R017"}  # one experiment with one run: a note
    assert fired == EXPECTED


def test_skips_name_the_missing_slices(findings):
    got = {r[0]: r[1] for r in rows(findings.filter(f"severity = 'skipped' AND subject = '{NEW}'"), "id", "detail")}
    assert got["S001"] == "needs vcf_header"
    assert got["F001"] == "needs vcf_header, assembly_seqs"
    assert not {"R013", "G018", "F022"} & set(got)
    assert rows(findings.filter(f"severity = 'skipped' AND subject = '{GOOD}'")) == []


def test_details(findings):
    detail = {(r[0], r[1]): (r[2], r[3]) for r in rows(findings, "id", "subject", "message", "detail")}
    assert detail[("S001", BAD)] == (
        "sample_sheet.csv (5) and raw.vcf.gz (2) do not hold the same samples",
        "only in sample_sheet.csv: SAMN10, SAMN11, SAMN9, odd8; only in raw.vcf.gz: ghost"
        "; either side may be out of date, so a person has to decide",
    )
    assert detail[("F003", BAD)] == ("contigs are named by genbank and also by 1 refseq", "NC_8.1")
    assert detail[("F021", BAD)][1].endswith("confirmed by the paired assembly")
    assert detail[("G014", BAD)] == ("objects of no bytes: 1", "bams/odd8.bam")
    assert detail[("P003", BAD)][1] == "calls in the header: HaplotypeCaller"


def run_one(spark, root, check, **changes):
    return run_checks(read_corpus(spark, root, **changes), pick(CATALOG, [check]), only=[check])



@pytest.mark.parametrize(
    "check, changes, want",
    [
        # No alignment file and no variant file.
        ("G010", {"objects": [obj(A1, "bams", "SAMN1.bam")]}, [(GOOD, "warn")]),
        ("G012", {"objects": [obj(A1, "vcfs", "raw.vcf.gz")]}, [(GOOD, "error")]),
        # The prefix is there and nothing below it.
        ("G001", {"objects": [], "subdirs": [(A1, None)]}, [(GOOD, "error")]),
        # An assembly sequence is missing from a coherent variant file.
        ("F009", {"vcf_contigs": [(GOOD, "CM1.1", 100), (GOOD, "CM2.1", 50)]}, [(GOOD, "warn")]),
        ("F011", {"vcf_contigs": [(GOOD, "CM2.1", 50), (GOOD, "CM3.1", 5)]}, [(GOOD, "warn")]),
        # Names of two schemes: both stay quiet, F003 owns it.
        ("F009", {"vcf_contigs": [(GOOD, "CM1.1", 100), (GOOD, "NC_2.1", 50)]}, []),
        ("F011", {"vcf_contigs": [(GOOD, "CM1.1", 100), (GOOD, "NC_2.1", 50)]}, []),
        # A complete publication whose files differ from the sheet and the variant file.
        ("S002", {"sheet": [sheet_row(GOOD, 2, "SAMN1", "srr", "SRR1")]}, [(GOOD, "error")]),
        ("S003", {"vcf_samples": [(GOOD, 0, "SAMN1")]}, [(GOOD, "error")]),
        # A partial one proves nothing.
        ("S002", {"subdirs": [(A1, "qc")], "sheet": [sheet_row(GOOD, 2, "SAMN1", "srr", "SRR1")]}, []),
        ("F020", {"authority": [("Good bird", 11, "GCA_000000099.1", 2, "good-bird", "good-bird")]}, [(GOOD, "error")]),
        # Two entries share the two-word slug: ambiguous is not missing.
        (
            "F022",
            {"authority": [("Good bird a", 1, "GCA_000000001.1", 2, "good-bird-a", "good-bird"), ("Good bird b", 2, "GCA_000000004.1", 3, "good-bird-b", "good-bird")]},
            [(BAD, "error"), (GOOD, "error"), (NEW, "error")],
        ),
        # A tool that leaves the same evidence.
        ("P003", {"config": [(*CONFIG[0][:5], "parabricks", *CONFIG[0][6:])]}, []),
        # The length is unknown on one side.
        ("F002", {"vcf_contigs": [(GOOD, "CM1.1", None)]}, []),
    ],
)
def test_controls(spark, root, check, changes, want):
    found = run_one(spark, root, check, **changes).filter("severity <> 'skipped'")
    assert rows(found, "subject", "severity") == want


def test_failed_listing_is_no_absence(spark, root):
    corpus = read_corpus(spark, root, lookups=[(GOOD, "listing", "timed out")])
    assert rows(corpus.status, "subject") == [(BAD,), (NEW,)]
    got = run_checks(corpus, pick(CATALOG, ["G"]), only=["G"]).filter(f"subject = '{GOOD}'")
    assert {r[0] for r in rows(got, "severity")} == {"skipped"}


def test_failed_run_lookup_skips(spark, root):
    found = run_one(spark, root, "E001", lookups=[(BAD, "runs", "timed out")]).filter(f"subject = '{BAD}'")
    assert rows(found, "severity", "detail") == [("skipped", "needs runs")]


def test_orphans(spark, root):
    assert [(r[0], re.search(r"GCA_\d+\.\d", r[1])[0]) for r in rows(orphans(read_corpus(spark, root)), "id", "message")] == [
        ("G020", "GCA_000000050.1"), ("G021", "GCA_000000060.1")
    ]


def test_sampled_files_are_bounded(spark, root):
    many = [obj(A1, "bams", f"S{i:03}.bam") for i in range(50)]
    got = rows(read_corpus(spark, root, objects=many).sampled_bams(3), "sample", "is_first")
    assert len(got) == 3 and ("S000", 1) in got


def test_selection():
    assert len(CATALOG) == 44
    assert len(pick(CATALOG, lacking=["runs"])) == 40
    assert [c.id for c in pick(CATALOG, ["S00", " "], ["S001", ""])] == ["S002", "S003", "S004", "S005", "S006", "S007"]
    assert [c.id for c in pick(CATALOG, ["R011"])] == ["R010"]
    assert len(pick(CATALOG, [" "])) == 44
    with pytest.raises(ValueError):
        pick(CATALOG, ["nothing"])
    assert slices_of(pick(CATALOG, ["S001", "G013"])) == {"sheet", "vcf_header", "objects"}


def test_selected_ids_only(spark, root):
    got = run_checks(read_corpus(spark, root), pick(CATALOG, ["R011"]), only=["R011"])
    assert rows(got, "id", "subject") == [("R011", BAD)]


def test_registry_refusals():
    plain = {"tier": "A", "severity": "warn", "summary": "s"}
    good = {"A1": plain | {"emits": ("A2",)}, "B1": plain}
    build = dict.fromkeys(good, lambda c: None)
    assert [c.ids for c in table_of_checks(good, build)] == [("A1", "A2"), ("B1",)]
    for described, builders, withdrawn, told in (
        (good | {"A2": plain}, build | {"A2": None}, (), "A2: in use 2 times"),
        (good, build, ("A2",), "A2: given up"),
        (good, {"A1": None}, (), "B1: nothing computes it"),
        (good, build | {"C1": None}, (), "C1: computed, but"),
        ({"A1": plain | {"severity": "grave"}}, build, (), "no such severity"),
    ):
        with pytest.raises(ValueError, match=told):
            table_of_checks(described, builders, withdrawn)


def test_broken_check_is_reported(spark, root):
    own = table_of_checks({"A1": {"tier": "A", "severity": "warn", "summary": "sum"}}, {"A1": lambda c: c.sheet.select("no_such_column")})
    found = run_checks(read_corpus(spark, root), own)
    assert {r[:3] for r in rows(found, "id", "severity", "detail")} == {("A1", "error", "sum")} and found.count() == 3


def test_catalog_table_and_digest(spark):
    frame = as_table(spark, CATALOG)
    assert frame.count() == 44 and frame.filter("array_contains(needs, 'runs')").count() == 4
    assert selection_digest(CATALOG) == selection_digest(reversed(CATALOG))
    assert selection_digest(CATALOG) != selection_digest(CATALOG[1:])


@pytest.mark.parametrize("ploidy", ["1e30", "NaN", "1d", "two", "inf"])
def test_no_number_ends_the_run(spark, root, ploidy):
    config = [(*row[:3], ploidy, *row[4:]) for row in CONFIG]
    found = run_checks(read_corpus(spark, root, config=config), pick(CATALOG, ["P001"]), only=["P001"])
    assert {r[0] for r in rows(found.filter("severity <> 'skipped'"), "severity")} <= {"warn"}


def test_selection_leaves_other_tables_alone(spark, root):
    corpus = read_corpus(spark, root)
    read = []
    tables = {name: getattr(corpus, name) for name in ("vcf_lines", "readme")}

    class Watched:
        def __init__(self, name):
            self.name = name

        def __getattr__(self, item):
            read.append(self.name)
            return getattr(tables[self.name], item)

    corpus.vcf_lines, corpus.readme = Watched("vcf_lines"), Watched("readme")
    assert corpus.availability_of({"config"}).count() == 3 and read == []
    assert corpus.availability_of({"readme"}).count() == 3 and set(read) == {"readme"}


def scans(frame, table):
    """How often the plan of a frame reads a table's files."""
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(rf"Relation \[[^\]]*{table}[^\]]*\] parquet", plan))


def test_the_sheet_is_read_four_times_at_most(spark, monkeypatch):
    from tallymark.plans import corpus as corpus_module
    from tallymark.plans import driver, queries_catalog

    seen = []
    real = corpus_module.cut
    monkeypatch.setattr(corpus_module, "cut", lambda df: seen.append(scans(df, "l_orderkey")) or real(df))
    monkeypatch.setattr(queries_catalog, "_tally", lambda found: found)
    found = driver.QUERIES["q_catalog_declared"](spark, "/root/testdata/sf0.001")
    # The sheet's names and issues are read for the tables that checks share, rows and issues once more each.
    assert 1 <= scans(found, "l_orderkey") + sum(seen) <= 6 and scans(found, "l_orderkey") <= 4


def broken(subject):
    from pyspark.sql import functions as F

    return F.when(F.col("subject") == subject, F.raise_error(F.lit("a value nobody expected")).cast("boolean")).otherwise(F.lit(True))


def test_a_value_that_fails_costs_one_subject_and_check(spark, root):
    from pyspark.sql import functions as F

    from tallymark.plans.registry import RowRule, finding

    rules = {
        "A1": RowRule("config", "A1", "warn", lambda: {"when": broken(BAD), "message": F.lit("one")}),
        "A2": RowRule("config", "A2", "warn", lambda: {"when": F.lit(True), "message": F.lit("two")}),
        "B1": lambda c: finding(c.subjects.filter(broken(GOOD)), "B1", "info", F.lit("three")),
        "C1": lambda c: finding(c.subjects.filter(F.raise_error(F.lit("always")).cast("boolean")), "C1", "info", F.lit("four")),
    }
    own = table_of_checks({k: {"tier": k[0], "severity": "warn", "summary": f"sum {k}"} for k in rules}, rules)
    corpus = read_corpus(spark, root)
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows(run_checks(corpus, own, guarded=True), "id", "subject", "severity", "message")}
    names = [r["subject"] for r in corpus.subjects.collect()]
    with_config = [r["subject"] for r in corpus.config.collect()]
    assert set(got) == {(i, s) for i in ("B1", "C1") for s in names} | {(i, s) for i in ("A1", "A2") for s in with_config}
    failed = {k for k, v in got.items() if v[0] == "error"}
    assert failed == {("A1", BAD), ("B1", GOOD), *(("C1", s) for s in names)}
    assert all("no result" in got[k][1] for k in failed)


def test_guarded_findings_are_the_same(spark, root, findings):
    assert rows(validate(read_corpus(spark, root), check_runs=True, guarded=True)) == rows(findings)


def test_chosen_subjects_give_their_part_of_the_whole(spark, root, findings):
    whole = rows(findings.filter(f"subject = '{BAD}'"))
    by_name = read_corpus(spark, root).only([BAD])
    assert rows(validate(by_name, check_runs=True)) == whole
    chosen = spark.createDataFrame([(BAD,), (BAD,)], "subject string")
    assert rows(validate(read_corpus(spark, root).only(chosen), check_runs=True)) == whole


def test_names_reach_the_scan(spark, tmp_path):
    from tallymark.plans.corpus import Corpus

    path = str(tmp_path / "subjects")
    spark.createDataFrame([("a/b", "a", "b", "p")], "subject string, clade string, slug string, path string").write.parquet(path)
    plan = Corpus(spark, {"subjects": spark.read.parquet(path)}).only(["a/b"]).subjects._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(subject,a/b)" in plan or "In(subject" in plan


def test_files_are_settled_by_digest(spark, root):
    # A third of all files belong to one subject; only the one that differs meets the contigs.
    sq = lambda s, bam, n, lengths: [(s, bam, i, "SQ", {"SN": f"c{i}", "LN": str(x)}) for i, x in enumerate(lengths)]
    records = [r for k in range(30) for r in sq(GOOD, f"SAMN{k}", 4, [10, 20, 30, 40 + (k == 7)])]
    contigs = [(GOOD, f"c{i}", x) for i, x in enumerate([10, 20, 30, 40])]
    found = run_one(spark, root, "F004", bam_records=records, vcf_contigs=contigs).filter("severity <> 'skipped'")
    assert [(r["subject"], "SAMN7.bam" in r["message"], r["detail"]) for r in found.collect()] == [(GOOD, True, "other length: c3")]
