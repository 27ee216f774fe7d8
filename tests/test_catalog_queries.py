"""The catalogue queries: what they report, and what they move to do so."""

import os

import pytest

import __spark_entry__ as entry_module

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_published_side_reports_skipped_checks_and_every_empty_object(spark):
    found = {(r["id"], r["severity"]): (r["n"], r["n_subjects"]) for r in entry_module.queries()["q_catalog_published"](spark, SF).collect()}
    skipped = {id for id, severity in found if severity == "skipped"}
    assert {"G010", "G011", "G012", "G013", "G014", "G017", "S001", "S002", "S003"} == skipped
    # One finding a subject, and beside it each object it is about.
    subjects = found["G014", "error"][0]
    objects = found["G014 objects", "error"]
    assert objects[1] == subjects < objects[0]


def test_the_sheet_gives_only_names_that_selected_checks_compare(spark, monkeypatch):
    from tallymark.plans import corpus as corpus_module

    kinds = {}
    real = corpus_module.cut

    def seen(df):
        table = real(df)
        if "kind" in df.columns:
            kinds[current] = {r["kind"]: r["n"] for r in table.groupBy("kind").agg({"*": "count"}).toDF("kind", "n").collect()}
        return table

    monkeypatch.setattr(corpus_module, "cut", seen)
    for current in ("q_catalog_published", "q_catalog_declared"):
        entry_module.queries()[current](spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert set(kinds["q_catalog_published"]) == {"sheet", "sample"}
    assert set(kinds["q_catalog_declared"]) == {"sheet", "sample", "archive input"}
    # All samples on one side, on the other those without a BioSample's form.
    assert kinds["q_catalog_published"]["sample"] == lines.select("l_orderkey", "l_partkey").distinct().count()
    assert kinds["q_catalog_declared"]["sample"] == lines.filter("l_returnflag = 'N'").select("l_orderkey", "l_partkey").distinct().count()


def test_samples_are_counted_whole_after_checks_that_need_only_odd_ones(spark):
    from tallymark.plans.catalog import validate
    from tallymark.plans.corpus import Corpus

    columns = "subject string, line int, sample_id string, input_type string, input string, library_id string, extra map<string,string>, path string"
    sheet = spark.createDataFrame([("a/b", i, f"SAMN{i}", "srr", "SRR1", None, {}, "p") for i in range(3)], columns)
    corpus = Corpus(spark, {"subjects": spark.createDataFrame([("a/b", "a", "b", "p")], "subject string, clade string, slug string, path string"), "sheet": sheet})
    validate(corpus, only=["R016"])
    assert [r["n_sheet"] for r in corpus.artifacts.collect()] == [3]


def test_line_items_are_not_read_again_for_the_published_findings(spark, monkeypatch):
    from tallymark.plans import queries_catalog

    monkeypatch.setattr(queries_catalog, "_tally", lambda found: found)
    found = entry_module.queries()["q_catalog_published"](spark, SF)
    assert "l_returnflag" not in found._jdf.queryExecution().executedPlan().toString()
