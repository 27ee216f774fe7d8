"""Column functions on small hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tallymark.functions import identifiers as ids
from tallymark.functions import text as tx
from tallymark.functions import values as vl


def one(spark, expr, **cols):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "func, good, bad",
    [
        (ids.is_assembly, "GCA_027172205.1", "GCA_27.1"),
        (ids.is_biosample, "SAMEA123", "SAMX1"),
        (ids.is_run, "ERR12", "ERX12"),
        (ids.is_experiment, "DRX7", "DRR7"),
        (ids.is_archive_input, "SRX7", "xSRX7"),
        (ids.is_local_input, "/data/x.fq", "SRR1"),
        (ids.is_local_source, "./a.fa", "a.fa"),
        (ids.is_url, "ftp://x", "gopher://x"),
    ],
)
def test_identifier_predicates(spark, func, good, bad):
    assert one(spark, func(F.col("v")), v=good) is True
    assert one(spark, func(F.col("v")), v=bad) is False


def test_counterpart_and_same_assembly(spark):
    a = F.col("a")
    assert one(spark, ids.counterpart(a), a="GCA_000000001.2") == "GCF_000000001.2"
    assert one(spark, ids.counterpart(a), a="GCF_000000001.2") == "GCA_000000001.2"
    assert one(spark, ids.counterpart(a), a="other") is None
    assert one(spark, ids.same_assembly(a, F.lit("GCF_000000001.2")), a="GCA_000000001.2")
    assert not one(spark, ids.same_assembly(a, F.lit("GCF_000000001.1")), a="GCA_000000001.2")


def test_extract_ids_keeps_first_seen_order(spark):
    text = "see PRJNA9, PRJEB1 and PRJNA9; not XPRJNA3"
    assert one(spark, ids.extract_ids(F.col("t")), t=text) == ["PRJNA9", "PRJEB1"]


@pytest.mark.parametrize(
    "name, slug, two",
    [
        ("  Podarcis raffonei ", "podarcis-raffonei", "podarcis-raffonei"),
        ("Sus scrofa domesticus", "sus-scrofa-domesticus", "sus-scrofa"),
        ("Grévy’s zebra (sp. 1)", "gr-vys-zebra-sp-1", "gr-vys"),
    ],
)
def test_slugs(spark, name, slug, two):
    assert one(spark, tx.slugify(F.col("n")), n=name) == slug
    assert one(spark, tx.binomial_slug(F.col("n")), n=name) == two


def test_sanitize_and_documents(spark):
    assert one(spark, tx.sanitize_name(F.col("n")), n="mEub.hap2.+ XY") == "mEub.hap2._XY"
    a, b = "x  \r\ny\n", "x\ny"
    assert one(spark, tx.normalized_document(F.col("a")) == tx.normalized_document(F.col("b")), a=a, b=b)


def test_affiliation_needs_every_distinctive_word(spark):
    have = F.array(F.lit("Department of Ecology, University of Colorado, Boulder"))
    assert one(spark, tx.affiliation_matches(F.lit("The University of Colorado"), have))
    assert not one(spark, tx.affiliation_matches(F.lit("University of Helsinki"), have))
    assert not one(spark, tx.affiliation_matches(F.lit("The Institute"), have))


def test_reference_lines(spark):
    line = lambda *p: one(spark, tx.reference_line(*[F.lit(x) for x in p]))
    assert line("Doe J et al.", "2020", "A title", "Nature") == "Doe J et al. (2020) A title Nature."
    assert line("", "", "", "Nature") == "Nature."
    assert line("", "2020", "T", "") == "(2020) T"
    assert one(spark, tx.first_author(F.lit("Doe J, Roe K."))) == "Doe J et al."
    assert one(spark, tx.first_author(F.lit("Doe J."))) == "Doe J"


def test_describe(spark):
    head = F.array(F.lit("a"), F.lit("b"))
    assert one(spark, tx.describe(head, F.lit(2))) == "a, b"
    assert one(spark, tx.describe(head, F.lit(9), 2)) == "a, b (+7 more)"


def test_numbers(spark):
    assert one(spark, vl.as_number(F.lit(" 5e-3 "))) == 0.005
    assert one(spark, vl.as_number(F.lit("x"))) is None
    assert one(spark, vl.as_whole(F.lit("7.0"))) == 7
    assert one(spark, vl.as_whole(F.lit("7.5"))) is None
    assert one(spark, vl.close_enough(F.lit(0.005), F.lit(0.0050000000001)))
    assert not one(spark, vl.close_enough(F.lit(0.005), F.lit(0.0051)))
    assert one(spark, vl.severity_rank(F.lit("info"))) == 2
    assert one(spark, vl.severity_rank(F.lit("odd"))) is None


def test_tolerant_numbers_take_what_is_a_decimal_number(spark):
    from tallymark.functions import values

    texts = ["1", " 2.50 ", "1e30", "NaN", "inf", "1d", "0x1p3", "", "x", "9007199254740993", "-7.0", "1_000", "9223372036854775808", ".5"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", values.as_finite(F.col("t")).alias("f"), values.as_whole(F.col("t")).alias("w")).orderBy("i").collect()
    assert [r["f"] for r in got] == [1.0, 2.5, 1e30, None, None, None, None, None, None, 9007199254740992.0, -7.0, 1000.0, 9.223372036854775808e18, 0.5]
    assert [r["w"] for r in got] == [1, None, None, None, None, None, None, None, None, 9007199254740993, -7, 1000, None, None]
