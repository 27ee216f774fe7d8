"""The check catalogue itself, run over orders read as subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.plans.catalog import empty_objects, orphans, validate
from tallymark.plans.corpus import Corpus
from tallymark.plans.driver import query
from tallymark.plans.queries_sources import accession_of
from tallymark.plans.registry import finding
from tallymark.session import cut


def _none():
    return F.lit(None).cast("string")


def _text(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _subject(column: str):
    return F.col(column).cast("string").alias("subject")


def _tally(findings: DataFrame) -> DataFrame:
    """Findings and distinct subjects per check and severity."""
    return (
        findings.groupBy("id", "severity", "subject")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("id", "severity")
        .agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_subjects"))
    )


def _subjects(t) -> DataFrame:
    return t.orders.select(
        _subject("o_orderkey"), F.col("o_orderpriority").alias("clade"), _text("order-", "o_orderkey").alias("slug"),
        _text("orders/", "o_orderkey").alias("path"),
    )


def _config(t, source) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    name = F.when(urgent, accession_of("o_custkey", F.lit("GCA_"))).otherwise(_text("Name_", "o_custkey"))
    return t.orders.select(
        _subject("o_orderkey"), name.alias("ref_name"), source.alias("ref_source"), _none().alias("ploidy"), _none().alias("het_prior"),
        _none().alias("caller"), F.lit(True).alias("parsed"), _none().alias("body"), F.lit("config.yaml").alias("path"),
    )


def _sheet(t) -> DataFrame:
    """Line items as sheet rows: runs, experiments by line number, local paths."""
    flagged = F.col("l_returnflag") == "N"
    value = (
        F.when(F.col("l_linestatus") == "F", _text("SRR", "l_suppkey"))
        .when(F.col("l_tax") == 0, _text("/data/", "l_partkey"))
        .otherwise(_text("SRX", "l_linenumber"))
    )
    return t.lineitem.select(
        _subject("l_orderkey"), F.col("l_linenumber").alias("line"),
        F.when(flagged, _text("S", "l_partkey")).otherwise(_text("SAMN", "l_partkey")).alias("sample_id"),
        F.lit("srr").alias("input_type"), value.alias("input"), _none().alias("library_id"),
        F.create_map().cast("map<string,string>").alias("extra"), F.lit("sample_sheet.csv").alias("path"),
    )


@query(
    "q_catalog_declared",
    """WITH s AS (SELECT l_orderkey AS k, l_returnflag, l_quantity, CASE WHEN l_linestatus = 'F' THEN 'SRR' || l_suppkey WHEN l_tax = 0 THEN '/data/' || l_partkey
        ELSE 'SRX' || l_linenumber END AS input FROM lineitem),
      x AS (SELECT 'SRX' || s_nationkey AS input, count(*) AS n FROM supplier GROUP BY 1),
      f AS (SELECT 'R001' AS id, 'error' AS severity, o_orderkey AS k FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'
        UNION ALL SELECT 'R002', 'error', o_orderkey FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT 'R003', 'warn', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT CASE l_quantity WHEN 1 THEN 'R010' WHEN 2 THEN 'R011' WHEN 3 THEN 'R012' ELSE 'R014' END, 'error', k FROM s WHERE l_quantity <= 4
        UNION ALL SELECT 'R013', 'error', k FROM s WHERE starts_with(input, '/')
        UNION ALL SELECT 'R015', 'warn', k FROM s WHERE starts_with(input, '/')
        UNION ALL SELECT DISTINCT 'R016', 'warn', k FROM s WHERE l_returnflag = 'N'
        UNION ALL SELECT 'R017', 'error', k FROM s JOIN x USING (input) WHERE n > 1
        UNION ALL SELECT DISTINCT 'R017', 'info', k FROM s JOIN x USING (input) WHERE n = 1
        UNION ALL SELECT 'R020', 'warn', o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F'
        UNION ALL SELECT 'R020', 'skipped', o_orderkey FROM orders WHERE o_orderpriority <> '2-HIGH'
        UNION ALL SELECT id, 'skipped', o_orderkey FROM orders, (VALUES ('R013'), ('R015'), ('R016')) v(id) WHERE o_orderkey NOT IN (SELECT k FROM s)
        UNION ALL SELECT 'R017', 'skipped', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM s WHERE NOT starts_with(input, '/')))
    SELECT id, severity, count(*) AS n, count(DISTINCT k) AS n_subjects FROM f GROUP BY 1, 2""",
)
def catalog_declared(t) -> DataFrame:
    """All checks on the declared side, including the read archive."""
    status = F.col("o_orderstatus")
    canonical = accession_of("o_custkey", F.lit("GCA_"))
    source = F.when(status == "F", canonical).when(status == "O", _text("https://x/", "o_orderkey")).otherwise(_text("plain-", "o_orderkey"))
    q = F.col("l_quantity")
    code = (
        F.when(q == 1, "short_row").when(q == 2, "empty_sample_id").when(q == 3, "unknown_input_type")
        .when(q == 4, "duplicate_run").when(q == 5, "blank_row")
    )
    sheet_issues = t.lineitem.filter("l_quantity <= 5").select(
        _subject("l_orderkey"), F.lit("sheet").alias("source"), code.alias("code"), F.lit("line item").alias("message"),
        F.lit("sample_sheet.csv").alias("path"), F.col("l_linenumber").alias("line"),
    )
    config_issues = t.orders.filter("o_orderpriority = '5-LOW' AND o_orderstatus = 'P'").select(
        _subject("o_orderkey"), F.lit("config").alias("source"), F.lit("missing_key").alias("code"), F.lit("no samples").alias("message"),
        F.lit("config.yaml").alias("path"), F.lit(None).cast("int").alias("line"),
    )
    corpus = Corpus(
        t.spark,
        {
            "subjects": _subjects(t),
            "config": _config(t, source),
            "sheet": _sheet(t),
            "issues": sheet_issues.unionByName(config_issues),
            "readme": t.orders.filter("o_orderpriority = '2-HIGH'").select(
                _subject("o_orderkey"), F.lit("text").alias("text"), _none().alias("species"), canonical.alias("accession"),
                F.array().cast("array<string>").alias("bioprojects"), F.lit("README.txt").alias("path"),
            ),
            "runs": t.supplier.select(
                _text("SRR", "s_suppkey").alias("run"), _text("SRX", "s_nationkey").alias("experiment"),
                _text("SAMN", "s_suppkey").alias("biosample"), _text("PRJNA", "s_nationkey").alias("bioproject"), _none().alias("sample_name"),
            ),
        },
    )
    return _tally(validate(corpus, only=["R"], check_runs=True))


@query(
    "q_catalog_published",
    """WITH l AS (SELECT l_orderkey AS k, l_linenumber, l_linestatus, l_returnflag, l_discount, l_tax, l_partkey AS p FROM lineitem),
      b AS (SELECT k, p, bool_or(l_tax > 0) AS indexed, bool_or(l_discount = 0) AS hollow FROM l WHERE l_linestatus = 'F' GROUP BY 1, 2),
      o AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr, o_orderkey IN (SELECT k FROM b) AS bams,
        o_orderpriority <> '5-LOW' AS vcf, o_orderpriority NOT IN ('5-LOW', '3-MEDIUM') AS tbi FROM orders WHERE o_orderstatus <> 'P'),
      c AS (SELECT *, bams AND vcf AND tbi AND st = 'F' AS complete FROM o WHERE bams OR vcf),
      sh AS (SELECT DISTINCT k, p FROM l), v AS (SELECT DISTINCT k, p FROM l WHERE l_returnflag <> 'A'),
      s1 AS (SELECT k, bool_or(x = 1 AND y = 0 OR x = 0 AND y = 1) AS differs FROM (SELECT k, p, max(a) AS x, max(z) AS y FROM
        (SELECT k, p, 1 AS a, 0 AS z FROM sh UNION ALL SELECT k, p, 0, 1 FROM v) GROUP BY 1, 2) GROUP BY 1),
      s2 AS (SELECT k, bool_or(x <> y) AS differs FROM (SELECT k, p, max(a) AS x, max(z) AS y FROM
        (SELECT k, p, 1 AS a, 0 AS z FROM sh UNION ALL SELECT k, p, 0, 1 FROM b) GROUP BY 1, 2) GROUP BY 1),
      s3 AS (SELECT k, bool_or(x <> y) AS differs FROM (SELECT k, p, max(a) AS x, max(z) AS y FROM
        (SELECT k, p, 1 AS a, 0 AS z FROM v UNION ALL SELECT k, p, 0, 1 FROM b) GROUP BY 1, 2) GROUP BY 1),
      f AS (SELECT 'G010' AS id, 'warn' AS severity, k FROM c WHERE NOT vcf
        UNION ALL SELECT 'G011', 'error', k FROM c WHERE vcf AND NOT tbi
        UNION ALL SELECT 'G012', 'error', k FROM c WHERE NOT bams
        UNION ALL SELECT DISTINCT 'G013', 'error', k FROM b WHERE NOT indexed AND k IN (SELECT k FROM c)
        UNION ALL SELECT DISTINCT 'G014', 'error', k FROM b WHERE hollow AND k IN (SELECT k FROM c)
        UNION ALL SELECT 'G014 objects', 'error', k FROM b WHERE hollow AND k IN (SELECT k FROM c)
        UNION ALL SELECT 'G018', 'warn', o_orderkey FROM orders
        UNION ALL SELECT 'S001', 'error', k FROM s1 WHERE differs AND k IN (SELECT k FROM v)
        UNION ALL SELECT 'S002', 'error', s2.k FROM s2 JOIN c ON c.k = s2.k WHERE differs AND complete
        UNION ALL SELECT 'S003', 'error', s3.k FROM s3 JOIN c ON c.k = s3.k WHERE differs AND complete AND s3.k IN (SELECT k FROM v)
        UNION ALL SELECT id, 'skipped', o_orderkey FROM orders, (VALUES ('G010'), ('G011'), ('G012'), ('G013'), ('G014'), ('G017')) w(id)
          WHERE o_orderkey NOT IN (SELECT k FROM c)
        UNION ALL SELECT 'S001', 'skipped', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM v)
        UNION ALL SELECT 'S002', 'skipped', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM sh) OR o_orderkey NOT IN (SELECT k FROM c)
        UNION ALL SELECT 'S003', 'skipped', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM v) OR o_orderkey NOT IN (SELECT k FROM c))
    SELECT id, severity, count(*) AS n, count(DISTINCT k) AS n_subjects FROM f GROUP BY 1, 2""",
)
def catalog_published(t) -> DataFrame:
    """Integrity and identity checks: sheet, variant file and alignment files.

    Line items in status F are alignment files, those not returned as A are
    variant-file samples, and the order's priority says which files exist. The
    objects that the findings of G014 are about are counted one by one as well.
    """
    published = t.orders.filter("o_orderstatus <> 'P'")
    flipped = F.when(F.col("o_orderstatus") == "O", "GCF_").otherwise("GCA_")
    kinds = ["accession", "dir", "name", "key", "size", "etag", "last_modified"]

    def objects(df, key, directory, name, size):
        acc = accession_of(key, F.lit("GCA_"))
        path = F.concat_ws("/", F.lit("x"), acc, F.lit(directory), name)
        return df.select(
            acc.alias("accession"), F.lit(directory).alias("dir"), name.alias("name"), path.alias("key"),
            size.cast("bigint").alias("size"), F.lit("e").alias("etag"), F.lit("").alias("last_modified"),
        ).select(*kinds)

    files = t.lineitem.filter("l_linestatus = 'F'").join(
        published.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi"
    ).groupBy("l_orderkey", "l_partkey").agg(
        F.bool_or(F.col("l_tax") > 0).alias("indexed"), F.bool_or(F.col("l_discount") == 0).alias("hollow")
    )
    bam = F.concat(F.lit("SAMN"), F.col("l_partkey").cast("string"), F.lit(".bam"))
    one = F.lit(1)
    with_vcf = published.filter("o_orderpriority <> '5-LOW'")
    with_index = with_vcf.filter("o_orderpriority <> '3-MEDIUM'")
    # A listing is a stored table in use; here it is written once.
    listing = cut(
        objects(files, "l_orderkey", "bams", bam, F.when(F.col("hollow"), 0).otherwise(1))
        .unionByName(objects(files.filter("indexed"), "l_orderkey", "bams", F.concat(bam, F.lit(".csi")), one))
        .unionByName(objects(with_vcf, "o_orderkey", "vcfs", F.lit("raw.vcf.gz"), one))
        .unionByName(objects(with_index, "o_orderkey", "vcfs", F.lit("raw.vcf.gz.tbi"), one))
    )
    dirs = published.filter("o_orderstatus = 'F'").select(
        accession_of("o_orderkey", F.lit("GCA_")).alias("accession"), F.explode(F.array(F.lit("qc"), F.lit("callable_sites"))).alias("dir")
    )
    # Orders without any file are not published, whatever directories say.
    dirs = dirs.join(listing.select("accession"), "accession", "left_semi")
    sample = _text("SAMN", "l_partkey").alias("sample")
    # So are the samples of the variant files, which several checks compare.
    samples = cut(t.lineitem.filter("l_returnflag <> 'A'").select(_subject("l_orderkey"), sample).distinct())
    declared = accession_of("o_orderkey", flipped)
    corpus = Corpus(
        t.spark,
        {
            "subjects": _subjects(t),
            "config": _config(t, F.when(F.col("o_orderstatus") != "P", declared)),
            "sheet": _sheet(t).withColumn("sample_id", F.regexp_replace("sample_id", r"^S(?=\d)", "SAMN")),
            "objects": listing,
            "subdirs": dirs,
            "vcf_samples": samples.withColumn("pos", F.lit(0)).select("subject", "pos", "sample"),
            "vcf_lines": samples.select("subject", F.lit(1).alias("line"), F.lit("##x").alias("value")),
        },
    )
    found = validate(corpus, only=["G", "S001", "S002", "S003"])
    empty = finding(empty_objects(corpus), "G014 objects", "error", F.col("name"))
    return _tally(found.unionByName(empty))


@query(
    "q_catalog_orphans",
    """WITH p AS (SELECT s_suppkey AS k FROM supplier UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0),
      claimed AS (SELECT DISTINCT o_custkey AS k FROM orders)
    SELECT CASE WHEN c_custkey IS NOT NULL THEN 'G020' ELSE 'G021' END AS id, 'warn' AS severity, count(*) AS n, CAST(1 AS BIGINT) AS n_subjects
    FROM p LEFT JOIN customer ON c_custkey = p.k AND c_mktsegment = 'BUILDING' WHERE p.k NOT IN (SELECT k FROM claimed) GROUP BY 1""",
)
def catalog_orphans(t) -> DataFrame:
    """Published accessions no order claims, in either form."""
    acc = lambda df, key, prefix: df.select(accession_of(key, F.lit(prefix)).alias("accession"), _none().alias("dir"))
    published = acc(t.supplier, "s_suppkey", "GCA_").unionByName(acc(t.customer.filter("c_acctbal < 0"), "c_custkey", "GCA_"))
    form = F.when(F.col("o_orderstatus") == "O", "GCF_").otherwise("GCA_")
    corpus = Corpus(
        t.spark,
        {
            "subjects": _subjects(t),
            "config": _config(t, accession_of("o_custkey", form)),
            "subdirs": published,
            "authority": t.customer.filter("c_mktsegment = 'BUILDING'").select(
                F.col("c_name").alias("scientific_name"), F.lit(1).alias("taxid"), accession_of("c_custkey", F.lit("GCA_")).alias("accession"),
                F.lit(1).alias("line"), F.col("c_name").alias("slug"), F.col("c_name").alias("binomial"),
            ),
        },
    )
    return _tally(orphans(corpus))
