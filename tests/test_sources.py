"""Tolerant scans over small hand-written files."""

import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.sources import curation, lines, metadata, observed, records, registry


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("repo") / "species"

    def put(path, text):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(text if isinstance(text, bytes) else text.encode("utf-8"))

    put(
        "birds/a/sample_sheet.csv",
        "﻿sample_id, input_type,input,library_id,site\r\nSAMN1,srr,SRR1,L1,north\r\n,srr,SRR2\r\n\r\nSAMN3,odd,SRR3\r\n"
        'SAMN1,srr,SRR1,,\r\nshort,row\r\nSAMN4,fastq,"/d/x,1.fq"\r\n',
    )
    put("birds/b/sample_sheet.csv", "sample_id,input\nSAMN1,SRR1,x\n")
    put("birds/c/sample_sheet.csv", "")
    put("birds/a/config.yaml", '{"samples":"s","reference":{"name":"A_bird","source":" GCA_000000001.1 "},"variant_calling":{"tool":"gatk","ploidy":2,"gatk":{"het_prior":0.005}}}')
    put("birds/b/config.yaml", '{"reference":{"name":null},"samples":null}')
    put("birds/c/config.yaml", "[1, 2]")
    put("birds/d/config.yaml", "{not json")
    put("birds/e/config.yaml", '{"samples":1,"variant_calling":{},"reference":"x"}')
    put("birds/a/README.txt", "Species: one\nspecies: two \nAccession Number:  GCA_1\nfrom PRJNA5, PRJEB2, PRJNA5\n")
    return root


def sheets(spark, root):
    return lines.with_subject(lines.read_lines(spark, f"{root}/*/*/sample_sheet.csv"))


def test_sheet_rows_and_issues(spark, tree):
    scan = metadata.parse_sheets(sheets(spark, tree))
    a = rows(scan.rows.filter("subject = 'birds/a'"), "line", "sample_id", "input_type", "input", "library_id", "extra")
    assert a == [
        (2, "SAMN1", "srr", "SRR1", "L1", {"site": "north"}),
        (5, "SAMN3", "odd", "SRR3", None, {}),
        (6, "SAMN1", "srr", "SRR1", None, {}),
        (8, "SAMN4", "fastq", "/d/x,1.fq", None, {}),
    ]
    assert rows(scan.issues.filter("subject = 'birds/a'"), "line", "code") == [
        (3, "empty_sample_id"), (4, "blank_row"), (5, "unknown_input_type"), (6, "duplicate_run"), (7, "short_row")
    ]
    b = rows(scan.issues.filter("subject = 'birds/b'"), "line", "code", "message")
    assert b == [(1, "missing_column", "the header lacks 'input_type'")]
    assert rows(scan.rows.filter("subject = 'birds/b'"), "sample_id", "input_type", "input") == [("SAMN1", "", "SRR1")]


def test_missing_and_empty_files(spark, tree):
    seen = lines.with_subject(lines.list_files(spark, f"{tree}/*/*/sample_sheet.csv"))
    assert rows(seen, "subject") == [("birds/a",), ("birds/b",)]
    empty = spark.createDataFrame([("birds/c/sample_sheet.csv", 0, "birds/c")], seen.schema)
    files = seen.unionByName(empty)
    subjects = spark.createDataFrame([(f"birds/{x}",) for x in "abcz"], "subject string")
    found = metadata.file_issues(subjects, files, "sample_sheet.csv", "sheet")
    assert rows(found, "subject", "code", "line") == [("birds/c", "parse_error", 1), ("birds/z", "missing_file", None)]


def test_lines_are_numbered_across_file_blocks(spark, tmp_path):
    text = "\n".join(f"line {i}" for i in range(1, 2001))
    (tmp_path / "big.txt").write_text(text)
    (tmp_path / "small.txt").write_text("one\r\ntwo")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = rows(lines.read_lines(spark, str(tmp_path)).filter("path like '%big.txt'"), "line", "value")
        assert sorted(got) == [(i, f"line {i}") for i in range(1, 2001)]
        assert rows(lines.read_lines(spark, str(tmp_path / "small.txt")), "line", "value") == [(1, "one"), (2, "two")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_configs(spark, tree):
    docs = lines.with_subject(lines.read_documents(spark, f"{tree}/*/*/config.yaml"))
    scan = metadata.parse_configs(docs)
    assert rows(scan.rows.filter("parsed"), "subject", "ref_name", "ref_source", "ploidy", "het_prior", "caller") == [
        ("birds/a", "A_bird", "GCA_000000001.1", "2", "0.005", "gatk"),
        ("birds/b", None, None, None, None, None),
        ("birds/e", None, None, None, None, None),
    ]
    assert rows(scan.issues, "subject", "code", "message") == [
        ("birds/b", "missing_key", "no value for reference.name"),
        ("birds/b", "missing_key", "no value for reference.source"),
        ("birds/b", "missing_key", "the key variant_calling is not there"),
        ("birds/c", "parse_error", "the document holds no keys"),
        ("birds/d", "parse_error", "no readable document"),
        ("birds/e", "missing_key", "nothing is said about the reference"),
    ]


def test_readme(spark, tree):
    docs = lines.with_subject(lines.read_documents(spark, f"{tree}/*/*/README.txt"))
    r = metadata.parse_readmes(docs).first()
    assert (r.subject, r.species, r.accession, r.bioprojects) == ("birds/a", "two", "GCA_1", ["PRJNA5", "PRJEB2"])


def test_authority(spark, tmp_path):
    (tmp_path / "list.csv").write_text(
        '"ScientificName","QID","Accession.for.main.haplotype"\nPodarcis raffonei,65483,GCA_1\nSus scrofa x,abc,GCA_2\n'
        "Only name\n,5,GCA_3\nTwin one,7,GCA_4\nTwin two,8,GCA_4\n\n"
    )
    scan = metadata.parse_authority(lines.read_lines(spark, str(tmp_path / "list.csv")))
    assert rows(scan.rows, "line", "slug", "binomial", "taxid", "accession") == [
        (2, "podarcis-raffonei", "podarcis-raffonei", 65483, "GCA_1"),
        (3, "sus-scrofa-x", "sus-scrofa", None, "GCA_2"),
        (6, "twin-one", "twin-one", 7, "GCA_4"),
        (7, "twin-two", "twin-two", 8, "GCA_4"),
    ]
    assert rows(scan.issues, "code", "line") == [
        ("bad_taxid", 3), ("duplicate_accession", None), ("incomplete_row", 5), ("short_row", 4)
    ]
    (tmp_path / "bad.csv").write_text("Name,Other\nx,y\n")
    bad = metadata.parse_authority(lines.read_lines(spark, str(tmp_path / "bad.csv")))
    assert bad.rows.isEmpty() and rows(bad.issues, "code") == [("missing_column",), ("missing_column",)]


def test_listing(spark, tmp_path):
    (tmp_path / "l.xml").write_text(
        '<?xml version="1.0"?><ListBucketResult xmlns="http://x/"><IsTruncated>false</IsTruncated>'
        "<Contents><Key>p/GCA_000000001.1/vcfs/raw.vcf.gz</Key><Size>3000000000</Size><ETag>&quot;9a6a-185&quot;</ETag><LastModified>t</LastModified></Contents>"
        "<Contents><Key>p/GCA_000000001.1/vcfs/</Key><Size>0</Size></Contents>"
        "<Contents><Key>p/GCA_000000001.1/README.txt</Key><Size>5</Size></Contents>"
        "<CommonPrefixes><Prefix>p/GCA_000000001.1/callable_sites/</Prefix></CommonPrefixes>"
        "<CommonPrefixes><Prefix>p/GCA_000000002.1/</Prefix></CommonPrefixes></ListBucketResult>"
    )
    objects = observed.read_listing(spark, str(tmp_path / "l.xml"))
    assert rows(objects, "accession", "dir", "name", "size", "etag") == [
        ("GCA_000000001.1", "<top>", "README.txt", 5, ""),
        ("GCA_000000001.1", "vcfs", "raw.vcf.gz", 3000000000, "9a6a-185"),
    ]
    dirs = observed.read_subdirs(spark, str(tmp_path / "l.xml"))
    assert rows(dirs) == [("GCA_000000001.1", "callable_sites"), ("GCA_000000002.1", None)]
    assert rows(observed.published(objects, dirs)) == [("GCA_000000001.1",), ("GCA_000000002.1",)]


def test_quality_tables(spark, tmp_path):
    (tmp_path / "het").write_text("\nINDV\tF\tX\ns1\t0.5\n\n\t0.9\t1\ns1\t 0.7 \tz\n")
    (tmp_path / "thr").write_text("cohort_mean_coverage\tmin_coverage\tmax_coverage\n17.4\tx\t35\n1\t2\t3\n")
    (tmp_path / "map").write_text("original_contig\tplink_contig\tadmixture_id\nCM1\tCM1\t1\n\t\t2\n")
    read = lambda n: lines.read_lines(spark, str(tmp_path / n)).withColumn("subject", F.lit("s"))
    scan = observed.keyed_table(read("het"), ["subject"], "INDV")
    assert rows(scan.rows, "INDV", "cells") == [("s1", {"INDV": "s1", "F": "0.7", "X": "z"})]
    assert scan.issues.count() == 1
    p = observed.parameter_row(read("thr"), ["subject"], ["cohort_mean_coverage", "min_coverage", "max_coverage"]).first()
    assert (p.cohort_mean_coverage, p.min_coverage, p.max_coverage) == (17.4, None, 35.0)
    assert rows(observed.contig_map(read("map"), ["subject"]), "contig") == [("CM1",)]


def test_assembly_table(spark, tmp_path):
    (tmp_path / "r.txt").write_text(
        "# comment\nSUPER_1\tassembled-molecule\t1\tChromosome\tCM1.1\t=\tNC_1.1\tPrimary\t139138986\tna\n"
        "scaf\tunplaced-scaffold\tna\tna\tJA1.1\t<>\tna\tPrimary\tunknown\tna\nshort\trow\n"
    )
    seqs = observed.assembly_sequences(lines.read_lines(spark, str(tmp_path / "r.txt")).withColumn("accession", F.lit("A")), ["accession"])
    assert rows(seqs, "name", "genbank", "refseq", "length") == [("SUPER_1", "CM1.1", "NC_1.1", 139138986), ("scaf", "JA1.1", None, None)]
    assert rows(observed.by_scheme(seqs, ["accession"]), "scheme", "contig") == [
        ("genbank", "CM1.1"), ("genbank", "JA1.1"), ("name", "SUPER_1"), ("name", "scaf"), ("refseq", "NC_1.1")
    ]


def test_vcf_header_from_concatenated_gzip_members(spark, tmp_path):
    head = (
        "##fileformat=VCFv4.2\n##contig=<ID=CM1.1,length=100>\n##contig=<ID=CM2.1>\n##contig=<ID=CM1.1,length=101>\n"
        '##GATKCommandLine=<ID=HaplotypeCaller,CommandLine="x --sample-ploidy 2 --heterozygosity 0.005",Version="4.6.2.0">\n'
        '##GATKCommandLine=<ID=GenotypeGVCFs,CommandLine="x --sample-ploidy 9",Version="9">\n'
    )
    tail = "##bcftools_concatVersion=1.20+htslib-1.20\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nCM1.1\t5\t.\tA\tT\n"
    (tmp_path / "raw.vcf.gz").write_bytes(gzip.compress(head.encode()) + gzip.compress(tail.encode()))
    df = lines.read_lines(spark, str(tmp_path / "raw.vcf.gz")).withColumn("subject", F.lit("s"))
    k = ["subject"]
    assert rows(observed.vcf_contigs(df, k), "contig", "length") == [("CM1.1", 101), ("CM2.1", None)]
    assert rows(observed.vcf_samples(df, k), "pos", "sample") == [(0, "s1"), (1, "s2")]
    assert rows(observed.command_argument(df, k, "sample-ploidy"), "argument") == [("2",)]
    assert rows(observed.tool_versions(df, k), "component", "version") == [("bcftools", "1.20"), ("gatk", "4.6.2.0")]
    assert rows(observed.tool_ids(df, k), "tool") == [("GenotypeGVCFs",), ("HaplotypeCaller",)]
    assert rows(observed.classify_lines(df, k), "label") == [("gatk",)]
    assert rows(observed.meta_keys(df, k), "meta_key", "line")[0] == ("GATKCommandLine", 5)


def test_alignment_header(spark, tmp_path):
    (tmp_path / "h.sam").write_text(
        "@HD\tVN:1.6\n@SQ\tSN:CM1.1\tLN:100\n@RG\tID:a\tSM:s1\tLB:L1\n@RG\tID:b\tSM:s1\tLB:\n"
        "@PG\tID:bwa\tPN:bwa\tCL:bwa mem -R @RG:x results/reference/Good_bird.fa.gz r.fq\n"
    )
    df = lines.read_lines(spark, str(tmp_path / "h.sam")).withColumn("bam", F.lit("s1"))
    tags = observed.tag_records(df, ["bam"])
    assert rows(observed.tag_values(tags, ["bam"], "RG", "SM", "sm"), "sm") == [("s1",)]
    assert rows(observed.tag_values(tags, ["bam"], "RG", "LB", "lb"), "lb") == [("L1",)]
    assert rows(observed.reference_lengths(tags, ["bam"]), "contig", "length") == [("CM1.1", 100)]
    assert rows(observed.aligner_reference(tags, ["bam"]), "reference") == [("Good_bird",)]


def test_run_info(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Run,Other,Experiment,BioSample,BioProject,SampleName\nDRR1,x,DRX1,SAMD1, ,n\n,,,,,\n")
    df = registry.run_info(lines.read_lines(spark, str(tmp_path / "r.csv")), ["path"]).drop("path")
    assert rows(df) == [("DRR1", "DRX1", "SAMD1", None, "n")]


def test_registry_answers(spark):
    a = spark.createDataFrame(
        [("G1", '{"reports":[{"accession":"G1","organism":{"organism_name":"P r","tax_id":65483},"assembly_info":{"assembly_name":"n","assembly_level":"Chromosome"}}]}'), ("G2", "<html>")],
        "accession string, content string",
    )
    assert rows(registry.assemblies(a), "queried", "tax_id", "paired_accession", "error") == [("G1", 65483, None, None), ("G2", None, None, "unparseable response")]
    s = spark.createDataFrame(
        [('{"result":{"uids":["1","2"],"1":{"project_acc":"PRJNA1","project_title":"T","submitter_organization":"Org"},"2":{"project_title":"no id"}}}',)], "content string"
    )
    assert rows(registry.project_summaries(s), "bioproject", "title", "submitter") == [("PRJNA1", "T", "Org")]


def test_literature_and_works(spark):
    hit = '{"doi":"10.1/x","title":"A title.","journalTitle":"J","pubYear":"2020","authorString":"Doe J, Roe K.","affiliation":"Uni A","authorList":{"author":[{"affiliation":"Uni A"},{"authorAffiliationDetailsList":{"authorAffiliation":[{"affiliation":"Uni B"}]}}]}}'
    answers = spark.createDataFrame(
        [("P1", '{"hitCount":7,"resultList":{"result":[' + ",".join([hit] + ['{"title":"t"}'] * 6) + "]}}"), ("P2", "oops"), ("P3", '{"hitCount":0}')],
        "bioproject string, content string",
    )
    candidates, states = registry.literature_hits(answers)
    assert candidates.count() == 7
    first = candidates.filter("pos = 0").first()
    assert first.reference == "Doe J et al. (2020) A title J."
    assert first.affiliations == ["Uni A", "Uni B"]
    assert rows(states) == [("P1", 7, None), ("P2", 0, "unparseable response"), ("P3", 0, None)]
    work = '{"title":["A title."],"container-title":"J","issued":{"date-parts":[[2019,1]]},"author":[{"family":"Doe","given":"Jane R."},{"literal":"Group"}]}'
    w = spark.createDataFrame([("10.1/x", True, work), ("10.1/y", False, None), ("10.1/z", True, "oops")], "doi string, found boolean, content string")
    assert rows(registry.works(w), "doi", "error", "reference") == [
        ("10.1/x", None, "Doe JR et al. (2019) A title J."), ("10.1/y", None, ""), ("10.1/z", "unparseable response", "")
    ]


QUEUE = """Preamble

## PRJNA1 — 147 samples · birds/x · fish/y

A title
Some Org · [BioProject](http://x)

<!-- considered: 10.1/a 10.1/b 10.1/c -->

- ★ [10.1/a](http://d/10.1/a) — Doe (2020) T.
- 10.1/new),

## PRJNA2 — 1 sample

- NOT YET REVIEWED
- [10.2/a](u)
- NO PUBLICATION FOUND

## PRJNA3 — 2 samples

- NO PUBLICATION FOUND

## PRJNA4 — 2 samples

text only
"""


def test_review_queue(spark, tmp_path):
    (tmp_path / "q.md").write_text(QUEUE)
    projects, candidates, issues = curation.parse_queue(lines.read_lines(spark, str(tmp_path / "q.md")))
    assert rows(projects, "bioproject", "status", "title", "submitter", "weight", "n_subjects") == [
        ("PRJNA1", "confirmed", "A title", "Some Org", 147, 2),
        ("PRJNA2", "unreviewed", "", "", 1, 0),
        ("PRJNA3", "not_found", "", "", 2, 0),
        ("PRJNA4", "unreviewed", "text only", "", 2, 0),
    ]
    kept = rows(candidates.filter("role = 'kept'"), "bioproject", "doi", "reference", "starred")
    assert kept == [("PRJNA1", "10.1/a", "Doe (2020) T.", True), ("PRJNA1", "10.1/new", "", False), ("PRJNA2", "10.2/a", "", False)]
    assert rows(candidates.filter("role = 'rejected'"), "doi") == [("10.1/b",), ("10.1/c",)]
    assert rows(issues, "bioproject", "code") == [("PRJNA4", "C010")]


def test_settled_record_round_trip(spark):
    text = '{"PRJNA1":{"status":"confirmed","title":"T","citations":[{"doi":"10.1/a","reference":"R","verified":true},{"doi":" "}],"rejected":["10.1/b"]},"PRJNA2":{"status":"odd"}}'
    projects, citations = curation.parse_record(spark.createDataFrame([(text,)], "content string"))
    assert rows(projects) == [("PRJNA1", "confirmed", "T", "")]
    assert rows(citations, "doi", "role", "verified") == [("10.1/a", "kept", True), ("10.1/b", "rejected", False)]
    p2, c2 = curation.parse_record_lines(curation.render_record(projects, citations))
    assert rows(p2) == rows(projects) and rows(c2) == rows(citations)


def test_tool_citations(spark):
    text = '{"gatk":{"name":"GATK","status":"confirmed","doi":"10.1/g"},"x":{"status":"confirmed"},"y":{"doi":"10.1/y"}}'
    got = rows(curation.tool_citations(spark.createDataFrame([(text,)], "content string")), "key", "status", "citable")
    assert got == [("gatk", "confirmed", True), ("x", "confirmed", False), ("y", "pending", False)]


def test_stored_records_are_read_tolerantly(spark):
    good = '{"subject":"s","state":"FAIL","extra":1,"inputs":{"config.yaml":"d"},"findings":[{"id":"S001","severity":"error","subject":"s"}]}'
    docs = spark.createDataFrame([(good,), ('{"subject":"t","state":"MAYBE"}',), ("{broken",)], "content string")
    recs, found = records.parse_records(docs)
    assert rows(recs, "subject", "state", "counts.n_error") == [("s", "FAIL", 1)]
    assert rows(found, "id", "severity") == [("S001", "error")]


def test_stored_datasets(spark):
    text = '{"subject":"s","published":true,"extra":[1],"objects":{"bams/a.bam":{"size":3000000000,"etag":"e"}},"samples":{"S1":{"mean_depth":15.5}},"sra":{"SRR1":[{"run":"SRR1","bioproject":"P"}]}}'
    got = records.parse_datasets(spark.createDataFrame([(text,), ("{broken",)], "content string"))
    assert rows(got.records, "subject", "published") == [("s", True)]
    assert rows(got.objects) == [("s", "bams/a.bam", 3000000000, "e")]
    assert rows(got.samples) == [("s", "S1", "mean_depth", 15.5)]
    assert rows(got.runs) == [("s", "SRR1", "SRR1", None, "P")]


def test_report_sink(spark, tmp_path):
    found = spark.createDataFrame([("S001", "error", "s"), ("S002", "warn", "s")], "id string, severity string, subject string")
    records.write_report(found, found.select("subject").distinct(), str(tmp_path / "r"))
    counts = rows(spark.read.json(str(tmp_path / "r" / "counts")), "severity", "n")
    assert counts == [("error", 1), ("info", 0), ("skipped", 0), ("warn", 1)]
    assert spark.read.json(str(tmp_path / "r" / "findings")).count() == 2


def test_table_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int").coalesce(1)
    records.write_table(df, str(tmp_path / "t"), ["x", "y", "w"], "\r\n")
    part = next((tmp_path / "t").glob("part-*"))
    assert part.read_bytes() == b"x,y,w\r\na,,\r\n"


def quoted(spark, texts, stretch=3, **more):
    """(line, value, whole) of the records of each text."""
    frame = spark.createDataFrame([(k, i, v) for k, t in enumerate(texts) for i, v in enumerate(t.split("\n"), 1)], "path int, line int, value string")
    out = [[] for _ in texts]
    for r in lines.quoted_records(frame.repartition(3), ["path"], stretch, **more).orderBy("path", "line").collect():
        out[r["path"]].append((r["line"], r["value"], r["whole"]))
    return out


def plain_records(text):
    import csv
    import io

    return [row or [""] for row in csv.reader(io.StringIO(text, newline=""))] or [[""]]


def test_quoted_fields_over_lines_match_a_plain_reader(spark):
    import random

    texts = [
        'a,b\n1,"x\ny"\n2,"p ""q""\n\n,r"\n3,z', '"', 'a"b,"c\nd",e\nx","y\nz"', '"a\n"b\n"c"\nd', 'a,5" pipe\nb,"6"" pipe\n7"\n8', "one line", '"",""\n"\n""\n",x',
    ]
    rng = random.Random(9)
    texts += ["".join(rng.choice(['"', '""', ",", "\n", "a", "b", ',"', '",']) for _ in range(rng.randint(5, 120))) for _ in range(60)]
    texts = [t.rstrip("\n") for t in texts if t.rstrip("\n")]
    for text, got in zip(texts, quoted(spark, texts), strict=True):
        assert [r[0] for r in got] == list(range(1, len(got) + 1)) and all(r[2] for r in got)
        # Joined again, each record is what the plain reader makes of its lines.
        assert [plain_records(v)[0] for _, v, _ in got] == plain_records(text), text


def test_an_endless_quote_costs_its_record_only(spark):
    (got,) = quoted(spark, ['h,i\n1,"open' + "\nline" * 40], longest=100)
    assert got == [(1, "h,i", True), (2, '1,"open', False)]


def test_sheet_with_line_ends_in_quotes(spark, tmp_path):
    folder = tmp_path / "birds" / "q"
    folder.mkdir(parents=True)
    (folder / "sample_sheet.csv").write_text('sample_id,input_type,input,note\r\nSAMN1,srr,SRR1,"two\r\nlines, ""so"""\r\n\r\nSAMN2,srr,SRR2,x\r\n', newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        scan = metadata.parse_sheets(lines.with_subject(lines.read_lines(spark, str(folder / "sample_sheet.csv"))))
        assert rows(scan.rows, "line", "sample_id", "extra") == [(2, "SAMN1", {"note": 'two\nlines, "so"'}), (4, "SAMN2", {"note": "x"})]
        assert rows(scan.issues, "line", "code") == [(3, "blank_row")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
