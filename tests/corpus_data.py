"""A hand-written corpus: one clean subject, one faulty, one unpublished."""

from tallymark.plans.corpus import TABLES, Corpus

GOOD, BAD, NEW = "birds/good-bird", "birds/bad-bird", "fish/new-fish"

SUBJECTS = [
    (GOOD, "birds", "good-bird", "p/good"),
    (BAD, "birds", "bad-bird", "p/bad"),
    (NEW, "fish", "new-fish", "p/new"),
]
CONFIG = [
    (GOOD, "Good_bird", "GCA_000000001.1", "2", "0.005", "gatk", True, "{}", "p/good/config.yaml"),
    (BAD, "Other_name", "GCF_000000002.1", "4", "0.001", "bcftools", True, "{}", "p/bad/config.yaml"),
    (NEW, "GCA_000000003.1", "not-a-source", None, None, None, True, "{}", "p/new/config.yaml"),
]


def sheet_row(subject, line, sample, kind, value, lib=None):
    return (subject, line, sample, kind, value, lib, {}, f"{subject}/sample_sheet.csv")


SHEET = [
    sheet_row(GOOD, 2, "SAMN1", "srr", "SRR1", "L1"),
    sheet_row(GOOD, 3, "SAMN2", "srr", "SRR2"),
    sheet_row(GOOD, 4, "SAMN2", "srr", "SRX3"),
    sheet_row(BAD, 2, "SAMN7", "srr", "SRR7", "LX"),
    sheet_row(BAD, 3, "odd8", "fastq", "/data/x.fq"),
    sheet_row(BAD, 4, "SAMN9", "srr", "nonsense"),
    sheet_row(BAD, 5, "SAMN10", "srr", "SRX10"),
    sheet_row(BAD, 6, "SAMN11", "srr", "SRR404"),
    sheet_row(NEW, 2, "SAMN20", "srr", "SRR20"),
]
RUNS = [
    ("SRR1", "SRX1", "SAMN1", "PRJNA1", None),
    ("SRR2", "SRX2", "SAMN2", "PRJNA1", None),
    ("SRR3", "SRX3", "SAMN2", "PRJNA1", None),
    ("SRR7", "SRX7", "SAMN99", "PRJNA7", None),
    ("SRR10", "SRX10", "SAMN10", "PRJNA7", None),
    ("SRR10b", "SRX10", "SAMN10", "PRJNA7", None),
    ("SRR20", "SRX20", "SAMN20", "PRJNA20", None),
]
ISSUES = [
    (BAD, "config", "missing_key", "config has no samples: key", "p/bad/config.yaml", None),
    (BAD, "sheet", "short_row", "row has 2 field(s)", "p/bad/s.csv", 9),
    (BAD, "sheet", "empty_sample_id", "sample_id is empty", "p/bad/s.csv", 10),
    (BAD, "sheet", "unknown_input_type", "odd", "p/bad/s.csv", 11),
    (BAD, "sheet", "duplicate_run", "twice", "p/bad/s.csv", 12),
    (BAD, "sheet", "blank_row", "blank row skipped", "p/bad/s.csv", 13),
]
README = [
    (GOOD, "Species: x\nPRJNA1", "x", "GCA_000000001.1", ["PRJNA1"], "p/good/README.txt"),
    (BAD, "Species: y\nPRJNA8", "y", "GCA_000000009.9", ["PRJNA8"], "p/bad/README.txt"),
]
AUTHORITY = [
    ("Good bird", 11, "GCA_000000001.1", 2, "good-bird", "good-bird"),
    ("Bad bird", 12, "GCA_000000002.1", 3, "bad-bird", "bad-bird"),
    ("Lost frog", 13, "GCA_000000050.1", 4, "lost-frog", "lost-frog"),
]


def obj(acc, d, name, size=10):
    key = f"x/{acc}/{name}" if d == "<top>" else f"x/{acc}/{d}/{name}"
    return (acc, d, name, key, size, f"e-{name}", "2024-01-01")


A1, A2 = "GCA_000000001.1", "GCA_000000002.1"
OBJECTS = [
    obj(A1, "vcfs", "raw.vcf.gz"), obj(A1, "vcfs", "raw.vcf.gz.tbi"),
    obj(A1, "bams", "SAMN1.bam"), obj(A1, "bams", "SAMN1.bam.csi"),
    obj(A1, "bams", "SAMN2.bam"), obj(A1, "bams", "SAMN2.bam.bai"),
    obj(A1, "qc", "individuals.samps.txt"), obj(A1, "<top>", "README.txt"),
    # Published under the other form of what the configuration names.
    obj(A2, "vcfs", "raw.vcf.gz"),
    obj(A2, "bams", "SAMN7.bam"), obj(A2, "bams", "odd8.bam", 0), obj(A2, "bams", "odd8.bam.csi"),
    obj(A2, "qc", "x.tsv"),
    obj("GCA_000000050.1", "bams", "z.bam"), obj("GCA_000000060.1", "bams", "z.bam"),
]
SUBDIRS = [(A1, "callable_sites"), (A1, "qc"), (A2, None)]
VCF_LINES = [
    (GOOD, 1, '##GATKCommandLine=<ID=HaplotypeCaller,CommandLine="--sample-ploidy 2 --heterozygosity 5e-3",Version="4.6.2.0">'),
    (BAD, 1, '##GATKCommandLine=<ID=HaplotypeCaller,CommandLine="--sample-ploidy 2 --heterozygosity 0.005",Version="4.6.2.0">'),
    (BAD, 2, "##bcftools_concatVersion=1.20+htslib"),
]
VCF_CONTIGS = [
    (GOOD, "CM1.1", 100), (GOOD, "CM2.1", None), (GOOD, "CM3.1", 5),
    (BAD, "CM7.1", 71), (BAD, "NC_8.1", 80), (BAD, "mystery", 5),
]
VCF_SAMPLES = [(GOOD, 0, "SAMN1"), (GOOD, 1, "SAMN2"), (BAD, 0, "SAMN7"), (BAD, 1, "ghost")]
SEQS = [
    ("GCA_000000001.1", 1, "1", "assembled-molecule", "CM1.1", "NC_1.1", "P", 100),
    ("GCA_000000001.1", 2, "2", "assembled-molecule", "CM2.1", "NC_2.1", "P", 50),
    ("GCA_000000001.1", 3, "3", "unplaced-scaffold", "CM3.1", None, "P", 5),
    ("GCF_000000002.1", 1, "7", "assembled-molecule", "CM7.1", "NC_7.1", "P", 70),
    ("GCF_000000002.1", 2, "8", "assembled-molecule", "CM8.1", "NC_8.1", "P", 80),
]


def bam(subject, name, sm, lb, lengths, ref="Good_bird"):
    out = [
        (subject, name, 1, "RG", {"ID": "1", "SM": sm, "LB": lb}),
        (subject, name, 2, "PG", {"ID": "bwa", "PN": "bwa", "CL": f"bwa mem results/reference/{ref}.fa.gz r1"}),
    ]
    return out + [
        (subject, name, 3 + i, "SQ", {"SN": k, "LN": str(v)}) for i, (k, v) in enumerate(lengths.items())
    ]


BAMS = [
    *bam(GOOD, "SAMN1", "SAMN1", "L1", {"CM1.1": 100, "CM2.1": 50, "CM3.1": 5}),
    *bam(GOOD, "SAMN2", "SAMN2", "L2", {"CM1.1": 100, "CM2.1": 50, "CM3.1": 5}),
    *bam(BAD, "SAMN7", "other", "LY", {"CM7.1": 70, "NC_8.1": 80}),
    *bam(BAD, "odd8", "odd8", "LZ", {"CM7.1": 71, "NC_8.1": 80, "mystery": 5}),
]
ASSEMBLIES = [
    ("GCA_000000001.1", "GCA_000000001.1", "Good bird", 11, "g1", "Chromosome", "GCF_000000001.1", None),
    ("GCF_000000002.1", "GCF_000000002.1", "Bad bird", 99, "b1", "Chromosome", "GCA_000000002.1", None),
]
DATA = {
    "subjects": SUBJECTS, "config": CONFIG, "issues": ISSUES, "sheet": SHEET, "readme": README,
    "authority": AUTHORITY, "objects": OBJECTS, "subdirs": SUBDIRS, "vcf_lines": VCF_LINES,
    "vcf_contigs": VCF_CONTIGS, "vcf_samples": VCF_SAMPLES, "bam_records": BAMS,
    "qc_samples": [(GOOD, "SAMN1"), (GOOD, "SAMN2"), (BAD, "SAMN7")],
    "published_sheet": [
        *[r for r in SHEET if r[0] == GOOD],
        sheet_row(BAD, 2, "SAMN7", "srr", "SRR7"),
    ],
    "published_readme": [(GOOD, "Species: x  \r\nPRJNA1\n")],
    "assemblies": ASSEMBLIES, "assembly_seqs": SEQS,
    "contig_map": [(GOOD, "CM1.1", "1"), (BAD, "CM7.1", "1"), (BAD, "invented", "2")],
    "runs": RUNS,
    "lookups": [(NEW, "literature", "timed out")],
}


def write_corpus(spark, root):
    """The tables as small parquet files, so that checks read like they do in use."""
    for name, rows in DATA.items():
        spark.createDataFrame(rows, TABLES[name]).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")


def read_corpus(spark, root, **changes):
    """The corpus on disk, with some tables replaced or (``None``) left out."""
    tables = {}
    for name in DATA:
        if name not in changes:
            tables[name] = spark.read.parquet(f"{root}/{name}")
        elif changes[name] is not None:
            tables[name] = spark.createDataFrame(changes[name], TABLES[name]).coalesce(1)
    return Corpus(spark, tables)
