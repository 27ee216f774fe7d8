"""The observed side: listings, quality tables, file headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import base_name, strip
from tallymark.functions.values import as_number
from tallymark.operators.ranking import first_per_key, last_per_key
from tallymark.sources.lines import tab_fields
from tallymark.sources.metadata import Scan, headed_table

# Directories listed but never descended into.
OPAQUE_DIRS = ("callable_sites",)

# Naming schemes of an assembly table, first choice first.
SCHEMES = ("genbank", "refseq", "name")

# Header lines that identify a variant caller.
CALLER_PATTERNS = (
    ("gatk", r"^##GATKCommandLine=<ID=(?:HaplotypeCaller|GenotypeGVCFs|Mutect2)\b"),
    ("gatk", r"^##source=(?:HaplotypeCaller|GenotypeGVCFs|Mutect2)\b"),
    ("bcftools", r"^##bcftools_callCommand="),
    ("bcftools", r"^##source=bcftools_call\b"),
    ("deepvariant", r"^##DeepVariant"),
    ("deepvariant", r"^##source=DeepVariant\b"),
    ("sentieon", r"^##source=(?:Sentieon|DNAscope|DNAseq)\b"),
    ("freebayes", r"^##source=freeBayes\b"),
)

# Columns kept of each per-sample table, their metric and kind.
SAMPLE_METRICS = {
    "qc_report": {
        "mean_depth": ("mean_depth", "double"),
        "percent_mapped": ("percent_mapped", "double"),
        "percent_duplicates": ("percent_duplicates", "double"),
        "percent_properly_paired": ("percent_properly_paired", "double"),
        "fraction_passed": ("fraction_passed", "double"),
        "total_reads": ("total_reads", "bigint"),
        "reads_before_filtering": ("reads_before_filtering", "bigint"),
        "reads_after_filtering": ("reads_after_filtering", "bigint"),
        "covered_bases": ("covered_bases", "bigint"),
    },
    "idepth": {
        "MEAN_DEPTH": ("depth_at_called_sites", "double"),
        "N_SITES": ("n_sites_called", "bigint"),
    },
    "het": {"F": ("f_inbreeding", "double")},
    "imiss": {"F_MISS": ("f_missing", "double"), "N_MISS": ("n_missing", "bigint")},
}

# The column naming the sample, by table.
SAMPLE_KEY = {"qc_report": "sample", "idepth": "INDV", "het": "INDV", "imiss": "INDV"}

CONTENTS = "Key string, Size bigint, ETag string, LastModified string"


def split_key(key: Column) -> dict[str, Column]:
    """Accession, first directory below it and object name of a key."""
    accession = F.regexp_extract(key, r"(?:^|/)(GC[AF]_\d+\.\d+)/", 1)
    rest = F.regexp_extract(key, r"(?:^|/)GC[AF]_\d+\.\d+/(.*)$", 1)
    return {
        "accession": F.nullif(accession, F.lit("")),
        "dir": F.when(rest.contains("/"), F.substring_index(rest, "/", 1)).otherwise("<top>"),
        "name": base_name(key),
        "path": rest,
    }


def objects_from_contents(contents: DataFrame) -> DataFrame:
    """Objects of a listing; directory markers dropped, entity tags unquoted."""
    parts = split_key(F.col("Key"))
    return (
        contents.filter(F.col("Key").isNotNull() & ~F.col("Key").endswith("/"))
        .select(
            parts["accession"].alias("accession"),
            parts["dir"].alias("dir"),
            parts["name"].alias("name"),
            F.col("Key").alias("key"),
            F.coalesce("Size", F.lit(0)).alias("size"),
            F.btrim(F.coalesce("ETag", F.lit("")), F.lit('"')).alias("etag"),
            F.coalesce("LastModified", F.lit("")).alias("last_modified"),
        )
        .filter("accession IS NOT NULL")
    )


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Objects of saved listing documents."""
    rows = spark.read.format("xml").option("rowTag", "Contents").schema(CONTENTS).load(path)
    return objects_from_contents(rows)


def read_subdirs(spark: SparkSession, path: str) -> DataFrame:
    """``(accession, dir)`` of the prefixes a delimited listing returns."""
    rows = spark.read.format("xml").option("rowTag", "CommonPrefixes").schema("Prefix string").load(path)
    prefix = F.rtrim(F.regexp_replace("Prefix", "/+$", ""))
    inside = F.regexp_extract(prefix, r"(GC[AF]_\d+\.\d+)/([^/]+)$", 1)
    return rows.select(
        F.when(inside != "", inside)
        .otherwise(F.regexp_extract(prefix, r"(GC[AF]_\d+\.\d+)$", 1))
        .alias("accession"),
        F.when(inside != "", base_name(prefix)).alias("dir"),
    ).filter("accession <> ''")


def published(objects: DataFrame, subdirs: DataFrame) -> DataFrame:
    """Distinct accessions that list anything."""
    return objects.select("accession").unionByName(subdirs.select("accession")).distinct()


def keyed_table(lines: DataFrame, keys: list[str], key: str) -> Scan:
    """Rows of a keyed table, the last one winning; unkeyed rows as issues."""
    rows = headed_table(lines, keys).withColumn(
        key, F.coalesce(F.try_element_at("cells", F.lit(key)), F.lit(""))
    )
    named = last_per_key(rows.filter(F.col(key) != ""), [*keys, key], ["line"])
    unkeyed = rows.filter(F.col(key) == "").select(*keys, "line", "cells")
    return Scan(named, unkeyed)


def parameter_row(lines: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """First data row of each table as numbers; text that is none becomes null."""
    first = first_per_key(headed_table(lines, keys), keys, ["line"])
    return first.select(
        *keys, *[as_number(F.try_element_at("cells", F.lit(n))).alias(n) for n in names]
    )


def contig_map(lines: DataFrame, keys: list[str]) -> DataFrame:
    rows = headed_table(lines, keys)
    cell = lambda n: F.coalesce(F.try_element_at("cells", F.lit(n)), F.lit(""))
    return rows.select(
        *keys, cell("original_contig").alias("contig"), cell("plink_contig").alias("renamed")
    ).filter("contig <> ''")


def assembly_sequences(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Sequences of assembly tables, by position; ``na`` and blanks are null."""
    f = tab_fields(F.col("value"))
    text = lambda i: strip(F.get(f, F.lit(i)))
    known = lambda i: F.when(~text(i).isin("", "na"), text(i))
    return (
        lines.filter(~F.col("value").startswith("#") & (F.size(f) >= 9))
        .select(
            *keys,
            "line",
            text(0).alias("name"),
            text(1).alias("role"),
            known(4).alias("genbank"),
            known(6).alias("refseq"),
            text(7).alias("unit"),
            F.when(text(8).rlike(r"^\d+$"), text(8).try_cast("bigint")).alias("length"),
        )
    )


def by_scheme(sequences: DataFrame, keys: list[str]) -> DataFrame:
    """One row per sequence and naming scheme it has a name in; last row wins."""
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("scheme"), F.col(s).alias("contig"))
            for s in SCHEMES
        ]
    )
    rows = sequences.select(*keys, "line", "role", "length", F.inline(pairs)).filter(
        "contig IS NOT NULL AND contig <> ''"
    )
    return last_per_key(rows, [*keys, "scheme", "contig"], ["line"]).drop("line")


# -- variant file headers ---------------------------------------------------


def header_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("value").startswith("#"))


def vcf_contigs(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Declared contigs; the length may be unknown and the last line wins."""
    body = F.regexp_extract("value", r"^##contig=<(.*)>\s*$", 1)
    length = F.regexp_extract(body, r"\blength=(\d+)", 1)
    rows = header_lines(lines).select(
        *keys,
        "line",
        F.regexp_extract(body, r"\bID=([^,>]+)", 1).alias("contig"),
        F.when(length != "", length.try_cast("bigint")).alias("length"),
    )
    return last_per_key(rows.filter("contig <> ''"), [*keys, "contig"], ["line"]).drop("line")


def vcf_samples(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Sample columns of the column line, in order."""
    rows = lines.filter(F.col("value").startswith("#CHROM"))
    cells = F.split(F.regexp_replace("value", "\r$", ""), "\t", -1)
    samples = F.when(F.size(cells) > 9, F.slice(cells, F.lit(10), F.size(cells) - 9))
    return rows.select(*keys, F.posexplode(samples).alias("pos", "sample"))


def meta_values(lines: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Values of every ``##key=`` line with their line number."""
    prefix = f"##{key}="
    return lines.filter(F.col("value").startswith(prefix)).select(
        *keys, "line", F.substr(F.col("value"), F.lit(len(prefix) + 1)).alias("value")
    )


def meta_keys(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct ``##key`` names with the line they first appear on."""
    name = F.regexp_extract("value", r"^##([^=]*)=", 1)
    found = lines.filter(F.col("value").rlike("^##[^=]*=")).select(*keys, "line", name.alias("meta_key"))
    return found.groupBy(*keys, "meta_key").agg(F.min("line").alias("line"))


def command_argument(lines: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """First value of ``--flag`` over the recorded command lines."""
    value = F.regexp_extract("value", rf'--{flag}\s+([^\s"]+)', 1)
    found = meta_values(lines, keys, "GATKCommandLine").select(*keys, "line", value.alias("argument"))
    return first_per_key(found.filter("argument <> ''"), keys, ["line"]).select(*keys, "argument")


def tool_ids(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Ids of recorded tool invocations with the line they first appear on."""
    tool = F.regexp_extract("value", r"^<ID=([^,>]+)", 1)
    found = meta_values(lines, keys, "GATKCommandLine").select(*keys, "line", tool.alias("tool"))
    return found.filter("tool <> ''").groupBy(*keys, "tool").agg(F.min("line").alias("line"))


def tool_versions(lines: DataFrame, keys: list[str]) -> DataFrame:
    """First recorded version of each component."""
    gatk = F.regexp_extract("value", r'^##GATKCommandLine=.*?Version="?([0-9][^",\s]*)', 1)
    bcftools = F.regexp_extract("value", r"^##bcftools_\w+Version=(\S+)", 1)
    rows = header_lines(lines).select(
        *keys,
        "line",
        F.when(gatk != "", "gatk").when(bcftools != "", "bcftools").alias("component"),
        F.when(gatk != "", gatk).otherwise(F.substring_index(bcftools, "+", 1)).alias("version"),
    )
    return first_per_key(rows.filter("component IS NOT NULL"), [*keys, "component"], ["line"]).drop("line")


def classify_lines(
    lines: DataFrame, keys: list[str], patterns=CALLER_PATTERNS, value: str = "value"
) -> DataFrame:
    """Distinct ``(keys, label)`` for which some line matches a pattern."""
    hits = F.array_compact(
        F.array(*[F.when(F.col(value).rlike(p), F.lit(label)) for label, p in patterns])
    )
    return lines.select(*keys, F.explode(F.array_distinct(hits)).alias("label")).distinct()


# -- alignment file headers -------------------------------------------------


def tag_records(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``@TAG`` lines as ``tag`` and a map of its fields, split at the first colon."""
    chunks = F.slice(
        tab_fields(F.col("value")), F.lit(2), F.greatest(F.size(tab_fields(F.col("value"))) - 1, F.lit(0))
    )
    pairs = F.transform(
        chunks,
        lambda c, i: F.struct(
            F.substring_index(c, ":", 1).alias("k"),
            F.when(c.contains(":"), F.substr(c, F.length(F.substring_index(c, ":", 1)) + 2))
            .otherwise("")
            .alias("v"),
            i.alias("i"),
        ),
    )
    # A repeated field keeps its last value.
    kept = F.filter(
        pairs,
        lambda p: (p["k"] != "")
        & ~F.exists(pairs, lambda q: (q["k"] == p["k"]) & (q["i"] > p["i"])),
    )
    return lines.filter(F.col("value").rlike("^@[A-Za-z0-9]+\t")).select(
        *keys,
        "line",
        F.regexp_extract("value", "^@([A-Za-z0-9]+)\t", 1).alias("tag"),
        F.map_from_entries(F.transform(kept, lambda p: F.struct(p["k"], p["v"]))).alias("fields"),
    )


def tag_values(records: DataFrame, keys: list[str], tag: str, field: str, out: str) -> DataFrame:
    """Distinct non-empty values of one field of one tag."""
    value = F.try_element_at("fields", F.lit(field))
    return (
        records.filter(F.col("tag") == tag)
        .select(*keys, value.alias(out))
        .filter(F.coalesce(F.col(out), F.lit("")) != "")
        .distinct()
    )


def reference_lengths(records: DataFrame, keys: list[str]) -> DataFrame:
    """Sequence dictionary of each file; of a name given again the last line counts."""
    named = records.filter("tag = 'SQ'").select(
        *keys, "line",
        F.try_element_at("fields", F.lit("SN")).alias("contig"),
        F.try_element_at("fields", F.lit("LN")).try_cast("bigint").alias("length"),
    )
    return last_per_key(named, [*keys, "contig"], ["line"]).drop("line")


def aligner_reference(records: DataFrame, keys: list[str]) -> DataFrame:
    """Base name of the reference on the aligner's command line."""
    f = lambda k: F.coalesce(F.try_element_at("fields", F.lit(k)), F.lit(""))
    path = F.regexp_extract(f("CL"), r"(?:^|\s)(\S+?)\.fa(?:\.gz)?(?=\s|$)", 1)
    rows = (
        records.filter((F.col("tag") == "PG") & ((f("PN") == "bwa") | (f("ID") == "bwa")))
        .select(*keys, "line", base_name(path).alias("reference"))
        .filter("reference <> ''")
    )
    return first_per_key(rows, keys, ["line"]).select(*keys, "reference")
