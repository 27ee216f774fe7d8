"""The harvest job: metrics per sample and one data set record per subject."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.identifiers import is_archive_input
from tallymark.functions.values import as_whole
from tallymark.operators.gates import codes_present
from tallymark.operators.lookup import resolve_runs
from tallymark.operators.rollup import (
    constant_column,
    extremes,
    histogram,
    long_metrics,
    merge_metrics,
    quantiles,
    sizes_by_prefix,
)
from tallymark.plans.corpus import Corpus
from tallymark.sources.observed import (
    SAMPLE_KEY,
    SAMPLE_METRICS,
    classify_lines,
    command_argument,
    keyed_table,
    tool_versions,
)

# Metrics whose distribution over samples is reported.
COHORT_METRICS = (
    "mean_depth",
    "percent_mapped",
    "percent_duplicates",
    "f_missing",
    "f_inbreeding",
)
KEYS = ["subject", "sample"]


def _cell(name: str) -> Column:
    return F.try_element_at("cells", F.lit(name))


def sample_rows(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Keyed rows of each per-sample table, given as its lines with ``subject``."""
    return {
        name: keyed_table(lines, ["subject"], SAMPLE_KEY[name]).rows.withColumnRenamed(SAMPLE_KEY[name], "sample")
        for name, lines in tables.items()
    }


def metrics(rows: Mapping[str, DataFrame]) -> DataFrame:
    """``subject, sample, metric, value`` over all tables."""
    long = []
    for name, df in rows.items():
        columns = SAMPLE_METRICS[name]
        wide = df.select(*KEYS, *[_cell(c).alias(c) for c in columns])
        long.append(long_metrics(wide, KEYS, columns))
    union = long[0]
    for df in long[1:]:
        union = union.unionByName(df)
    return union


def wide_metrics(long: DataFrame) -> DataFrame:
    names = [metric for columns in SAMPLE_METRICS.values() for metric, _ in columns.values()]
    return merge_metrics([long], KEYS, names)


def cohort_sites(imiss: DataFrame) -> DataFrame:
    """The site count every sample repeats, null where they do not agree."""
    sites = imiss.select("subject", as_whole(_cell("N_DATA")).alias("_n")).filter("_n IS NOT NULL")
    return constant_column(sites, ["subject"], "_n").withColumnRenamed("value", "n_sites")


def summaries(long: DataFrame) -> DataFrame:
    """Five-number summary per subject and reported metric."""
    return quantiles(long.filter(F.col("metric").isin(*COHORT_METRICS)), ["subject", "metric"], "value")


def depth_histogram(long: DataFrame) -> DataFrame:
    return histogram(long.filter("metric = 'mean_depth'"), ["subject"], "value")


def depth_extremes(long: DataFrame) -> DataFrame:
    return extremes(long.filter("metric = 'mean_depth'"), ["subject"], "sample", "value")


def attributed_runs(corpus: Corpus) -> DataFrame:
    """Runs behind every sheet input: ``subject, sample_id, input, run, biosample, bioproject``."""
    rows = corpus.sheet.filter(is_archive_input(F.col("input"))).select("subject", "sample_id", "input").distinct()
    resolved = resolve_runs(rows, corpus.runs, "input").select("input", "run", "biosample", "bioproject")
    return rows.join(resolved, "input")


def provenance(corpus: Corpus) -> DataFrame:
    """What the variant file's header records, one row per subject."""
    lines, k = corpus.vcf_lines, ["subject"]
    # Callers and components are bounded by the patterns that find them.
    callers = classify_lines(lines, k).groupBy("subject").agg(F.array_sort(F.collect_set("label")).alias("callers"))
    versions = tool_versions(lines, k).groupBy("subject").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("component", "version")))).alias("tool_versions")
    )
    out = lines.select("subject").distinct().join(callers, "subject", "left").join(versions, "subject", "left")
    counts = {"n_contigs": corpus.vcf_contigs, "n_samples": corpus.vcf_samples}
    for name, df in counts.items():
        out = out.join(df.groupBy("subject").agg(F.count(F.lit(1)).alias(name)), "subject", "left")
    for name, flag in (("ploidy", "sample-ploidy"), ("het_prior", "heterozygosity")):
        out = out.join(command_argument(lines, k, flag).withColumnRenamed("argument", name), "subject", "left")
    return out


def datasets(corpus: Corpus, cohort: DataFrame, harvested_at: str, tool_version: str) -> DataFrame:
    """One record per subject; samples, runs and objects stay tables of their own.

    ``cohort`` has ``subject`` and the cohort's columns, such as the site
    count and the coverage thresholds.
    """
    sizes = sizes_by_prefix(
        corpus.inventory.withColumn("_p", F.concat_ws("/", "dir", "name")),
        ["subject"], "_p", "size", ("bams/", "vcfs/", "qc/", "callable_sites/"),
    )
    assembly = corpus.assemblies.filter("error IS NULL").select(
        F.col("queried").alias("accession"), "organism_name", "tax_id", "assembly_name", "assembly_level", "paired_accession"
    )

    def packed(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(key, F.struct(*[c for c in df.columns if c != key]).alias(name))

    return (
        corpus.artifacts.select(
            "subject", F.coalesce("accession", "declared").alias("accession"),
            F.col("declared").alias("declared_accession"), F.col("listed").alias("published"),
        )
        .join(packed(sizes, "subject", "objects"), "subject", "left")
        .join(packed(assembly, "accession", "assembly"), "accession", "left")
        .join(packed(provenance(corpus), "subject", "vcf"), "subject", "left")
        .join(packed(cohort, "subject", "cohort"), "subject", "left")
        .withColumn("harvested_at", F.lit(harvested_at))
        .withColumn("tool_version", F.lit(tool_version))
    )


def deviations(corpus: Corpus, records: DataFrame) -> DataFrame:
    """Facts of a data set that depart from what is expected of it."""
    listed = corpus.authority.select(F.col("accession"), F.col("accession").alias("_own"))
    by_name = corpus.entry.select("subject", F.col("accession").alias("_listed"))
    merged = (
        records.join(listed.distinct(), "accession", "left")
        .join(by_name, "subject", "left")
        .withColumn("_canonical", F.coalesce("_own", "_listed"))
    )
    facts = codes_present(
        [
            ("not_canonical", F.col("_canonical") != F.col("accession"), F.col("_canonical")),
            ("ploidy", F.col("vcf.ploidy") != "2", F.col("vcf.ploidy")),
            ("accession", F.col("declared_accession") != F.col("accession"), F.col("declared_accession")),
        ]
    )
    return merged.select("subject", F.inline(facts))
