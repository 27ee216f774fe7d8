"""The tables a validation reads, and what is derived from several of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import schemas
from tallymark.functions.identifiers import counterpart, is_archive_input, is_assembly, is_biosample
from tallymark.operators.lookup import (
    authority_entry,
    best_scheme,
    named_schemes,
    resolve_published,
    scheme_strays,
)
from tallymark.operators.ranking import stable_sample
from tallymark.operators.rollup import (
    OPTIONAL_ARTIFACTS,
    REQUIRED_ARTIFACTS,
    counts_disagree,
    publication_status,
    set_fingerprint,
)
from tallymark.session import cut
from tallymark.sources.observed import SCHEMES, by_scheme, published

TABLES = {
    "subjects": "subject string, clade string, slug string, path string",
    "config": (
        "subject string, ref_name string, ref_source string, ploidy string, het_prior string, "
        "caller string, parsed boolean, body string, path string"
    ),
    "issues": schemas.ISSUES,
    "sheet": schemas.SHEET,
    "readme": (
        "subject string, text string, species string, accession string, "
        "bioprojects array<string>, path string"
    ),
    "authority": (
        "scientific_name string, taxid int, accession string, line int, slug string, binomial string"
    ),
    "objects": schemas.OBJECTS,
    "subdirs": "accession string, dir string",
    "vcf_lines": "subject string, line int, value string",
    "vcf_contigs": "subject string, contig string, length bigint",
    "vcf_samples": "subject string, pos int, sample string",
    "bam_records": "subject string, bam string, line int, tag string, fields map<string,string>",
    "qc_samples": "subject string, sample string",
    "published_sheet": schemas.SHEET,
    "published_readme": "subject string, text string",
    "assemblies": (
        "queried string, accession string, organism_name string, tax_id int, "
        "assembly_name string, assembly_level string, paired_accession string, error string"
    ),
    "assembly_seqs": (
        "accession string, line int, name string, role string, genbank string, refseq string, "
        "unit string, length bigint"
    ),
    "contig_map": "subject string, contig string, renamed string",
    "runs": (
        "run string, experiment string, biosample string, bioproject string, sample_name string"
    ),
    "lookups": "subject string, lookup string, error string",
}


# Derived tables worth writing once, and the slices whose checks read them.
SHARED = (
    (("sheet_names",), ("sheet", "runs")),
    (("declared", "located", "artifacts", "status"), ("objects", "status")),
    (("entry",), ("authority",)),
    (("chosen", "strays"), ("assembly_seqs",)),
)

# The slices whose checks need all samples of the sheet, not only the odd ones.
COMPARED = {"objects", "status", "vcf_header", "bam_headers", "qc_samples", "published_sheet"}


class Corpus:
    """Named tables; the ones not given are empty.

    Derived tables are described once per corpus; ``materialise`` computes
    the ones that many checks share.
    """

    # Whether ``sheet_names`` holds all samples.
    whole_names = True

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self.spark = spark
        self.given = frozenset(tables)
        for name, schema in TABLES.items():
            df = tables.get(name)
            # A zero limit lets the optimizer drop everything built on an absent table.
            empty = lambda: spark.createDataFrame([], schema).limit(0)
            setattr(self, name, empty() if df is None else df)

    def where(self, condition: Callable[[Column], Column]) -> Corpus:
        """The corpus of the subjects that meet a condition; it reaches the scan of every table with subjects."""
        return Corpus(self.spark, {
            name: df.filter(condition(F.col("subject"))) if "subject" in df.columns else df
            for name, df in ((n, getattr(self, n)) for n in self.given)
        })

    def only(self, subjects: DataFrame | Sequence[str]) -> Corpus:
        """The corpus of chosen subjects: their names, or a table with ``subject``.

        Names reach the scans as a filter. A table is joined to every table with
        subjects; objects and directories stay if they lie under an accession that one of
        the subjects may own.
        """
        if not isinstance(subjects, DataFrame):
            names = list(subjects)
            chosen = self.where(lambda subject: subject.isin(names))
        else:
            # Written once, so that every table is joined to the same rows.
            wanted = cut(subjects.select(F.col("subject").alias("_chosen")).distinct())
            chosen = Corpus(self.spark, {
                name: df.join(wanted, df["subject"] == wanted["_chosen"], "left_semi") if "subject" in df.columns else df
                for name, df in ((n, getattr(self, n)) for n in self.given)
            })
        own = chosen.declared.filter("declared IS NOT NULL").select(F.explode(F.array("declared", counterpart(F.col("declared")))).alias("accession")).distinct()
        for name in {"objects", "subdirs"} & self.given:
            setattr(chosen, name, getattr(chosen, name).join(own, "accession", "left_semi"))
        return chosen

    def materialise(self, slices: set[str] | None = None) -> "Corpus":
        """Write the derived tables many checks share and read them back.

        They hold a row or two per subject (and the contigs no scheme
        explains), so this is cheap, and every check then starts from a
        short plan instead of repeating their joins. Only those the given
        slices lead to are written.
        """
        for names, wanted in SHARED:
            if slices is None or slices & set(wanted):
                for name in names:
                    table = self.sheet_names_of(slices) if name == "sheet_names" else getattr(self, name)
                    setattr(self, name, cut(table))
                    if name == "sheet_names":
                        self.whole_names = slices is None or bool(slices & COMPARED)
        self.availability = cut(self.availability_of(slices))
        return self

    def failed(self, lookup: str) -> DataFrame:
        return self.lookups.filter((F.col("lookup") == lookup) & F.col("error").isNotNull()).select("subject")

    @cached_property
    def declared(self) -> DataFrame:
        """``subject, declared``: the accession the configuration names."""
        source = F.col("ref_source")
        return self.subjects.select("subject").join(
            self.config.select("subject", F.when(is_assembly(source), source).alias("declared")),
            "subject",
            "left",
        )

    @cached_property
    def sheet_names(self) -> DataFrame:
        """``subject, kind, name, path``: what the sheet names, once each; kind 'sheet' has a row a subject, and its path.

        One pass over the sheet serves every check that compares names.
        """
        return self.sheet_names_of(None)

    def sheet_names_of(self, slices: set[str] | None) -> DataFrame:
        """``sheet_names`` for the checks that need the given slices: archive inputs only for
        those with the runs, all samples only for those with another table of samples, else the odd ones.
        """
        sample, value = F.col("sample_id"), F.col("input")
        listed = sample.isNotNull() if slices is None or slices & COMPARED else ~is_biosample(sample)
        kinds = {"sheet": (F.lit(True), F.lit(None).cast("string")), "sample": (listed, sample)}
        if slices is None or "runs" in slices:
            kinds["archive input"] = (is_archive_input(value), value)
        named = F.array_compact(F.array(*[
            F.when(c, F.struct(F.lit(k).alias("kind"), n.alias("name"), (F.col("path") if k == "sheet" else F.lit(None).cast("string")).alias("path")))
            for k, (c, n) in kinds.items()
        ]))
        return self.sheet.select("subject", F.inline(named)).groupBy("subject", "kind", "name").agg(F.min("path").alias("path"))

    @cached_property
    def located(self) -> DataFrame:
        """``subject, declared, accession``: where the data was found."""
        return resolve_published(self.declared, published(self.objects, self.subdirs)).join(
            self.failed("listing"), "subject", "left_anti"
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """Objects with the subject they belong to."""
        return self.objects.join(
            self.located.filter("accession IS NOT NULL").select("subject", "accession"), "accession"
        )

    @cached_property
    def bams(self) -> DataFrame:
        """``subject, sample`` of every published alignment file."""
        name = F.col("name")
        return self.inventory.filter((F.col("dir") == "bams") & name.endswith(".bam")).select(
            "subject", F.expr("substring(name, 1, length(name) - 4)").alias("sample")
        )

    @cached_property
    def artifacts(self) -> DataFrame:
        """One row per subject with a flag per artifact and the counts."""
        o = self.inventory
        vcf = lambda n: F.max((F.col("dir") == "vcfs") & (F.col("name") == n))
        objects = o.groupBy("subject").agg(
            vcf("raw.vcf.gz").alias("raw_vcf"),
            vcf("raw.vcf.gz.tbi").alias("raw_vcf_index"),
            vcf("filtered.vcf.gz").alias("filtered_vcf"),
            F.max((F.col("dir") == "bams") & F.col("name").endswith(".bam")).alias("bams"),
            F.max((F.col("dir") == "<top>") & (F.col("name") == "README.txt")).alias("published_readme"),
            F.max(F.col("dir") == "qc").alias("_qc"),
            F.max(F.col("dir") == "callable_sites").alias("_sites"),
            F.count_if((F.col("dir") == "bams") & F.col("name").endswith(".bam")).alias("n_bams"),
        )
        dirs = (
            self.subdirs.filter("dir IS NOT NULL")
            .join(self.located.select("subject", "accession"), "accession")
            .groupBy("subject")
            .agg(
                F.max(F.col("dir") == "qc").alias("_qc2"),
                F.max(F.col("dir") == "callable_sites").alias("_sites2"),
            )
        )
        names = self.sheet_names if self.whole_names else self.sheet_names_of(COMPARED)
        sheet = names.filter("kind = 'sample'").groupBy("subject").agg(F.count(F.lit(1)).alias("n_sheet"))
        vcf_n = self.vcf_samples.groupBy("subject").agg(F.count(F.lit(1)).alias("n_vcf"))
        no = F.lit(False)
        return (
            self.located.join(objects.withColumn("_o", F.lit(True)), "subject", "left")
            .join(dirs.withColumn("_d", F.lit(True)), "subject", "left")
            .join(sheet, "subject", "left")
            .join(vcf_n, "subject", "left")
            .join(self.readme.select("subject", F.lit(True).alias("repo_readme")).distinct(), "subject", "left")
            .select(
                "subject", "declared", "accession",
                F.coalesce("_o", "_d", no).alias("listed"),
                *[F.coalesce(c, no).alias(c) for c in ("raw_vcf", "raw_vcf_index", "bams", "filtered_vcf", "published_readme", "repo_readme")],
                F.coalesce(F.greatest("_qc", "_qc2"), no).alias("qc"),
                F.coalesce(F.greatest("_sites", "_sites2"), no).alias("callable_sites"),
                F.coalesce("n_sheet", F.lit(0)).alias("n_sheet"),
                F.coalesce("n_bams", F.lit(0)).alias("n_bams"),
                "n_vcf",
            )
        )

    @cached_property
    def status(self) -> DataFrame:
        """Publication status; subjects whose listing failed have none."""
        full = publication_status(
            self.artifacts, ["subject"], REQUIRED_ARTIFACTS,
            [*OPTIONAL_ARTIFACTS], F.col("listed"),
        )
        extra = F.array_compact(
            F.array(
                F.when(F.col("published_readme"), F.lit("published_readme")),
                F.when(F.col("repo_readme"), F.lit("repo_readme")),
            )
        )
        return full.select(
            "subject", "state", "accession", F.col("declared").alias("declared_accession"),
            F.array_sort(F.concat("present", extra)).alias("present"),
            "missing", "missing_optional", "n_sheet", "n_bams",
            F.when(F.col("listed"), F.col("n_vcf")).alias("n_vcf"),
            F.coalesce(F.col("accession") != F.col("declared"), F.lit(False)).alias("accession_differs"),
        )

    @cached_property
    def disagreements(self) -> DataFrame:
        """Complete publications whose sample counts are not all the same."""
        return counts_disagree(self.status.filter("state = 'complete'"), ["n_sheet", "n_bams", "n_vcf"])

    @cached_property
    def data(self) -> DataFrame:
        """``subject, data``: what was published, precise enough to notice a change."""
        named = F.struct("name", F.concat(F.lit("etag:"), "etag").alias("etag"))
        kept = (
            (F.col("dir") == "vcfs") & F.col("name").isin("raw.vcf.gz", "raw.vcf.gz.tbi", "filtered.vcf.gz")
        ) | ((F.col("dir") == "<top>") & (F.col("name") == "sample_sheet.csv"))
        # At most one entry per named file.
        files = self.inventory.filter(kept).groupBy("subject").agg(F.array_sort(F.collect_list(named)).alias("objects"))
        bams = self.inventory.filter((F.col("dir") == "bams") & F.col("name").endswith(".bam")).select(
            "subject", F.concat_ws(":", F.expr("substring(name, 1, length(name) - 4)"), "etag").alias("item")
        )
        prints = set_fingerprint(bams, ["subject"], "item").select("subject", F.struct("count", "digest").alias("bams"))
        listed = F.col("listed")
        fields = F.struct(
            listed.alias("published"), F.coalesce("accession", "declared").alias("accession"),
            F.when(listed, F.coalesce("objects", F.array().cast("array<struct<name:string,etag:string>>"))).alias("objects"),
            F.col("bams"),
        )
        return (
            self.artifacts.select("subject", "listed", "accession", "declared")
            .join(files, "subject", "left")
            .join(prints, "subject", "left")
            .select("subject", fields.alias("data"))
        )

    @cached_property
    def complete(self) -> DataFrame:
        return self.status.filter("state = 'complete'").select("subject")

    @cached_property
    def entry(self) -> DataFrame:
        """The authority entry each subject resolves to."""
        return authority_entry(self.subjects.select("subject", "slug"), self.authority)

    @cached_property
    def observed(self) -> DataFrame:
        """Contigs of variant files with the declared accession."""
        return self.vcf_contigs.join(
            self.declared.filter("declared IS NOT NULL").select("subject", F.col("declared").alias("accession")),
            "subject",
        )

    @cached_property
    def names(self) -> DataFrame:
        """Sequence names per accession and naming scheme."""
        return by_scheme(self.assembly_seqs, ["accession"])

    @cached_property
    def named(self) -> DataFrame:
        """Observed contigs with the naming schemes that have them."""
        return named_schemes(self.observed, self.names, ["subject", "accession"], "contig", ["accession"])

    @cached_property
    def chosen(self) -> DataFrame:
        return best_scheme(self.named, ["subject", "accession"], SCHEMES)

    @cached_property
    def strays(self) -> DataFrame:
        return scheme_strays(self.named, self.chosen, ["subject", "accession"], "contig", SCHEMES)

    @cached_property
    def wanted(self) -> DataFrame:
        """Sequences of the chosen scheme, for subjects whose names all fit it."""
        coherent = self.chosen.join(self.strays.select("subject").distinct(), "subject", "left_anti")
        return self.names.join(coherent.select("subject", "accession", "scheme"), ["accession", "scheme"])

    @cached_property
    def availability(self) -> DataFrame:
        """``subject, have``: the slices at hand for each subject."""
        return self.availability_of(None)

    def availability_of(self, slices: set[str] | None) -> DataFrame:
        """``subject, have`` for the given slices alone; tables behind others are not read."""
        unread = ("missing_file", "unreadable", "parse_error")

        def read_sheets() -> DataFrame:
            reported = self.issues.filter((F.col("source") == "sheet") & ~F.col("code").isin(*unread))
            return self.sheet_names.filter("kind = 'sheet'").select("subject").unionByName(reported.select("subject"))

        def declared() -> DataFrame:
            return self.declared.filter("declared IS NOT NULL")

        def known(table: DataFrame, key: str) -> DataFrame:
            return declared().join(table.select(F.col(key).alias("declared")), "declared", "left_semi")

        def archive() -> DataFrame:
            return self.sheet_names.filter("kind = 'archive input'").join(self.failed("runs"), "subject", "left_anti")

        branches = {
            "config": lambda: self.config.filter("parsed"),
            "sheet": read_sheets,
            "readme": lambda: self.readme,
            "objects": lambda: self.artifacts.filter("listed"),
            "vcf_header": lambda: self.vcf_lines,
            "bam_headers": lambda: self.bam_records,
            "qc_samples": lambda: self.qc_samples,
            "published_sheet": lambda: self.published_sheet,
            "contig_map": lambda: self.contig_map,
            "assembly": lambda: known(self.assemblies.filter("error IS NULL AND accession IS NOT NULL"), "queried"),
            "assembly_seqs": lambda: known(self.assembly_seqs, "accession"),
        }
        # Without the table these are at hand for nobody.
        if "authority" in self.given:
            branches["authority"] = lambda: self.subjects
        if "runs" in self.given:
            branches["runs"] = archive
        if "objects" in self.given:
            branches["status"] = lambda: self.located
        subjects = self.subjects.select("subject")
        # Each slice is reduced to its subjects before the slices meet.
        parts = [
            rows().select("subject").distinct().withColumn("slice", F.lit(name))
            for name, rows in branches.items()
            if slices is None or name in slices
        ]
        none = F.array().cast("array<string>")
        if not parts:
            return subjects.withColumn("have", none)
        have = reduce(DataFrame.unionByName, parts).groupBy("subject").agg(F.collect_set("slice").alias("have"))
        return subjects.join(have, "subject", "left").select("subject", F.coalesce("have", none).alias("have"))

    def sampled_bams(self, size: int, seed: str = "0") -> DataFrame:
        """The alignment files whose headers are worth reading."""
        return stable_sample(self.bams, ["subject"], "sample", size, seed)
