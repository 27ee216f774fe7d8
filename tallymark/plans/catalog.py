"""The check catalogue.

Each check is a function from a :class:`~tallymark.plans.corpus.Corpus` to
findings over all subjects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.identifiers import (
    is_archive_input,
    is_assembly,
    is_biosample,
    is_experiment,
    is_local_input,
    is_local_source,
    is_url,
    same_assembly,
)
from tallymark.functions.text import describe, normalized_document, slugify, strip
from tallymark.functions.values import as_finite, as_whole, close_enough
from tallymark.operators.lookup import candidates_by_slug, resolve_runs
from tallymark.operators.ranking import described, first_n, numbered
from tallymark.operators.reconcile import (
    map_differences,
    missing_from,
    reconcile_sets,
    sequences_differ,
    set_equals,
    two_sided,
    unlike_first,
)
from tallymark.operators.rollup import missing_share
from tallymark.plans.checks import CHECKS, RETIRED
from tallymark.plans.corpus import Corpus
from tallymark.plans.registry import finding, lookup_findings, pick, row_rule, run_checks, slices_of, table_of_checks, text
from tallymark.sources.observed import (
    aligner_reference,
    classify_lines,
    command_argument,
    reference_lengths,
    tag_values,
    tool_ids,
)

# Percentage of assembly bases that may be absent before F009 warns.
MISSING_PERCENT = 1.0

# Which loader issue becomes which finding.
CONFIG_CODES = {
    "missing_file": "R001",
    "unreadable": "R001",
    "parse_error": "R001",
    "missing_key": "R001",
}
SHEET_CODES = {
    "missing_file": "R010",
    "unreadable": "R010",
    "parse_error": "R010",
    "missing_column": "R010",
    "short_row": "R010",
    "empty_sample_id": "R011",
    "unknown_input_type": "R012",
    "duplicate_run": "R014",
}

REVIEW = "; either side may be out of date, so a person has to decide"


def issue_parts(codes: dict[str, str]) -> dict:
    """Issues whose code is mapped; the others stay silent."""
    mapping = F.create_map(*[F.lit(v) for pair in codes.items() for v in pair])
    id = F.try_element_at(mapping, F.col("code"))
    return {"when": id.isNotNull(), "id": id, "message": F.col("message"), "detail": F.col("code"), "path": F.col("path"), "line": F.col("line")}


def issues_to_findings(issues: DataFrame, codes: dict[str, str], severity: str = "error") -> DataFrame:
    """Findings of a table of issues, whatever their source."""
    parts = issue_parts(codes)
    return finding(issues.filter(parts.pop("when")), severity=severity, **parts)


def either_side(left: str, right: str) -> Column:
    """``only in …`` parts for the sides that have strays."""
    return F.concat_ws(
        "; ",
        F.when(F.col("n_only_left") > 0, text(f"only in {left}: ", F.col("only_left"))),
        F.when(F.col("n_only_right") > 0, text(f"only in {right}: ", F.col("only_right"))),
    )


def set_check(left, right, key, id, severity, left_name, right_name, paths=None) -> DataFrame:
    diff = reconcile_sets(left, right, ["subject"], key)
    path = None
    if paths is not None:
        diff = diff.join(paths, "subject", "left")
        path = F.col("path")
    return finding(
        diff, id, severity,
        text(f"{left_name} (", F.col("n_left"), f") and {right_name} (", F.col("n_right"), ") do not hold the same samples"),
        text(either_side(left_name, right_name), REVIEW), path,
    )


def sheet_paths(c: Corpus) -> DataFrame:
    return c.sheet_names.filter("kind = 'sheet'").select("subject", "path")


def sheet_names(c: Corpus, kind: str, name: str) -> DataFrame:
    """``subject`` and the distinct names of a kind in its sheet."""
    return c.sheet_names.filter(F.col("kind") == kind).select("subject", F.col("name").alias(name))


def _both(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Only subjects both sides know anything about."""
    return (
        left.join(right.select("subject").distinct(), "subject", "left_semi"),
        right.join(left.select("subject").distinct(), "subject", "left_semi"),
    )


# -- declared side on its own -----------------------------------------------


@row_rule("issues", "R001", "error")
def config_wellformed() -> dict:
    parts = issue_parts(CONFIG_CODES)
    return parts | {"when": (F.col("source") == "config") & parts["when"]}


@row_rule("config", "R002", "error")
def source_usable() -> dict:
    s = F.col("ref_source")
    return {
        "when": s.isNotNull() & ~(is_assembly(s) | is_url(s) | is_local_source(s)),
        "message": text("cannot tell what reference.source '", s, "' points at"), "path": F.col("path"),
    }


@row_rule("config", "R003", "warn")
def name_is_a_name() -> dict:
    return {
        "when": is_assembly(F.col("ref_name")),
        "message": text("reference.name holds an accession, ", F.col("ref_name"), ", where a species is expected"),
        "detail": "the name becomes part of the reference's file name", "path": F.col("path"),
    }


@row_rule("issues", "R010", "error")
def sheet_wellformed() -> dict:
    parts = issue_parts(SHEET_CODES)
    return parts | {"when": (F.col("source") == "sheet") & parts["when"]}


@row_rule("sheet", "R013", "error")
def inputs_are_accessions() -> dict:
    return {
        "when": (F.col("input_type") == "srr") & ~is_archive_input(F.col("input")),
        "message": text("archive input '", F.col("input"), "' of ", F.col("sample_id"), " has no accession's form"),
        "detail": "expected a run or an experiment", "path": F.col("path"), "line": F.col("line"),
    }


@row_rule("sheet", "R015", "warn")
def inputs_not_local() -> dict:
    return {
        "when": is_local_input(F.col("input")),
        "message": text(F.col("sample_id"), " reads a file of one machine; nobody else can repeat it"),
        "detail": F.col("input"), "path": F.col("path"), "line": F.col("line"),
    }


def ids_are_biosamples(c: Corpus) -> DataFrame:
    odd = described(sheet_names(c, "sample", "sample_id").filter(~is_biosample(F.col("sample_id"))), ["subject"], "sample_id")
    return finding(
        odd.join(sheet_paths(c), "subject", "left"), "R016", "warn",
        text("names without a BioSample accession's form: ", F.col("n")),
        describe(F.col("head"), F.col("n")), F.col("path"),
    )


def readme_accession(c: Corpus) -> DataFrame:
    pairs = c.readme.join(c.config.select("subject", "ref_source"), "subject").filter(
        "accession <> ref_source AND ref_source <> ''"
    )
    return finding(
        pairs, "R020", "warn", text("assembly ", F.col("accession"), " in README.txt, ", F.col("ref_source"), " in the config"),
        path=F.col("path"),
    )


# -- integrity of what was published ----------------------------------------


@row_rule("artifacts", "G001", "error")
def accession_published() -> dict:
    return {"when": F.expr("accession IS NOT NULL AND NOT listed"), "message": text("nothing is stored under ", F.col("accession"))}


@row_rule("artifacts", "G010", "warn")
def raw_vcf_present() -> dict:
    detail = F.when(F.col("n_bams") > 0, text("alignments: ", F.col("n_bams"), ", variants: none")).otherwise("no variant file at all")
    return {"when": F.expr("listed AND NOT raw_vcf"), "message": F.lit("the raw variant file is missing"), "detail": detail}


@row_rule("artifacts", "G011", "error")
def raw_vcf_indexed() -> dict:
    return {"when": F.expr("listed AND raw_vcf AND NOT raw_vcf_index"), "message": F.lit("the raw variant file has no index")}


@row_rule("artifacts", "G012", "error")
def bams_present() -> dict:
    return {"when": F.expr("listed AND NOT bams"), "message": F.lit("no alignment file is published")}


def bams_indexed(c: Corpus) -> DataFrame:
    stem = F.regexp_extract("name", r"^(.*)\.bam\.(?:csi|bai)$", 1)
    indexes = c.inventory.filter("dir = 'bams'").select("subject", stem.alias("sample")).filter("sample <> ''")
    bare = described(missing_from(c.bams, indexes, ["subject", "sample"]), ["subject"], "sample")
    return finding(
        bare, "G013", "error", text("alignment files without an index: ", F.col("n")), describe(F.col("head"), F.col("n"))
    )


def empty_objects(c: Corpus) -> DataFrame:
    """``subject, name`` of every object of no bytes where data is expected."""
    empty = c.inventory.filter(F.col("dir").isin("bams", "vcfs", "<top>") & (F.col("size") == 0))
    return empty.select("subject", F.regexp_extract("key", r"GC[AF]_\d+\.\d+/(.*)$", 1).alias("name")).distinct()


def no_empty_objects(c: Corpus) -> DataFrame:
    some = described(empty_objects(c), ["subject"], "name")
    return finding(some, "G014", "error", text("objects of no bytes: ", F.col("n")), describe(F.col("head"), F.col("n")))


def readmes_in_sync(c: Corpus) -> DataFrame:
    full = lambda c_: F.nullif(normalized_document(c_), F.lit(""))
    local = c.readme.select("subject", full(F.col("text")).alias("a"), "path")
    remote = c.published_readme.select("subject", full(F.col("text")).alias("b"))
    pairs = two_sided(local, remote, ["subject"], "a", "b").filter("side NOT IN ('same', 'neither')")
    message = (
        F.when(F.col("side") == "right only", "only the store has a README.txt")
        .when(F.col("side") == "left only", "only the repository has a README.txt")
        .otherwise("two different README.txt are in use")
    )
    detail = (
        F.when(F.col("side") == "right only", "add it to the subject's folder")
        .when(F.col("side") == "left only", "upload it with the data")
        .otherwise("bring the two copies in line")
    )
    return finding(pairs, "G017", "warn", message, detail, F.col("path"))


def readme_somewhere(c: Corpus) -> DataFrame:
    remote = c.published_readme.filter("text <> ''").select("subject")
    known = c.readme.select("subject").unionByName(remote)
    return finding(
        missing_from(c.subjects, known, ["subject"]), "G018", "warn", text("a README.txt is found on neither side"),
        "the origin of the data is not written down",
    )


# -- sample identity --------------------------------------------------------


def _sheet_samples(c: Corpus) -> DataFrame:
    return sheet_names(c, "sample", "sample")


def sheet_matches_vcf(c: Corpus) -> DataFrame:
    return set_check(
        _sheet_samples(c), c.vcf_samples, "sample", "S001", "error", "sample_sheet.csv", "raw.vcf.gz", sheet_paths(c)
    )


def _complete_with_bams(c: Corpus, df: DataFrame) -> DataFrame:
    """A partial upload's set of files is not final, so it proves nothing."""
    return df.join(c.complete, "subject", "left_semi")


def sheet_matches_bams(c: Corpus) -> DataFrame:
    return set_check(
        _complete_with_bams(c, _sheet_samples(c)), _complete_with_bams(c, c.bams),
        "sample", "S002", "error", "sample_sheet.csv", "bams/", sheet_paths(c),
    )


def vcf_matches_bams(c: Corpus) -> DataFrame:
    return set_check(
        _complete_with_bams(c, c.vcf_samples), _complete_with_bams(c, c.bams),
        "sample", "S003", "error", "raw.vcf.gz", "bams/",
    )


def read_groups_match_names(c: Corpus) -> DataFrame:
    keys = ["subject", "bam"]
    files = c.bam_records.select(*keys).distinct()
    names = described(tag_values(c.bam_records, keys, "RG", "SM", "sm"), keys, "sm")
    odd = files.join(names, keys, "left").filter(
        F.col("n").isNull() | (F.col("n") != 1) | (F.get("head", F.lit(0)) != F.col("bam"))
    )
    shown = F.when(F.col("n").isNull(), "<none>").otherwise(describe(F.col("head"), F.col("n")))
    return finding(
        odd, "S004", "error", text("read groups of ", F.col("bam"), ".bam name ", shown),
        "they should name the file's own sample",
    )


def qc_matches_vcf(c: Corpus) -> DataFrame:
    diff = reconcile_sets(c.qc_samples, c.vcf_samples, ["subject"], "sample")
    return finding(
        diff, "S005", "warn",
        text("sample list (", F.col("n_left"), ") and variant file (", F.col("n_right"), ") hold different samples"),
        either_side("QC", "VCF"),
    )


def published_sheet_matches(c: Corpus) -> DataFrame:
    columns = ["subject", "line", "sample_id", "input_type", "input"]
    left, right = _both(c.sheet.select(*columns), c.published_sheet.select(*columns))
    both = left.withColumn("side", F.lit("repo")).unionByName(right.withColumn("side", F.lit("published")))
    rows = numbered(both, ["subject", "side"], [F.floor(F.col("line") / 65536)], ["line"])
    differing = sequences_differ(
        rows, ["subject"], "side", ("repo", "published"), "seq", columns[2:], "sample_id"
    ).filter("outcome <> 'same'")
    names = reconcile_sets(left, right, ["subject"], "sample_id")
    detail = F.when(
        F.col("outcome") == "same keys", "same samples, other contents"
    ).otherwise(either_side("repo", "published"))
    return finding(
        differing.join(names, "subject", "left").join(sheet_paths(c), "subject", "left"), "S006", "warn",
        text("sample_sheet.csv has two versions, stored and published"), detail, F.col("path"),
    )


def libraries_match(c: Corpus) -> DataFrame:
    keys = ["subject", "bam"]
    files = c.bam_records.select(*keys).distinct()
    declared = (
        c.sheet.filter("library_id <> ''")
        .select("subject", F.col("sample_id").alias("bam"), F.col("library_id").alias("lib"))
        .join(files, keys, "left_semi")
        .distinct()
    )
    observed = tag_values(c.bam_records, keys, "RG", "LB", "lib").join(declared, keys, "left_semi")
    # An alignment file without libraries differs too, so it joins in empty.
    flags = set_equals(declared, observed, keys, "lib").filter("NOT equal").select(*keys)
    bare = declared.select(*keys).distinct().join(observed.select(*keys), keys, "left_anti")
    want = described(declared, keys, "lib").select(*keys, describe(F.col("head"), F.col("n")).alias("_w"))
    have = described(observed, keys, "lib").select(*keys, describe(F.col("head"), F.col("n")).alias("_h"))
    odd = flags.unionByName(bare).join(want, keys, "left").join(have, keys, "left")
    return finding(
        odd, "S007", "warn", text("libraries of ", F.col("bam"), ".bam: ", F.col("_h"), " in its header, ", F.col("_w"), " in the sheet")
    )


# -- reference identity -----------------------------------------------------


def _config_paths(c: Corpus) -> DataFrame:
    return c.config.select("subject", "path")


def _assembly_names(c: Corpus) -> DataFrame:
    return c.assemblies.select(F.col("queried").alias("accession"), "assembly_name")


def contigs_exist(c: Corpus) -> DataFrame:
    unknown = described(c.strays.filter("other IS NULL"), ["subject", "accession"], "contig")
    rows = (
        unknown.join(c.chosen.select("subject", "n_observed"), "subject")
        .join(_assembly_names(c), "accession", "left")
        .join(_config_paths(c), "subject", "left")
    )
    return finding(
        rows, "F001", "error",
        text("contigs unknown to ", F.col("accession"), " (", F.col("assembly_name"), "): ", F.col("n"), " of ", F.col("n_observed")),
        text(describe(F.col("head"), F.col("n")), "; called on something else than declared"), F.col("path"),
    )


def _chosen_names(c: Corpus) -> DataFrame:
    return c.names.join(c.chosen.select("subject", "accession", "scheme"), ["accession", "scheme"])


def contig_lengths(c: Corpus) -> DataFrame:
    keys = ["subject", "accession", "contig"]
    known = _chosen_names(c).select(*keys, F.col("length").alias("_asm"))
    off = c.observed.join(known, keys).filter("length <> _asm")
    counts = off.groupBy("subject", "accession").agg(F.count(F.lit(1)).alias("n"))
    shown = (
        first_n(off, ["subject"], ["contig"], 3)
        .groupBy("subject")
        .agg(F.array_sort(F.collect_list(text(F.col("contig"), " ", F.col("length"), " instead of ", F.col("_asm")))).alias("_ex"))
    )
    rows = counts.join(shown, "subject").join(_config_paths(c), "subject", "left")
    return finding(
        rows, "F002", "error", text("contigs longer or shorter than in ", F.col("accession"), ": ", F.col("n")),
        text(F.array_join("_ex", "; "), "; a sign of another assembly"), F.col("path"),
    )


def one_naming_scheme(c: Corpus) -> DataFrame:
    other = c.strays.filter("other IS NOT NULL")
    # At most one part per naming scheme.
    parts = (
        other.groupBy("subject", "other")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("subject")
        .agg(F.array_sort(F.collect_list(F.struct("other", "_n"))).alias("_p"))
        .select("subject", F.array_join(F.transform("_p", lambda p: F.concat_ws(" ", p["_n"], p["other"])), ", ").alias("_parts"))
    )
    names = described(other, ["subject"], "contig")
    rows = parts.join(names, "subject").join(c.chosen.select("subject", "scheme"), "subject")
    return finding(
        rows, "F003", "error", text("contigs are named by ", F.col("scheme"), " and also by ", F.col("_parts")),
        describe(F.col("head"), F.col("n")),
    )


def _map_digest(maps: DataFrame, keys: list[str]) -> DataFrame:
    """Digest of the contig lengths of each file, in no order; equal for equal maps."""
    entry = F.xxhash64("contig", "length")
    return maps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(entry.cast("decimal(38,0)")).alias("_sum"), F.bit_xor(F.hash("contig", "length", entry)).alias("_xor")
    )


def bam_matches_vcf(c: Corpus) -> DataFrame:
    keys = ["subject", "bam"]
    lengths = reference_lengths(c.bam_records, keys)
    # Files with the variant file's digest are settled; only the others meet its contigs one by one.
    called = c.vcf_contigs.groupBy("subject", "contig").agg(F.max("length").alias("length"))
    digest = F.struct("_n", "_sum", "_xor")
    own = _map_digest(lengths, keys).select(*keys, digest.alias("_own"))
    called_digest = _map_digest(called, ["subject"]).select("subject", digest.alias("_called"))
    files = c.bam_records.select(*keys).distinct().join(own, keys, "left").join(called_digest, "subject", "left")
    differing = files.filter(~F.col("_own").eqNullSafe(F.col("_called"))).select(*keys)
    diff = map_differences(
        lengths.join(differing, keys, "left_semi"), called.join(differing, "subject"), keys, "contig", "length"
    )
    detail = F.concat_ws(
        "; ",
        F.when(F.col("n_only_left") > 0, text("alignments alone: ", F.col("only_left_names"))),
        F.when(F.col("n_only_right") > 0, text("variants alone: ", F.col("only_right_names"))),
        F.when(F.col("n_value") > 0, text("other length: ", F.col("value_names"))),
    )
    return finding(
        diff, "F004", "error",
        text("sequences of ", F.col("bam"), ".bam (", F.col("n_left"), ") are not those of the variant file (", F.col("n_right"), ")"), detail,
    )


def bams_agree(c: Corpus) -> DataFrame:
    members = unlike_first(reference_lengths(c.bam_records, ["subject", "bam"]), ["subject"], "bam", ["contig", "length"])
    odd = described(members.filter("differs"), ["subject"], "bam")
    read = c.bam_records.select("subject", "bam").distinct().groupBy("subject").agg(F.count(F.lit(1)).alias("_read"))
    total = c.artifacts.select("subject", "n_bams")
    rows = odd.join(read, "subject").join(total, "subject", "left")
    scope = F.when(F.col("_read") >= F.coalesce("n_bams", F.lit(0)), "all").otherwise(text(F.col("_read"), " sampled"))
    return finding(
        rows, "F005", "error", text("alignment files with sequences of their own: ", F.col("n"), " of ", scope),
        text(describe(F.col("head"), F.col("n")), "; more than one reference was used"),
    )


def aligner_reference_matches(c: Corpus) -> DataFrame:
    used = aligner_reference(c.bam_records, ["subject", "bam"])
    rows = used.join(c.config.select("subject", "ref_name", "path"), "subject").filter(
        "ref_name <> '' AND reference <> ref_name"
    )
    return finding(
        rows, "F006", "warn",
        text("aligner of ", F.col("bam"), ".bam read '", F.col("reference"), "', the config names '", F.col("ref_name"), "'"),
        "the name becomes part of the reference's file name", F.col("path"),
    )


def contig_map_matches(c: Corpus) -> DataFrame:
    odd = described(missing_from(c.contig_map, c.vcf_contigs, ["subject", "contig"]), ["subject"], "contig")
    return finding(
        odd, "F008", "warn", text("contig map entries that the variant file lacks: ", F.col("n")),
        describe(F.col("head"), F.col("n")),
    )


def _megabases(entries: str) -> Column:
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(" ("), F.format_string("%.1f", e["weight"] / 1e6), F.lit(" Mb)"))),
        ", ",
    )


def sequences_present(c: Corpus) -> DataFrame:
    gone = missing_share(c.wanted, c.observed, ["subject"], "contig", "length", MISSING_PERCENT)
    return finding(
        gone, "F009", F.col("severity"),
        text("sequences without variants: ", F.col("n_missing"), ", ", F.format_string("%.2f", F.col("percent")), "% of all bases"),
        text("first by size: ", _megabases("largest")),
    )


def molecules_present(c: Corpus) -> DataFrame:
    whole = c.wanted.filter("role = 'assembled-molecule'")
    gone = missing_share(whole, c.observed, ["subject"], "contig", "length", top=5)
    return finding(gone, "F011", "warn", text("molecules without variants: ", F.col("n_missing")), _megabases("largest"))


# -- reference canonicality -------------------------------------------------


def _declared_entry(c: Corpus) -> DataFrame:
    info = c.assemblies.select(
        F.col("queried").alias("declared"), "assembly_name", "assembly_level",
        F.col("accession").alias("_acc"), F.col("paired_accession").alias("_pair"),
    )
    return (
        c.entry.select("subject", "scientific_name", F.col("accession").alias("canonical"))
        .join(c.declared.filter("declared IS NOT NULL"), "subject")
        .join(info, "declared", "left")
        .join(_config_paths(c), "subject", "left")
    )


def reference_is_canonical(c: Corpus) -> DataFrame:
    rows = _declared_entry(c).filter(~same_assembly(F.col("declared"), F.col("canonical")))
    bits = F.concat_ws(", ", F.nullif("assembly_name", F.lit("")), F.nullif("assembly_level", F.lit("")))
    label = F.when(bits != "", text(" (", bits, ")")).otherwise("")
    return finding(
        rows, "F020", "error",
        text(F.col("scientific_name"), " is listed with ", F.col("canonical"), ", declared is ", F.col("declared"), label),
        "not even the same assembly", F.col("path"),
    )


def reference_form(c: Corpus) -> DataFrame:
    rows = _declared_entry(c).filter(
        (F.col("declared") != F.col("canonical")) & same_assembly(F.col("declared"), F.col("canonical"))
    )
    paired = (F.col("canonical") == F.col("_acc")) | (F.col("canonical") == F.col("_pair"))
    detail = text(
        "one assembly, other database",
        F.when(paired, "; confirmed by the paired assembly").otherwise(""),
    )
    return finding(
        rows, "F021", "error", text("listed as ", F.col("canonical"), ", declared as ", F.col("declared")),
        detail, F.col("path"),
    )


def species_listed(c: Corpus) -> DataFrame:
    unresolved = missing_from(c.subjects, c.entry, ["subject"])
    several = candidates_by_slug(unresolved.select("subject", "slug"), c.authority).withColumn(
        "_name", text(F.col("scientific_name"), " (", F.col("accession"), ")")
    )
    named = described(several, ["subject"], "_name")
    rows = unresolved.join(named, "subject", "left")
    message = F.when(
        F.col("n").isNotNull(), text("entries that fit ", F.col("slug"), ": ", F.col("n"))
    ).otherwise(text("nothing is listed for ", F.col("slug")))
    detail = F.when(F.col("n").isNotNull(), describe(F.col("head"), F.col("n")))
    return finding(rows, "F022", "error", message, detail)


def names_agree(c: Corpus) -> DataFrame:
    listed = c.entry.select("subject", "scientific_name")
    full = slugify(F.col("scientific_name"))
    fits = lambda s: (s == full) | (s == F.substring_index(full, "-", 2))
    rows = listed.join(c.subjects.select("subject", "slug"), "subject")
    by_directory = finding(
        rows.filter(~fits(F.col("slug"))), "F023", "warn",
        text("listed name '", F.col("scientific_name"), "' does not give the folder '", F.col("slug"), "'"),
    )
    named = listed.join(c.config.select("subject", "ref_name", "path"), "subject").filter(
        (F.col("ref_name") != "") & ~is_assembly(F.col("ref_name"))
    )
    by_config = finding(
        named.filter(~fits(slugify(F.replace("ref_name", F.lit("_"), F.lit(" "))))), "F023", "warn",
        text("listed name '", F.col("scientific_name"), "' does not give reference.name '", F.col("ref_name"), "'"),
        path=F.col("path"),
    )
    return by_directory.unionByName(by_config)


def taxid_agrees(c: Corpus) -> DataFrame:
    rows = (
        c.entry.select("subject", "taxid")
        .join(c.declared, "subject")
        .join(c.assemblies.withColumnRenamed("queried", "declared"), "declared")
        .filter("taxid <> tax_id")
    )
    return finding(
        rows, "F024", "warn",
        text("taxid of ", F.col("accession"), ": ", F.col("tax_id"), " (", F.col("organism_name"), "), listed ", F.col("taxid")),
    )


# -- configuration against recorded provenance ------------------------------


def _numeric(c: Corpus, id: str, label: str, flag: str, column: str, whole: bool) -> DataFrame:
    recorded = command_argument(c.vcf_lines, ["subject"], flag)
    rows = recorded.join(c.config.select("subject", "path", F.col(column).alias("_d")), "subject").filter("_d IS NOT NULL")
    # What is no whole or no finite number cannot be compared; it never ends the run.
    read = as_whole if whole else as_finite
    a, b = read(F.col("argument")), read(F.col("_d"))
    same = (a == b) if whole else close_enough(a, b)
    unclear = a.isNull() | b.isNull()
    message = F.when(
        unclear, text(f"{label} not comparable: '", F.col("_d"), f"' in the config against '", F.col("argument"), f"' for --{flag}")
    ).otherwise(text(f"{label} differs: ", F.col("_d"), " in the config, ", F.col("argument"), f" for --{flag} in the header"))
    detail = F.when(~unclear, "one of the two was changed after the call")
    return finding(rows.filter(unclear | ~same), id, "warn", message, detail, F.col("path"))


def ploidy_matches(c: Corpus) -> DataFrame:
    return _numeric(c, "P001", "ploidy", "sample-ploidy", "ploidy", True)


def het_prior_matches(c: Corpus) -> DataFrame:
    return _numeric(c, "P002", "heterozygosity prior", "heterozygosity", "het_prior", False)


def caller_matches(c: Corpus) -> DataFrame:
    # The set of labels is bounded by the pattern table.
    recorded = classify_lines(c.vcf_lines, ["subject"]).groupBy("subject").agg(
        F.array_sort(F.collect_set("label")).alias("_r")
    )
    tools = described(tool_ids(c.vcf_lines, ["subject"]), ["subject"], "tool")
    declared = F.lower(strip(F.col("caller")))
    rows = (
        recorded.join(c.config.select("subject", "path", declared.alias("_d")), "subject")
        .join(tools, "subject", "left")
        .filter(
            (F.col("_d") != "")
            & ~F.array_contains("_r", F.col("_d"))
            & ~((F.col("_d") == "parabricks") & (F.col("_r") == F.array(F.lit("gatk"))))
        )
    )
    seen = F.coalesce(describe(F.col("head"), F.col("n")), F.lit(""))
    return finding(
        rows, "P003", "warn",
        text("caller in the config: '", F.col("_d"), "'; in the header: ", F.array_join("_r", ", ")),
        text("calls in the header: ", F.when(seen == "", "none").otherwise(seen)), F.col("path"),
    )


# -- the sheet against the read archive (opt-in) ----------------------------


def _resolved(c: Corpus) -> DataFrame:
    return resolve_runs(sheet_names(c, "archive input", "input"), c.runs, "input")


def inputs_belong(c: Corpus) -> DataFrame:
    rows = c.sheet.filter(is_archive_input(F.col("input")))
    resolved = _resolved(c)
    owners = described(resolved.filter("biosample IS NOT NULL"), ["input"], "biosample")
    known = rows.join(resolved.select("input"), "input", "left_semi").join(owners, "input", "left")
    wrong = known.filter(F.col("n").isNull() | (F.col("n") != 1) | (F.get("head", F.lit(0)) != F.col("sample_id")))
    shown = F.when(F.col("n").isNull(), "<no biosample>").otherwise(describe(F.col("head"), F.col("n")))
    one = finding(
        wrong, "E001", "error",
        text("archive has ", F.col("input"), " under ", shown, ", the sheet under ", F.col("sample_id")),
        path=F.col("path"), line=F.col("line"),
    )
    unknown = described(missing_from(sheet_names(c, "archive input", "input"), resolved, ["input"]), ["subject"], "input")
    rest = finding(
        unknown.join(sheet_paths(c), "subject", "left"), "E001", "error",
        text("inputs the archive does not know: ", F.col("n")), describe(F.col("head"), F.col("n")), F.col("path"),
    )
    return one.unionByName(rest)


def _projects(c: Corpus) -> tuple[DataFrame, DataFrame]:
    """Projects the runs come from and projects the documentation names."""
    documented = c.readme.select("subject", F.explode("bioprojects").alias("bioproject")).distinct()
    contributing = (
        sheet_names(c, "archive input", "input")
        .join(_resolved(c).filter("bioproject IS NOT NULL").select("input", "bioproject").distinct(), "input")
        .select("subject", "bioproject")
        .distinct()
        .join(documented.select("subject"), "subject", "left_semi")
    )
    return contributing, documented


def projects_documented(c: Corpus) -> DataFrame:
    contributing, documented = _projects(c)
    diff = reconcile_sets(contributing, documented, ["subject"], "bioproject").filter("n_only_left > 0")
    listed = described(documented, ["subject"], "bioproject").select("subject", describe(F.col("head"), F.col("n")).alias("_doc"))
    rows = diff.join(listed, "subject").join(c.readme.select("subject", "path"), "subject")
    return finding(
        rows, "E002", "warn", text("bioprojects with runs that README.txt leaves out: ", F.col("n_only_left")),
        text(F.col("only_left"), "; documented are ", F.col("_doc")), F.col("path"),
    )


def projects_contribute(c: Corpus) -> DataFrame:
    contributing, documented = _projects(c)
    idle = reconcile_sets(contributing, documented, ["subject"], "bioproject").filter("n_only_right > 0")
    return finding(
        idle.join(c.readme.select("subject", "path"), "subject"), "E003", "warn",
        text("documented bioprojects without a run: ", F.col("n_only_right")),
        F.col("only_right"), F.col("path"),
    )


def inputs_unambiguous(c: Corpus) -> DataFrame:
    asked = sheet_names(c, "archive input", "input").filter(is_experiment(F.col("input")))
    runs = described(resolve_runs(asked, c.runs, "input"), ["input"], "run")
    several = finding(
        c.sheet.filter(is_experiment(F.col("input"))).join(runs.filter("n > 1"), "input"), "R017", "error",
        text("experiment ", F.col("input"), " of ", F.col("sample_id"), " has ", F.col("n"), " runs; which of them were read is open"),
        text("runs: ", describe(F.col("head"), F.col("n"))), F.col("path"), F.col("line"),
    )
    one = described(asked.join(runs.filter("n = 1").select("input"), "input"), ["subject"], "input")
    single = finding(
        one.join(sheet_paths(c), "subject", "left"), "R017", "info",
        text("inputs given as an experiment of one run: ", F.col("n")),
        describe(F.col("head"), F.col("n")), F.col("path"),
    )
    return several.unionByName(single)


# -- the corpus as a whole --------------------------------------------------


def orphans(c: Corpus) -> DataFrame:
    """G020 and G021: published accessions no subject claims."""
    from tallymark.functions.identifiers import counterpart
    from tallymark.sources.observed import published

    claimed = c.declared.filter("declared IS NOT NULL").select(F.col("declared").alias("accession"))
    claimed = claimed.unionByName(claimed.select(counterpart(F.col("accession")).alias("accession"))).distinct()
    names = c.authority.groupBy("accession").agg(F.max_by("scientific_name", "line").alias("_name"))
    rows = (
        missing_from(published(c.objects, c.subdirs), claimed, ["accession"])
        .join(names, "accession", "left")
        .withColumn("subject", F.lit("<corpus>"))
    )
    listed = F.col("_name").isNotNull()
    return finding(
        rows, F.when(listed, "G020").otherwise("G021"), "warn",
        F.when(
            listed, text("no folder for ", F.col("accession"), " (", F.col("_name"), "), though listed and published")
        ).otherwise(text("published without folder or listing: ", F.col("accession"))),
    )


# Which function computes which check.
BUILDERS = {
    "R001": config_wellformed,
    "R002": source_usable,
    "R003": name_is_a_name,
    "R010": sheet_wellformed,
    "R013": inputs_are_accessions,
    "R015": inputs_not_local,
    "R016": ids_are_biosamples,
    "R020": readme_accession,
    "G001": accession_published,
    "G010": raw_vcf_present,
    "G011": raw_vcf_indexed,
    "G012": bams_present,
    "G013": bams_indexed,
    "G014": no_empty_objects,
    "G017": readmes_in_sync,
    "G018": readme_somewhere,
    "S001": sheet_matches_vcf,
    "S002": sheet_matches_bams,
    "S003": vcf_matches_bams,
    "S004": read_groups_match_names,
    "S005": qc_matches_vcf,
    "S006": published_sheet_matches,
    "S007": libraries_match,
    "F001": contigs_exist,
    "F002": contig_lengths,
    "F003": one_naming_scheme,
    "F004": bam_matches_vcf,
    "F005": bams_agree,
    "F006": aligner_reference_matches,
    "F008": contig_map_matches,
    "F009": sequences_present,
    "F011": molecules_present,
    "F020": reference_is_canonical,
    "F021": reference_form,
    "F022": species_listed,
    "F023": names_agree,
    "F024": taxid_agrees,
    "P001": ploidy_matches,
    "P002": het_prior_matches,
    "P003": caller_matches,
    "E001": inputs_belong,
    "E002": projects_documented,
    "E003": projects_contribute,
    "R017": inputs_unambiguous,
}
CATALOG = table_of_checks(CHECKS, BUILDERS, RETIRED)


def validate(corpus: Corpus, only=None, skip=None, check_runs: bool = False, guarded: bool = False) -> DataFrame:
    """Findings of the catalogue plus failed lookups.

    The checks against the read archive run only when asked for. Tables that
    several of the selected checks share are computed when this is called, and
    the findings as well where they are ``guarded`` against failing checks.
    """
    checks = pick(CATALOG, only, skip, () if check_runs else ("runs",))
    corpus.materialise(slices_of(checks))
    return run_checks(corpus, checks, only=only, skip=skip, guarded=guarded).unionByName(lookup_findings(corpus.lookups))
