"""The declared side: sheets, configuration, documentation, authority list."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.identifiers import INPUT_TYPES, extract_ids
from tallymark.functions.text import binomial_slug, slugify, strip
from tallymark.operators.ranking import later_occurrences
from tallymark.session import cut
from tallymark.sources.lines import (
    as_map,
    cell,
    comma_fields,
    headed,
    is_blank,
    last_index,
    quoted_records,
)

# Columns a sheet must have.
SHEET_COLUMNS = ("sample_id", "input_type", "input")

# Header spellings of the authority list, lower case.
AUTHORITY_ALIASES = {
    "scientific_name": ("scientificname",),
    "taxid": ("qid",),
    "accession": (
        "accession.for.main.haplotype",
        "accession_for_main_haplotype",
        "accession",
    ),
}


class Scan(NamedTuple):
    """Rows of a source and what was wrong with it."""

    rows: DataFrame
    issues: DataFrame


def _issue(code: str, message: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), message.alias("message"))


def _when(condition: Column, code: str, message: Column) -> Column:
    return F.when(condition, _issue(code, message))


def _issues(df: DataFrame, source: str, entries: list[Column], line: Column) -> DataFrame:
    found = df.select(
        "subject",
        F.lit(source).alias("source"),
        "path",
        line.cast("int").alias("line"),
        F.explode(F.array_compact(F.array(*entries))).alias("_i"),
    )
    return found.select("subject", "source", "_i.code", "_i.message", "path", "line")


def subjects_from_files(files: DataFrame, clade: str | None = None) -> DataFrame:
    """One subject per ``species/<clade>/<slug>/config.yaml`` in a file table."""
    parts = F.regexp_extract_all(
        "path", F.lit(r"species/([^/]+)/([^/]+)/config\.yaml$"), F.lit(0)
    )
    path = F.regexp_replace(F.get(parts, F.lit(0)), r"/config\.yaml$", "")
    found = files.filter(F.size(parts) == 1).select(
        F.substring_index(path, "/", -2).alias("subject"),
        F.split(path, "/")[1].alias("clade"),
        F.split(path, "/")[2].alias("slug"),
        path.alias("path"),
    )
    return found if clade is None else found.filter(F.col("clade") == clade)


def file_issues(subjects: DataFrame, files: DataFrame, name: str, source: str) -> DataFrame:
    """Missing and empty files. ``files`` has ``subject, path, size``."""
    ours = files.filter(F.col("path").endswith("/" + name))
    pairs = subjects.select("subject").join(ours, "subject", "left")
    return _issues(
        pairs,
        source,
        [
            _when(F.col("path").isNull(), "missing_file", F.lit(f"{name} not found")),
            _when(F.col("size") == 0, "parse_error", F.lit("file is empty")),
        ],
        F.when(F.col("size") == 0, 1),
    )


def parse_sheets(lines: DataFrame, source: str = "sheet") -> Scan:
    """Sample sheets from ``(subject, path, line, value)``.

    Unusable rows are skipped and reported; odd ones are kept and reported. A quoted
    field may go over several lines; rows are numbered, not lines.
    """
    keys = ["subject", "path"]
    # Written once: header, rows and issues all start from the records.
    lines = cut(quoted_records(lines, keys))
    rows = headed(lines, keys, comma_fields, first_line_only=True)
    header, fields = F.col("header"), F.col("fields")
    known = [*SHEET_COLUMNS, "library_id"]
    extra = F.filter(
        F.transform(
            header,
            lambda name, i: F.struct(
                name.alias("name"), strip(F.get(fields, i)).alias("value"), i.alias("i")
            ),
        ),
        lambda e: ~e["name"].isin(*known)
        & (F.coalesce(e["value"], F.lit("")) != "")
        & (e["i"] == last_index(header, e["name"])),
    )
    read = rows.select(
        *keys,
        "line",
        is_blank(fields).alias("_blank"),
        F.size(fields).alias("_width"),
        *[cell(header, fields, c).alias(c) for c in SHEET_COLUMNS],
        F.nullif(cell(header, fields, "library_id"), F.lit("")).alias("library_id"),
        F.map_from_entries(
            F.transform(extra, lambda e: F.struct(e["name"], e["value"]))
        ).alias("extra"),
    )
    blank, width = F.col("_blank"), F.col("_width")
    short = ~blank & (width < len(SHEET_COLUMNS))
    usable = ~blank & ~short
    odd_type = ~F.col("input_type").isin("", *INPUT_TYPES)
    unnamed = F.col("sample_id") == ""
    kinds = ", ".join(repr(k) for k in INPUT_TYPES)
    row_issues = _issues(
        read,
        source,
        [
            _when(blank, "blank_row", F.lit("nothing in this row")),
            _when(
                short,
                "short_row",
                F.format_string(f"too short: %d of {len(SHEET_COLUMNS)} fields", width),
            ),
            _when(usable & unnamed, "empty_sample_id", F.lit("row without a sample_id")),
            _when(
                usable & ~unnamed & odd_type,
                "unknown_input_type",
                F.concat(F.lit("input_type is '"), "input_type", F.lit(f"', known are {kinds}")),
            ),
        ],
        F.col("line"),
    )
    kept = read.filter(usable & ~unnamed).select(
        "subject", "line", *SHEET_COLUMNS, "library_id", "extra", "path"
    )
    repeated = _issues(
        later_occurrences(
            kept.select(*keys, "line", "sample_id", "input"), [*keys, "sample_id", "input"], ["line"]
        ),
        source,
        [
            _issue(
                "duplicate_run",
                F.concat(F.lit("input "), "input", F.lit(" is given again for "), "sample_id"),
            )
        ],
        F.col("line"),
    )
    first = lines.filter("line = 1").withColumn(
        "header", F.transform(comma_fields(F.col("value")), strip)
    )
    missing = _issues(
        first,
        source,
        [
            _when(
                ~F.array_contains("header", c), "missing_column", F.lit(f"the header lacks '{c}'")
            )
            for c in SHEET_COLUMNS
        ],
        F.lit(1),
    )
    endless = _issues(lines.filter("NOT whole"), source, [_issue("parse_error", F.lit("a quoted field does not end"))], F.col("line"))
    return Scan(kept, missing.unionByName(row_issues).unionByName(repeated).unionByName(endless))


def parse_configs(documents: DataFrame) -> Scan:
    """Configuration documents (JSON text) from ``(subject, path, content)``."""
    body = F.try_parse_json("content")

    def text(path: str) -> Column:
        return F.try_variant_get(F.col("body"), f"$.{path}", "string")

    def part(path: str) -> Column:
        return F.try_variant_get(F.col("body"), f"$.{path}", "variant")

    def is_mapping(v: Column) -> Column:
        return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))

    read = documents.withColumn("body", body).select(
        "subject",
        "path",
        "body",
        is_mapping(F.col("body")).alias("_ok"),
        is_mapping(part("reference")).alias("_ref"),
        strip(text("reference.name")).alias("ref_name"),
        strip(text("reference.source")).alias("ref_source"),
        text("variant_calling.ploidy").alias("ploidy"),
        text("variant_calling.gatk.het_prior").alias("het_prior"),
        text("variant_calling.tool").alias("caller"),
    )
    ok, ref = F.col("_ok"), F.col("_ok") & F.col("_ref")
    issues = _issues(
        read,
        "config",
        [
            _when(F.col("body").isNull(), "parse_error", F.lit("no readable document")),
            _when(
                F.col("body").isNotNull() & ~ok,
                "parse_error",
                F.lit("the document holds no keys"),
            ),
            _when(ok & ~F.col("_ref"), "missing_key", F.lit("nothing is said about the reference")),
            *[
                _when(
                    ref & F.col(f"ref_{k}").isNull(),
                    "missing_key",
                    F.lit(f"no value for reference.{k}"),
                )
                for k in ("name", "source")
            ],
            *[
                _when(ok & part(k).isNull(), "missing_key", F.lit(f"the key {k} is not there"))
                for k in ("samples", "variant_calling")
            ],
        ],
        F.lit(None),
    )
    rows = read.withColumn("body", F.to_json("body")).select(
        "subject", "ref_name", "ref_source", "ploidy", "het_prior", "caller",
        F.col("_ok").alias("parsed"), "body", "path",
    )
    return Scan(rows, issues)


def labelled_value(text: Column, label: str) -> Column:
    """Value of the last line starting with ``label:``, any case; null if blank."""
    lines = F.filter(
        F.split(text, "\r\n|\n|\r"), lambda x: F.lower(x).startswith(label + ":")
    )
    last = F.try_element_at(lines, F.lit(-1))
    return F.nullif(strip(F.substr(last, F.lit(len(label) + 2))), F.lit(""))


def parse_readmes(documents: DataFrame) -> DataFrame:
    """Documentation files from ``(subject, path, content)``."""
    content = F.col("content")
    return documents.select(
        "subject",
        content.alias("text"),
        labelled_value(content, "species").alias("species"),
        labelled_value(content, "accession number").alias("accession"),
        extract_ids(content).alias("bioprojects"),
        "path",
    )


def parse_authority(lines: DataFrame) -> Scan:
    """The authority list from ``(path, line, value)`` lines.

    Rows carry the join keys ``slug`` and ``binomial``.
    """
    with_key = lines.withColumn("subject", F.lit("<corpus>"))
    keys = ["subject", "path"]
    rows = headed(with_key, keys, comma_fields, first_line_only=True)
    lowered = F.transform("header", F.lower)

    def position(header: Column, field: str) -> Column:
        return F.array_max(
            F.array_compact(F.array(*[last_index(header, F.lit(a)) for a in AUTHORITY_ALIASES[field]]))
        )

    first = with_key.filter("line = 1").withColumn(
        "_h", F.transform(comma_fields(F.col("value")), lambda x: F.lower(strip(x)))
    )
    required = ("scientific_name", "accession")
    missing = _issues(
        first,
        "authority",
        [
            _when(
                position(F.col("_h"), r).isNull(),
                "missing_column",
                F.lit(f"cannot find a column for '{r}'"),
            )
            for r in required
        ],
        F.lit(1),
    )
    read = (
        rows.withColumn("_h", lowered)
        .filter(~is_blank(F.col("fields")))
        .select(
            *keys,
            "line",
            F.size("fields").alias("_width"),
            *[position(F.col("_h"), f).alias(f"_{f}") for f in AUTHORITY_ALIASES],
            "fields",
        )
        .filter("_scientific_name IS NOT NULL AND _accession IS NOT NULL")
        .select(
            *keys,
            "line",
            "_width",
            (F.col("_width") <= F.greatest("_scientific_name", "_accession")).alias("_short"),
            *[
                strip(F.get("fields", F.col(f"_{f}"))).alias(f)
                for f in ("scientific_name", "accession", "taxid")
            ],
        )
    )
    short = F.col("_short")
    incomplete = ~short & ((F.col("scientific_name") == "") | (F.col("accession") == ""))
    complete = ~short & ~incomplete
    digits = F.col("taxid").rlike(r"^\d+$")
    row_issues = _issues(
        read,
        "authority",
        [
            _when(short, "short_row", F.format_string("row has %d field(s)", F.col("_width"))),
            _when(incomplete, "incomplete_row", F.lit("entry without name or accession")),
            _when(
                complete & (F.col("taxid") != "") & ~digits,
                "bad_taxid",
                F.concat(F.lit("taxid '"), "taxid", F.lit("' is not an integer")),
            ),
        ],
        F.col("line"),
    )
    entries = read.filter(complete).select(
        *keys, "line", "scientific_name", "accession",
        F.when(digits, F.col("taxid").try_cast("int")).alias("taxid"),
    )
    doubled = entries.groupBy(*keys, "accession").count().filter("count > 1")
    duplicates = _issues(
        doubled,
        "authority",
        [_issue("duplicate_accession", F.concat(F.lit("listed again: "), "accession"))],
        F.lit(None),
    )
    out = entries.select(
        "scientific_name",
        "taxid",
        "accession",
        "line",
        slugify(F.col("scientific_name")).alias("slug"),
        binomial_slug(F.col("scientific_name")).alias("binomial"),
    )
    return Scan(out, missing.unionByName(row_issues).unionByName(duplicates))


def headed_table(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Tab-separated rows as ``keys, line, cells`` (a map), blank lines skipped."""
    rows = headed(lines, keys)
    return rows.filter(~is_blank(F.col("fields"))).select(
        *keys, "line", as_map(F.col("header"), F.col("fields")).alias("cells")
    )
