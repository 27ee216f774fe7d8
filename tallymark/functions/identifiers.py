"""Recognising and relating public archive identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier formats.
ASSEMBLY = r"^GC[AF]_\d{9}\.\d+$"
BIOSAMPLE = r"^SAM(N|EA|D)\d+$"
RUN = r"^[SED]RR\d+$"
EXPERIMENT = r"^[SED]RX\d+$"
RUN_OR_EXPERIMENT = r"^[SED]R[RX]\d+$"
PROJECT = r"\bPRJ[A-Z]{2}\d+\b"

# Accepted kinds of sheet input.
INPUT_TYPES = ("bam", "fastq", "srr")


def is_assembly(c: Column) -> Column:
    return c.rlike(ASSEMBLY)


def is_biosample(c: Column) -> Column:
    return c.rlike(BIOSAMPLE)


def is_run(c: Column) -> Column:
    return c.rlike(RUN)


def is_experiment(c: Column) -> Column:
    return c.rlike(EXPERIMENT)


def is_archive_input(c: Column) -> Column:
    """A run or an experiment."""
    return c.rlike(RUN_OR_EXPERIMENT)


def is_local_input(c: Column) -> Column:
    """An input that only exists on somebody's own disk."""
    return c.contains("/") | c.startswith("~")


def is_local_source(c: Column) -> Column:
    return (
        c.startswith("/") | c.startswith("./") | c.startswith("~") | c.startswith("file:")
    )


def is_url(c: Column) -> Column:
    return c.startswith("http://") | c.startswith("https://") | c.startswith("ftp://")


def flip_prefix(c: Column, one: str, other: str) -> Column:
    """Swap two equally long prefixes; null when neither is present."""
    rest = F.substr(c, F.lit(len(one) + 1))
    return F.when(c.startswith(one), F.concat(F.lit(other), rest)).when(
        c.startswith(other), F.concat(F.lit(one), rest)
    )


def counterpart(c: Column) -> Column:
    """The same assembly under the other archive's prefix."""
    return F.when(is_assembly(c), flip_prefix(c, "GCA", "GCF"))


def same_assembly(declared: Column, other: Column) -> Column:
    """True when ``other`` names the declared assembly in either form."""
    return F.coalesce(
        is_assembly(declared) & ((other == declared) | (other == counterpart(declared))),
        F.lit(False),
    )


def extract_ids(text: Column, pattern: str = PROJECT) -> Column:
    """All matches, distinct, in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
