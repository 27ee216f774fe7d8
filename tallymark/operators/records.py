"""Validation records: verdict, inputs, staleness.

Findings stay in their own table. A record holds counts of them, so a
subject with very many findings is still one small row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import sha256_tag
from tallymark.functions.values import REPORT_STATES, SEVERITIES, severity_rank
from tallymark.operators.rollup import counts_with_zeros

# Files a verdict depends on, and what does not count as content.
INPUT_FILES = ("config.yaml", "sample_sheet.csv", "README.txt")
VOLATILE = ("validated_at", "tool_version")

SUPERSEDED = "struct<state:string,validated_at:string,tool_version:string,catalog:string,stale_reason:string>"


def severity_tallies(findings: DataFrame, subject: str = "subject") -> DataFrame:
    """One row per subject with a column per severity."""
    return findings.groupBy(subject).agg(
        *[F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in SEVERITIES]
    )


def in_report_order(findings: DataFrame) -> DataFrame:
    """Worst first within each subject, then by id."""
    return findings.orderBy("subject", severity_rank(F.col("severity")), "id")


def exit_codes(findings: DataFrame) -> DataFrame:
    """One row: 1 on errors, and strictly 1 on warnings too."""
    def seen(*severities: str) -> Column:
        hit = F.bool_or(F.col("severity").isin(*severities))
        return F.coalesce(hit, F.lit(False)).cast("int")

    return findings.agg(seen("error").alias("exit_code"), seen("error", "warn").alias("strict_exit"))


def skip_reasons(findings: DataFrame, by: list[str]) -> DataFrame:
    """Skipped checks per reason, most frequent first."""
    reason = F.coalesce("detail", F.lit("unavailable"))
    return (
        findings.filter("severity = 'skipped'")
        .groupBy(*by, reason.alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(*by, F.desc("n"), "reason")
    )


def corpus_table(records: DataFrame) -> DataFrame:
    """One row per subject of the corpus report."""
    return records.select("subject", "state", "counts.*", "validated_at", "stale_reason")


def corpus_summary(records: DataFrame) -> DataFrame:
    """Subjects per state, absent states included, and the latest verdict's date."""
    latest = records.select(F.max("validated_at")).scalar()
    return counts_with_zeros(records, "state", REPORT_STATES).withColumn("latest", latest)


def verdict(state: Column) -> Column:
    """Verdict from the tallies of a subject and its publication state."""
    def seen(s: str) -> Column:
        return F.coalesce(F.col(f"n_{s}"), F.lit(0)) > 0

    return (
        F.when(seen("error"), "FAIL")
        .when(state.isNull() | (state != "complete"), "PENDING")
        .when(seen("warn"), "PASS WITH WARNINGS")
        .when(seen("info"), "PASS WITH NOTES")
        .otherwise("PASS")
    )


def derive_state(
    subjects: DataFrame, findings: DataFrame, status: DataFrame, subject: str = "subject"
) -> DataFrame:
    """Verdict per subject; errors outrank an unfinished publication."""
    tallies = severity_tallies(findings, subject)
    zero = [F.coalesce(F.col(f"n_{s}"), F.lit(0)).alias(f"n_{s}") for s in SEVERITIES]
    return (
        subjects.select(subject)
        .join(tallies, subject, "left")
        .join(status.select(subject, F.col("state").alias("_published")), subject, "left")
        .select(subject, verdict(F.col("_published")).alias("state"), *zero)
    )


def file_digests(files: DataFrame) -> DataFrame:
    """Digest per subject and input file from ``content`` (binary or text)."""
    return files.filter(F.col("name").isin(*INPUT_FILES)).select(
        "subject", "name", sha256_tag(F.col("content")).alias("digest")
    )


def inputs_map(digests: DataFrame) -> DataFrame:
    """At most three files per subject, as one map."""
    return digests.groupBy("subject").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "digest")))).alias("inputs")
    )


def build_records(
    states: DataFrame,
    inputs: DataFrame,
    data: DataFrame,
    status: DataFrame,
    *,
    checks_run: list[str],
    checks_available: int,
    catalog: str,
    tool_version: str,
    validated_at: str,
) -> DataFrame:
    """One record per subject.

    ``states`` comes from :func:`derive_state`, ``inputs`` from
    :func:`file_digests`; ``data`` has ``subject`` and a ``data`` struct,
    ``status`` is the publication status table.
    """
    published = F.struct(*[c for c in status.columns if c != "subject"])
    no_inputs = F.create_map().cast("map<string,string>")
    return (
        states.join(inputs_map(inputs), "subject", "left")
        .join(data.select("subject", "data"), "subject", "left")
        .join(status.select("subject", published.alias("status")), "subject", "left")
        .select(
            "subject",
            "state",
            F.lit(validated_at).alias("validated_at"),
            F.lit(tool_version).alias("tool_version"),
            F.lit(catalog).alias("catalog"),
            F.array(*[F.lit(c) for c in sorted(checks_run)]).cast("array<string>").alias("checks_run"),
            F.lit(checks_available).alias("checks_available"),
            F.lit(0 < len(checks_run) < checks_available).alias("is_partial"),
            F.coalesce("inputs", no_inputs).alias("inputs"),
            "data",
            F.struct(*[f"n_{s}" for s in SEVERITIES]).alias("counts"),
            "status",
            F.lit(None).cast(SUPERSEDED).alias("superseded"),
            F.lit(None).cast("string").alias("stale_reason"),
        )
    )


def changed_inputs(records: DataFrame, digests: DataFrame) -> DataFrame:
    """Per subject: names of inputs added, removed or changed.

    Only subjects with a record and at least one such input are returned.
    """
    then = records.select("subject", F.explode("inputs").alias("name", "_then"))
    both = (
        then.join(digests, ["subject", "name"], "full_outer")
        .filter(~F.col("_then").eqNullSafe(F.col("digest")))
        .join(records.select("subject"), "subject", "left_semi")
    )
    # At most three names per subject.
    return both.groupBy("subject").agg(F.array_sort(F.collect_list("name")).alias("changed"))


def assess(
    subjects: DataFrame,
    records: DataFrame,
    digests: DataFrame,
    *,
    catalog: str | None = None,
    published: DataFrame | None = None,
    data: DataFrame | None = None,
) -> DataFrame:
    """Why each subject needs revalidation; null reason means fresh.

    The first reason wins: no record, inputs changed, catalogue changed,
    data changed, data published since, last verdict failed or stale, last
    verdict had warnings.
    """
    merged = (
        subjects.select("subject")
        .join(records.withColumn("_known", F.lit(1)), "subject", "left")
        .join(changed_inputs(records, digests), "subject", "left")
    )
    none = F.lit(None).cast("string")
    if data is not None:
        merged = merged.join(data.select("subject", F.col("data").alias("_now")), "subject", "left")
        moved = F.when(
            F.col("_now").isNotNull() & ~F.col("_now").eqNullSafe(F.col("data")),
            "published data changed since validation",
        )
    else:
        moved = none
    if published is not None:
        merged = merged.join(
            published.select(F.col("accession").alias("_acc"), F.lit(1).alias("_up")).distinct(),
            F.col("data.accession") == F.col("_acc"),
            "left",
        )
        appeared = F.when(
            ~F.coalesce(F.col("data.published"), F.lit(False)) & (F.col("_up") == 1),
            "data has been published since validation",
        )
    else:
        appeared = none
    reason = F.coalesce(
        F.when(F.col("_known").isNull(), "no previous report"),
        F.concat(F.array_join("changed", ", "), F.lit(" changed since validation")),
        F.when(F.col("catalog") != F.lit(catalog), "the check catalog changed") if catalog else none,
        moved,
        appeared,
        F.when(
            F.col("state").isin("FAIL", "STALE"), F.concat(F.lit("last validation was "), "state")
        ),
        F.when(F.col("counts.n_warn") > 0, "last validation raised warnings"),
    )
    return merged.select("subject", reason.alias("reason"), reason.isNotNull().alias("stale"))


def mark_stale(records: DataFrame, reasons: DataFrame) -> DataFrame:
    """Stamp records whose evidence changed; keep the verdict they replace.

    A record already stale is left alone, and a changed catalogue or a bad
    last verdict is no evidence, so neither stamps.
    """
    evidence = reasons.select("subject", F.col("reason").alias("_why")).filter(
        F.col("_why").contains(" since validation")
    )
    stamp = F.col("_why").isNotNull() & (F.col("state") != "STALE")
    old = F.struct("state", "validated_at", "tool_version", "catalog", "stale_reason")
    return (
        records.join(evidence, "subject", "left")
        .withColumn("superseded", F.when(stamp, old).otherwise(F.col("superseded")))
        .withColumn("stale_reason", F.when(stamp, F.col("_why")).otherwise(F.col("stale_reason")))
        .withColumn("state", F.when(stamp, F.lit("STALE")).otherwise(F.col("state")))
        .select(*records.columns)
    )
