"""The two publication gates.

Gate A asks whether there is a finished, current, error-free data set.
Gate B asks whether every check its citations rest on ran and passed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.records import changed_inputs

# The checks gate B rests on, and those that prove a list wrong.
GATING_CHECKS = ("G017", "G018", "R020", "E001", "E002", "E003")
WRONGNESS_CHECKS = ("E001", "E002", "E003")

# Blocker codes, leading one first.
BLOCKERS = (
    "no_record",
    "stale_record",
    "inputs_changed",
    "no_data",
    "incomplete_upload",
    "validation_errors",
    "accession_moved",
)


def gate_outcomes(
    ran: DataFrame,
    findings: DataFrame,
    checks: Sequence[str] = GATING_CHECKS,
    *,
    subject: str = "subject",
    check: str = "id",
) -> DataFrame:
    """One row per subject with a struct ``(check, outcome)`` per gating check.

    ``ran`` has ``subject`` and ``checks_run``. A check that did not run and
    one that was skipped are both unknown, which is not a pass.
    """
    relevant = findings.filter(F.col(check).isin(*checks))
    seen = relevant.groupBy(subject).agg(
        *[
            F.max(F.when(F.col(check) == c, (F.col("severity") != "skipped").cast("int"))).alias(f"_{c}")
            for c in checks
        ]
    )
    outcome = [
        F.struct(
            F.lit(c).alias("check"),
            F.when(~F.array_contains("checks_run", c), "not_run")
            .when(F.col(f"_{c}") == 0, "skipped")
            .when(F.col(f"_{c}") == 1, "fired")
            .otherwise("passed")
            .alias("outcome"),
        )
        for c in checks
    ]
    return ran.join(seen, subject, "left").select(
        *ran.columns, F.array(*outcome).alias("gating")
    )


def soundness(gating: Column, wrongness: Sequence[str] = WRONGNESS_CHECKS) -> tuple[Column, Column]:
    """``cited`` and ``provenance`` from the outcomes of gate B."""
    cited = F.coalesce(F.forall(gating, lambda g: g["outcome"] == "passed"), F.lit(False))
    wrong = F.coalesce(
        F.exists(gating, lambda g: g["check"].isin(*wrongness) & (g["outcome"] == "fired")),
        F.lit(False),
    )
    provenance = F.when(~cited, F.when(wrong, "wrong").otherwise("missing"))
    return cited, provenance


def codes_present(flags: Sequence[tuple[str, Column, Column]]) -> Column:
    """Array of ``(code, detail)`` for the conditions that hold, in order."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    F.coalesce(condition, F.lit(False)),
                    F.struct(F.lit(code).alias("code"), detail.cast("string").alias("detail")),
                )
                for code, condition, detail in flags
            ]
        )
    )


def evaluate(
    subjects: DataFrame,
    records: DataFrame,
    findings: DataFrame,
    digests: DataFrame,
    harvested: DataFrame,
) -> DataFrame:
    """Verdict per subject: mode, blockers, gating outcomes, citability.

    ``harvested`` has ``subject`` and ``harvested_accession``. Ids of error
    findings are bounded by the catalogue, so they may be gathered.
    """
    errors = (
        findings.filter("severity = 'error'")
        .groupBy("subject")
        .agg(F.array_sort(F.collect_set("id")).alias("_errors"))
    )
    gated = gate_outcomes(records.select("subject", "checks_run"), findings)
    merged = (
        subjects.select("subject")
        .join(records.withColumn("_known", F.lit(1)).drop("checks_run"), "subject", "left")
        .join(gated, "subject", "left")
        .join(changed_inputs(records, digests), "subject", "left")
        .join(errors, "subject", "left")
        .join(harvested.select("subject", "harvested_accession"), "subject", "left")
    )
    known = F.col("_known") == 1
    published = F.col("status.state")
    recorded = F.col("data.accession")
    missing = F.when(
        F.size("status.missing") > 0, F.array_join("status.missing", ", ")
    ).otherwise("unknown")
    blockers = codes_present(
        [
            ("no_record", F.col("_known").isNull(), F.lit("no validation record")),
            (
                "stale_record",
                known & (F.col("state") == "STALE"),
                F.coalesce(F.col("stale_reason"), F.lit("inputs changed")),
            ),
            ("inputs_changed", known & F.col("changed").isNotNull(), F.array_join("changed", ", ")),
            ("no_data", known & (published == "absent"), F.lit("nothing published")),
            (
                "incomplete_upload",
                known & (published.isNull() | ~published.isin("absent", "complete")),
                F.concat(F.lit("missing "), missing),
            ),
            ("validation_errors", known & F.col("_errors").isNotNull(), F.array_join("_errors", ", ")),
            (
                "accession_moved",
                known & (F.col("harvested_accession") != recorded),
                F.concat(
                    F.lit("harvested "), "harvested_accession", F.lit(", validated "), recorded
                ),
            ),
        ]
    )
    cited, provenance = soundness(F.col("gating"))
    return merged.withColumn("blockers", blockers).select(
        "subject",
        F.when(F.size("blockers") == 0, "full").otherwise("truncated").alias("mode"),
        "blockers",
        F.get("blockers", F.lit(0))["code"].alias("leading"),
        "gating",
        cited.alias("cited"),
        provenance.alias("provenance"),
    )


def gate_report(verdicts: DataFrame) -> DataFrame:
    """Subjects per group: full and cited, full but blocked, truncated."""
    group = (
        F.when(F.col("mode") == "truncated", "truncated")
        .when(F.col("cited"), "cited")
        .otherwise("blocked")
    )
    return verdicts.groupBy(group.alias("group"), F.coalesce("leading", "provenance").alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )
