"""The validation job: findings, records, staleness and gates of a corpus."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from tallymark.operators import gates
from tallymark.operators.records import VOLATILE, assess, build_records, derive_state
from tallymark.operators.upsert import change_only
from tallymark.plans.catalog import CATALOG, validate
from tallymark.plans.corpus import Corpus
from tallymark.plans.registry import pick, selection_digest
from tallymark.session import cut


class Validation(NamedTuple):
    findings: DataFrame
    records: DataFrame


def run(
    corpus: Corpus,
    digests: DataFrame,
    *,
    validated_at: str,
    tool_version: str,
    only=None,
    skip=None,
    check_runs: bool = False,
) -> Validation:
    """Findings and one record per subject.

    ``digests`` comes from ``records.file_digests``. The findings are written
    once, since records and gates both read them.
    """
    checks = pick(CATALOG, only, skip, () if check_runs else ("runs",))
    findings = cut(validate(corpus, only, skip, check_runs, guarded=True))
    states = derive_state(corpus.subjects, findings, corpus.status)
    records = build_records(
        states, digests, corpus.data, corpus.status,
        checks_run=[i for c in checks for i in c.ids], checks_available=len(CATALOG),
        catalog=selection_digest(checks), tool_version=tool_version, validated_at=validated_at,
    )
    return Validation(findings, records)


def outcomes(previous: DataFrame, records: DataFrame) -> DataFrame:
    """What writing the records would change; an unchanged verdict keeps its date."""
    return change_only(previous, records, ["subject"], VOLATILE)


def stale(corpus: Corpus, records: DataFrame, digests: DataFrame, check_runs: bool = False) -> DataFrame:
    """Subjects to validate again, and why."""
    checks = pick(CATALOG, lacking=() if check_runs else ("runs",))
    published = corpus.located.filter("accession IS NOT NULL").select("accession")
    reasons = assess(
        corpus.subjects, records, digests, catalog=selection_digest(checks), published=published, data=corpus.data
    )
    return reasons.filter("stale")


def verdicts(corpus: Corpus, result: Validation, digests: DataFrame, harvested: DataFrame) -> DataFrame:
    return gates.evaluate(corpus.subjects, result.records, result.findings, digests, harvested)
