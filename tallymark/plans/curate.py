"""The curation jobs: weigh projects, propose candidates, file decisions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import affiliation_matches
from tallymark.operators import curation as cu
from tallymark.operators.rollup import project_weights
from tallymark.plans.corpus import Corpus
from tallymark.plans.harvest import attributed_runs


class Proposals(NamedTuple):
    projects: DataFrame
    candidates: DataFrame
    guard: DataFrame


def survey(corpus: Corpus) -> DataFrame:
    """Samples and subjects behind every project, used or only documented."""
    used = attributed_runs(corpus).filter("bioproject IS NOT NULL")
    documented = corpus.readme.select("subject", F.explode("bioprojects").alias("bioproject")).distinct()
    return project_weights(used, documented, "bioproject", "subject", "sample_id")


def propose(
    wanted: DataFrame,
    summaries: DataFrame,
    candidates: DataFrame,
    lookups: DataFrame,
    index: DataFrame,
    citations: DataFrame,
) -> Proposals:
    """New queue blocks for the projects looked up.

    ``wanted`` comes from ``curation.to_look_up``; ``candidates`` and
    ``lookups`` from ``registry.literature_hits``; ``citations`` are the
    record's rows. A project settled as not found comes back only with a
    candidate nobody has seen. ``guard`` tells whether a lookup failed, in
    which case nothing may be written.
    """
    described = wanted.join(summaries.select("bioproject", "title", "submitter"), "bioproject", "left")
    found = (
        candidates.filter("doi <> ''")
        .join(described.select("bioproject", "submitter"), "bioproject")
        .withColumn(
            "starred",
            F.coalesce(affiliation_matches(F.col("submitter"), F.col("affiliations")), F.lit(False)),
        )
        .select("bioproject", "pos", "doi", "reference", "starred")
    )
    accepted, turned_down = (citations.filter(F.col("role") == r) for r in ("kept", "rejected"))
    unseen = cu.new_candidates(index, found, accepted, turned_down)
    closed = index.filter("status = 'not_found'").select("bioproject")
    revived = unseen.select("bioproject").distinct()
    offered = found.join(closed, "bioproject", "left_anti").unionByName(unseen)
    silent = closed.join(revived, "bioproject", "left_anti")
    projects = described.join(silent, "bioproject", "left_anti").select(
        "bioproject", F.lit("unreviewed").alias("status"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("submitter", F.lit("")).alias("submitter"), "weight", "n_subjects",
    )
    states = wanted.join(lookups.select("bioproject", "error", F.lit(1).alias("_seen")), "bioproject", "left")
    outcome = F.when(F.col("_seen").isNull() | F.col("error").isNotNull(), "outage").otherwise("resolved")
    return Proposals(projects, cu.reading_order(offered), cu.any_outage(states.select(outcome.alias("outcome"))))


def collect(
    queue_projects: DataFrame, queue_candidates: DataFrame, record: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Record rows after filing decided blocks, and the projects still queued.

    ``record`` has the rows of ``sources.curation.parse_record``.
    """
    decided = queue_projects.filter(cu.is_reviewed(F.col("status"))).select("bioproject")
    mine = queue_candidates.join(decided, "bioproject", "left_semi")
    kept = mine.filter("role = 'kept'").select("bioproject", "doi", "reference")
    old = record.filter("role = 'kept'")
    # A project decided as not found keeps no citation.
    still = old.join(decided, "bioproject", "left_anti")
    touched = old.join(decided, "bioproject", "left_semi")
    filed = cu.file_decisions(touched, kept).join(kept, ["bioproject", "doi"], "left_semi")
    rejections = (
        record.filter("role = 'rejected'")
        .select("bioproject", "doi")
        .unionByName(mine.filter("role = 'rejected'").select("bioproject", "doi"))
        .distinct()
    )
    columns = ["bioproject", "doi", "reference", "verified"]
    rows = (
        still.select(*columns)
        .unionByName(filed.select(*columns))
        .withColumn("role", F.lit("kept"))
        .unionByName(
            rejections.select(
                "bioproject", "doi", F.lit("").alias("reference"), F.lit(False).alias("verified"), F.lit("rejected").alias("role")
            )
        )
    )
    return rows, queue_projects.join(decided, "bioproject", "left_anti")
