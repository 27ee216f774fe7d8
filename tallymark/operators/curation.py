"""The review queue and the settled record of citations.

Candidates are rows ``(bioproject, doi, reference, role, ...)``, never
arrays per project: ``role`` is ``kept``, ``considered`` or ``rejected``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decide(marker: Column, kept: Column, not_found: Column) -> Column:
    """Status of a queue block from what a reviewer left standing."""
    return (
        F.when(marker, "unreviewed")
        .when(kept > 0, "confirmed")
        .when(not_found, "not_found")
        .otherwise("unreviewed")
    )


def undecided_by_silence(marker: Column, kept: Column, not_found: Column) -> Column:
    """Every line was deleted: nothing is asserted (issue C010)."""
    return ~marker & (kept == 0) & ~not_found


def is_reviewed(status: Column) -> Column:
    return F.coalesce(status.isin("confirmed", "not_found"), F.lit(False))


def rejected(considered: DataFrame, kept: DataFrame) -> DataFrame:
    """Candidates put before a reviewer and no longer there."""
    return considered.select("bioproject", "doi").distinct().join(
        kept.select("bioproject", "doi"), ["bioproject", "doi"], "left_anti"
    )


def overlay(record: DataFrame, queue: DataFrame) -> DataFrame:
    """Queue over record; an undecided block never un-decides a settled one.

    Both have one row per ``bioproject`` with ``status``. ``source`` says
    which side won and ``unfiled`` marks decisions not yet in the record.
    """
    both = record.select("bioproject", F.col("status").alias("_r")).join(
        queue.select("bioproject", F.col("status").alias("_q")), "bioproject", "full_outer"
    )
    settled = is_reviewed(F.col("_r")) & ~is_reviewed(F.col("_q"))
    from_queue = F.col("_q").isNotNull() & ~settled
    return both.select(
        "bioproject",
        F.when(from_queue, F.col("_q")).otherwise(F.col("_r")).alias("status"),
        F.when(from_queue, "queue").otherwise("record").alias("source"),
        (from_queue & is_reviewed(F.col("_q"))).alias("unfiled"),
    )


def ranked_queue(
    projects: DataFrame, key: str = "bioproject", weight: str = "weight",
    breadth: str = "n_subjects", limit: int | None = None,
) -> DataFrame:
    """Heaviest first, then the most widely used, then by key."""
    ordered = projects.orderBy(F.desc(weight), F.desc(breadth), key)
    return ordered if limit is None else ordered.limit(limit)


def to_look_up(
    weights: DataFrame, index: DataFrame, queue_kept: DataFrame, limit: int | None = None
) -> DataFrame:
    """Known projects that are not confirmed and have no queued candidate."""
    settled = index.filter("status = 'confirmed'").select("bioproject")
    offered = queue_kept.select("bioproject").distinct()
    known = weights.select("bioproject", "weight", "n_subjects").join(
        index.select("bioproject").distinct(), "bioproject", "full_outer"
    )
    wanted = (
        known.withColumn("weight", F.coalesce("weight", F.lit(0).cast("bigint")))
        .withColumn("n_subjects", F.coalesce("n_subjects", F.lit(0).cast("bigint")))
        .join(settled, "bioproject", "left_anti")
        .join(offered, "bioproject", "left_anti")
    )
    return ranked_queue(wanted, limit=limit)


def new_candidates(
    settled: DataFrame, candidates: DataFrame, accepted: DataFrame, turned_down: DataFrame
) -> DataFrame:
    """Candidates that reopen a not-found project: neither accepted nor rejected."""
    open_again = settled.filter("status = 'not_found'").select("bioproject")
    known = accepted.select("bioproject", "doi").unionByName(
        turned_down.select("bioproject", "doi")
    )
    return (
        candidates.join(open_again, "bioproject", "left_semi")
        .dropDuplicates(["bioproject", "doi"])
        .join(known, ["bioproject", "doi"], "left_anti")
    )


def reopened(
    settled: DataFrame, candidates: DataFrame, accepted: DataFrame, turned_down: DataFrame
) -> DataFrame:
    """Rows of revived queue blocks: unseen kept, unseen and rejected considered."""
    unseen = new_candidates(settled, candidates, accepted, turned_down).select("bioproject", "doi")
    again = turned_down.select("bioproject", "doi").join(
        unseen.select("bioproject").distinct(), "bioproject", "left_semi"
    )
    return (
        unseen.withColumn("role", F.lit("kept"))
        .unionByName(unseen.withColumn("role", F.lit("considered")))
        .unionByName(again.withColumn("role", F.lit("considered")))
        .distinct()
    )


def merge_proposals(queued: DataFrame, proposed: DataFrame) -> DataFrame:
    """Project rows of the queue after a proposal run.

    Columns: ``bioproject, status, title, submitter, weight, n_subjects``.
    Blank titles and submitters of undecided blocks are filled, weights
    always refreshed, and everything else left to the reviewer.
    """
    q = queued.select("bioproject", F.struct("status", "title", "submitter", "weight", "n_subjects").alias("q"))
    p = proposed.select("bioproject", F.struct("status", "title", "submitter", "weight", "n_subjects").alias("p"))
    both = q.join(p, "bioproject", "full_outer")
    is_new = F.col("q").isNull()
    untouched = F.col("p").isNull()
    editable = ~is_reviewed(F.col("q.status"))

    def filled(name: str) -> Column:
        old = F.coalesce(F.col(f"q.{name}"), F.lit(""))
        return F.when(editable & (old == ""), F.coalesce(F.col(f"p.{name}"), F.lit(""))).otherwise(old)

    def settled(name: str) -> Column:
        return F.when(is_new, F.coalesce(F.col(f"p.{name}"), F.lit(""))).when(
            untouched, F.coalesce(F.col(f"q.{name}"), F.lit(""))
        ).otherwise(filled(name))

    def refreshed(name: str) -> Column:
        return F.when(untouched, F.col(f"q.{name}")).otherwise(F.col(f"p.{name}"))

    touched = (
        (filled("title") != F.coalesce(F.col("q.title"), F.lit("")))
        | (filled("submitter") != F.coalesce(F.col("q.submitter"), F.lit("")))
        | ~F.col("q.weight").eqNullSafe(F.col("p.weight"))
        | ~F.col("q.n_subjects").eqNullSafe(F.col("p.n_subjects"))
    )
    return both.select(
        "bioproject",
        F.coalesce("q.status", "p.status").alias("status"),
        settled("title").alias("title"),
        settled("submitter").alias("submitter"),
        refreshed("weight").alias("weight"),
        refreshed("n_subjects").alias("n_subjects"),
        F.when(is_new, F.lit(True)).when(untouched, F.lit(False)).otherwise(touched).alias("changed"),
    )


def merge_candidates(
    queued: DataFrame, proposed: DataFrame, decided: DataFrame, turned_down: DataFrame
) -> DataFrame:
    """Candidate rows of the queue after a proposal run.

    Columns ``bioproject, doi, reference, starred``. Proposals are appended
    to new and undecided blocks only, never one already there or rejected.
    """
    fresh = (
        proposed.dropDuplicates(["bioproject", "doi"])
        .join(decided.select("bioproject"), "bioproject", "left_anti")
        .join(queued.select("bioproject", "doi"), ["bioproject", "doi"], "left_anti")
        .join(turned_down.select("bioproject", "doi"), ["bioproject", "doi"], "left_anti")
    )
    columns = ["bioproject", "doi", "reference", "starred"]
    return queued.select(*columns, F.lit(False).alias("added")).unionByName(
        fresh.select(*columns, F.lit(True).alias("added"))
    )


def file_decisions(record: DataFrame, decided: DataFrame) -> DataFrame:
    """Citation rows after filing decided blocks into the record.

    Columns ``bioproject, doi, reference, verified``. The decision owns which
    rows stay; the record owns verification and fills blank references.
    Projects without a decision keep their rows.
    """
    known = record.select(
        "bioproject", "doi", F.col("reference").alias("_r"), F.col("verified").alias("_v")
    )
    filed = decided.join(known, ["bioproject", "doi"], "left").select(
        "bioproject",
        "doi",
        F.coalesce(F.when(F.col("reference") != "", F.col("reference")), "_r", F.lit("")).alias("reference"),
        F.coalesce("_v", F.lit(False)).alias("verified"),
    )
    kept = record.join(decided.select("bioproject").distinct(), "bioproject", "left_anti")
    return filed.unionByName(kept.select("bioproject", "doi", "reference", "verified"))


def verify(record: DataFrame, works: DataFrame) -> DataFrame:
    """Outcome per unverified citation, with its reference filled if blank.

    ``works`` has ``doi``, ``found``, ``error`` and ``reference``. A failed
    lookup is no verdict: ``outage`` is neither resolved nor bad.
    """
    pending = record.filter(~F.coalesce(F.col("verified"), F.lit(False)))
    looked = works.select(
        "doi", "found", "error", F.col("reference").alias("_ref"), F.lit(1).alias("_seen")
    )
    outcome = (
        F.when(F.col("_seen").isNull() | F.col("error").isNotNull(), "outage")
        .when(F.col("found"), "resolved")
        .otherwise("bad")
    )
    return (
        pending.join(looked, "doi", "left")
        .withColumn("outcome", outcome)
        .select(
            "bioproject",
            "doi",
            "outcome",
            F.when(
                (F.col("outcome") == "resolved") & (F.coalesce("reference", F.lit("")) == ""),
                F.coalesce("_ref", F.lit("")),
            ).otherwise(F.coalesce("reference", F.lit(""))).alias("reference"),
        )
    )


def any_outage(outcomes: DataFrame) -> DataFrame:
    """One row: may the results be written at all."""
    return outcomes.agg(
        F.coalesce(F.bool_or(F.col("outcome") == "outage"), F.lit(False)).alias("blocked"),
        F.count_if(F.col("outcome") == "outage").alias("n_outages"),
    )


def progress(projects: DataFrame) -> DataFrame:
    """Counts by status and the reviewed and citable share of the weight."""
    reviewed = is_reviewed(F.col("status"))
    citable = (F.col("status") == "confirmed") & F.col("has_doi")
    total = F.sum("weight")
    share = lambda c: F.when(
        total > 0, F.lit(100.0) * F.coalesce(F.sum(F.when(c, F.col("weight"))), F.lit(0)) / total
    )
    return projects.agg(
        *[
            F.count_if(F.col("status") == s).alias(f"n_{s}")
            for s in ("confirmed", "not_found", "unreviewed")
        ],
        total.cast("bigint").alias("weight"),
        share(reviewed).alias("reviewed_percent"),
        share(citable).alias("citable_percent"),
    )


def citation_lines(weights: DataFrame, index: DataFrame, citations: DataFrame) -> DataFrame:
    """Rows of a subject's reference list.

    One row per accepted citation, or one saying why there is none. Columns
    ``subject, bioproject, weight`` come from ``weights``.
    """
    confirmed = F.col("status") == "confirmed"
    text = (
        F.when(confirmed & F.col("doi").isNotNull(), F.coalesce(F.when(F.col("reference") != "", F.col("reference")), F.col("doi")))
        .when(F.col("status") == "not_found", "no publication found")
        .otherwise("citation not yet reviewed")
    )
    return (
        weights.join(index.select("bioproject", "status"), "bioproject", "left")
        .join(
            citations.select("bioproject", "doi", "reference"), "bioproject", "left"
        )
        .select("subject", "bioproject", "weight", F.when(confirmed, F.col("doi")).alias("doi"), text.alias("line"))
        .distinct()
    )


def coverage(weights: DataFrame, index: DataFrame, citations: DataFrame) -> DataFrame:
    """Per subject: cited projects and samples out of all of them."""
    citable = (
        index.filter("status = 'confirmed'")
        .join(citations.select("bioproject"), "bioproject", "left_semi")
        .select("bioproject", F.lit(1).alias("_c"))
    )
    cited = F.col("_c") == 1
    return (
        weights.join(citable, "bioproject", "left")
        .groupBy("subject")
        .agg(
            F.count_if(cited).alias("n_cited"),
            F.count(F.lit(1)).alias("n_projects"),
            F.coalesce(F.sum(F.when(cited, F.col("weight"))), F.lit(0)).alias("cited_samples"),
            F.sum("weight").alias("samples"),
        )
    )


def reading_order(candidates: DataFrame, pos: str = "pos") -> DataFrame:
    """Candidates as a reviewer reads them: starred ones first, else as found."""
    return candidates.orderBy("bioproject", ~F.col("starred"), pos)
