"""Queries on the review queue and the settled record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.curation import (
    decide,
    file_decisions,
    merge_proposals,
    new_candidates,
    overlay,
    progress,
    rejected,
    verify,
)
from tallymark.operators.ranking import segment_by_marker
from tallymark.plans.driver import flag, query

_LABEL_SQL = "CASE quality WHEN 1 THEN 'confirmed' WHEN 0 THEN 'not_found' ELSE 'unreviewed' END"


def _status_of_label():
    q = F.col("quality")
    return F.when(q == 1, "confirmed").when(q == 0, "not_found").otherwise("unreviewed")


def _key(column: str = "doc_id"):
    return F.col(column).alias("bioproject")


def _key_unless(elsewhere):
    """Keys of the documents; those on the condition get keys that only they have."""
    return F.when(elsewhere, -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("bioproject")


def _labelled(t) -> DataFrame:
    return t.documents.join(t.labels, "doc_id", "left")


@query(
    "q_overlay",
    f"""WITH r AS (SELECT doc_id, {_LABEL_SQL} AS r FROM labels), q AS (SELECT CASE WHEN lang = 'de' THEN -1 - doc_id ELSE doc_id END AS doc_id,
      CASE WHEN n_chars > 1000 THEN 'confirmed' ELSE 'unreviewed' END AS q FROM documents),
    b AS (SELECT coalesce(r.doc_id, q.doc_id) AS bioproject, r, q, q IS NOT NULL AND NOT (coalesce(r, '') IN ('confirmed', 'not_found') AND q = 'unreviewed') AS fq
      FROM r FULL JOIN q ON r.doc_id = q.doc_id)
    SELECT bioproject, CASE WHEN fq THEN q ELSE r END AS status, CASE WHEN fq THEN 'queue' ELSE 'record' END AS source,
      CAST(fq AND q = 'confirmed' AS INT) AS unfiled FROM b""",
)
def overlaid(t) -> DataFrame:
    record = t.labels.select(_key(), _status_of_label().alias("status"))
    queue = t.documents.select(
        _key_unless(F.col("lang") == "de"), F.when(F.col("n_chars") > 1000, "confirmed").otherwise("unreviewed").alias("status")
    )
    return overlay(record, queue).withColumn("unfiled", flag(F.col("unfiled")))


@query(
    "q_curation_progress",
    f"""WITH p AS (SELECT {_LABEL_SQL} AS status, n_chars, coalesce(toxic, 0) = 0 AS has_doi FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT count(*) FILTER (WHERE status = 'confirmed') AS n_confirmed, count(*) FILTER (WHERE status = 'not_found') AS n_not_found,
      count(*) FILTER (WHERE status = 'unreviewed') AS n_unreviewed, CAST(sum(n_chars) AS BIGINT) AS weight,
      round(100.0 * CAST(sum(n_chars) FILTER (WHERE status <> 'unreviewed') AS DOUBLE) / CAST(sum(n_chars) AS DOUBLE), 6) AS reviewed_percent,
      round(100.0 * CAST(sum(n_chars) FILTER (WHERE status = 'confirmed' AND has_doi) AS DOUBLE) / CAST(sum(n_chars) AS DOUBLE), 6) AS citable_percent FROM p""",
)
def curation_progress(t) -> DataFrame:
    projects = _labelled(t).select(
        _status_of_label().alias("status"),
        F.col("n_chars").alias("weight"),
        (F.coalesce("toxic", F.lit(0)) == 0).alias("has_doi"),
    )
    out = progress(projects)
    for c in ("reviewed_percent", "citable_percent"):
        out = out.withColumn(c, F.round(F.col(c).cast("double"), 6))
    return out


@query(
    "q_merge_record",
    """WITH c AS (SELECT DISTINCT user_id AS bioproject, event_type AS doi FROM events),
    k AS (SELECT DISTINCT user_id AS bioproject, event_type AS doi FROM events WHERE value > 40)
    SELECT bioproject, doi, 'rejected' AS role, CAST(0 AS INT) AS verified, '' AS reference FROM c WHERE (bioproject, doi) NOT IN (SELECT (bioproject, doi) FROM k)
    UNION ALL SELECT k.bioproject, k.doi, 'kept', CAST(coalesce(v.verified, FALSE) AS INT), coalesce(v.reference, '')
      FROM k LEFT JOIN (SELECT user_id, event_type, bool_or(value > 30) AS verified, max(props) AS reference FROM events GROUP BY 1, 2) v
      ON v.user_id = k.bioproject AND v.event_type = k.doi""",
)
def merged_record(t) -> DataFrame:
    pairs = t.events.select(F.col("user_id").alias("bioproject"), F.col("event_type").alias("doi"), "value", "props")
    considered = pairs.select("bioproject", "doi")
    kept = pairs.filter("value > 40").select("bioproject", "doi").distinct()
    record = pairs.groupBy("bioproject", "doi").agg(
        F.max("props").alias("reference"), F.bool_or(F.col("value") > 30).alias("verified")
    )
    filed = file_decisions(record, kept.withColumn("reference", F.lit(""))).join(kept, ["bioproject", "doi"], "left_semi")
    dropped = rejected(considered, kept)
    return filed.select(
        "bioproject", "doi", F.lit("kept").alias("role"), flag(F.col("verified")).alias("verified"), "reference"
    ).unionByName(
        dropped.select(
            "bioproject", "doi", F.lit("rejected").alias("role"), F.lit(0).alias("verified"), F.lit("").alias("reference")
        )
    )


@query(
    "q_decide_blocks",
    """WITH b AS (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS block FROM conversations),
    g AS (SELECT conv_id, block, bool_or(contains(text, '?')) AS marker, count(*) FILTER (WHERE role = 'assistant' AND length(text) > 200) AS kept,
      bool_or(regexp_matches(text, '[0-9]')) AS nf FROM b WHERE block IS NOT NULL GROUP BY 1, 2)
    SELECT conv_id, block, CASE WHEN marker THEN 'unreviewed' WHEN kept > 0 THEN 'confirmed' WHEN nf THEN 'not_found' ELSE 'unreviewed' END AS status FROM g""",
)
def decided_blocks(t) -> DataFrame:
    blocks = segment_by_marker(t.conversations, ["conv_id"], "turn", F.col("role") == "user").filter("block IS NOT NULL")
    grouped = blocks.groupBy("conv_id", "block").agg(
        F.bool_or(F.col("text").contains("?")).alias("_m"),
        F.count_if((F.col("role") == "assistant") & (F.length("text") > 200)).alias("_k"),
        F.bool_or(F.col("text").rlike("[0-9]")).alias("_n"),
    )
    return grouped.select("conv_id", "block", decide(F.col("_m"), F.col("_k"), F.col("_n")).alias("status"))


_QUEUED_SQL = f"""SELECT l.doc_id, {_LABEL_SQL} AS status, CASE WHEN toxic = 1 THEN '' ELSE 'old ' || source END AS title, '' AS submitter,
  n_chars AS weight, 1 AS n_subjects FROM labels l JOIN documents d ON d.doc_id = l.doc_id"""


@query(
    "q_merge_proposals",
    f"""WITH q AS ({_QUEUED_SQL} UNION ALL SELECT CASE WHEN lang <> 'en' THEN -1 - d.doc_id ELSE d.doc_id END, 'unreviewed', '', '', n_chars, 2
      FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)),
    p AS (SELECT CASE WHEN lang = 'de' THEN -1 - doc_id ELSE doc_id END AS doc_id, 'unreviewed' AS status, source AS title, lang AS submitter, n_chars AS weight, 1 AS n_subjects FROM documents),
    b AS (SELECT coalesce(q.doc_id, p.doc_id) AS bioproject, q.doc_id IS NULL AS is_new, p.doc_id IS NULL AS untouched,
      q.status AS qs, p.status AS ps, q.title AS qt, p.title AS pt, q.submitter AS qu, p.submitter AS pu, q.weight AS qw, p.weight AS pw, q.n_subjects AS qn, p.n_subjects AS pn
      FROM q FULL JOIN p ON p.doc_id = q.doc_id),
    m AS (SELECT *, coalesce(qs, ps) AS status, CASE WHEN is_new THEN pt WHEN NOT untouched AND qs = 'unreviewed' AND qt = '' THEN pt ELSE qt END AS title,
      CASE WHEN is_new THEN pu WHEN NOT untouched AND qs = 'unreviewed' AND qu = '' THEN pu ELSE qu END AS submitter FROM b)
    SELECT bioproject, status, title, submitter, CASE WHEN untouched THEN qw ELSE pw END AS weight, CAST(CASE WHEN untouched THEN qn ELSE pn END AS BIGINT) AS n_subjects,
      CAST(CASE WHEN is_new THEN TRUE WHEN untouched THEN FALSE ELSE title <> qt OR submitter <> qu OR qw <> pw OR qn <> pn END AS INT) AS changed FROM m""",
)
def merged_proposals(t) -> DataFrame:
    blank = F.lit("")
    n = lambda v: F.lit(v).cast("bigint").alias("n_subjects")
    weight = F.col("n_chars").alias("weight")
    settled = t.labels.join(t.documents, "doc_id").select(
        _key(), _status_of_label().alias("status"),
        F.when(F.col("toxic") == 1, "").otherwise(F.concat(F.lit("old "), "source")).alias("title"),
        blank.alias("submitter"), weight, n(1),
    )
    waiting = t.documents.join(t.labels, "doc_id", "left_anti").select(
        _key_unless(F.col("lang") != "en"), F.lit("unreviewed").alias("status"), blank.alias("title"), blank.alias("submitter"), weight, n(2)
    )
    proposed = t.documents.select(
        _key_unless(F.col("lang") == "de"), F.lit("unreviewed").alias("status"), F.col("source").alias("title"), F.col("lang").alias("submitter"), weight, n(1)
    )
    return merge_proposals(settled.unionByName(waiting), proposed).withColumn("changed", flag(F.col("changed")))


@query(
    "q_reopen",
    """SELECT DISTINCT d.doc_id AS bioproject, doi FROM documents d JOIN labels l ON l.doc_id = d.doc_id, unnest([source, lang]) u(doi)
    WHERE quality = 0 AND NOT (n_chars > 1000 AND doi = source) AND NOT (toxic = 1 AND doi = lang)""",
)
def reopened_projects(t) -> DataFrame:
    settled = t.labels.select(_key(), _status_of_label().alias("status"))
    candidates = t.documents.select(_key(), F.explode(F.array("source", "lang")).alias("doi"))
    accepted = t.documents.filter("n_chars > 1000").select(_key(), F.col("source").alias("doi"))
    turned_down = t.documents.join(t.labels.filter("toxic = 1"), "doc_id").select(_key(), F.col("lang").alias("doi"))
    return new_candidates(settled, candidates, accepted, turned_down).select("bioproject", "doi")


@query(
    "q_verify_keys",
    """SELECT l.doc_id AS bioproject, CASE WHEN d.doc_id IS NULL OR lang = 'de' THEN 'outage' WHEN n_chars > 500 THEN 'resolved' ELSE 'bad' END AS outcome,
      CASE WHEN d.doc_id IS NOT NULL AND lang <> 'de' AND n_chars > 500 THEN source ELSE '' END AS reference
    FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id WHERE quality = 1""",
)
def verified_keys(t) -> DataFrame:
    record = t.labels.select(
        _key(), F.col("doc_id").alias("doi"), F.lit("").alias("reference"), (F.col("quality") == 0).alias("verified")
    )
    works = t.documents.select(
        F.col("doc_id").alias("doi"),
        (F.col("n_chars") > 500).alias("found"),
        F.when(F.col("lang") == "de", "timed out").alias("error"),
        F.col("source").alias("reference"),
    )
    return verify(record, works).select("bioproject", "outcome", "reference")
