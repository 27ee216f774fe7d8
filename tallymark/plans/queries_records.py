"""Queries on verdicts, records, staleness and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import sha256_tag
from tallymark.operators.curation import any_outage
from tallymark.operators.gates import gate_outcomes, soundness
from tallymark.operators.records import assess, build_records, derive_state, mark_stale
from tallymark.operators.reconcile import missing_from
from tallymark.operators.rollup import counts_with_zeros
from tallymark.plans.driver import (
    DAY_SQL,
    SEVERITY_SQL,
    SUBJECT_SQL,
    flag,
    query,
    severity_of,
    user_days,
)
from tallymark.plans.queries_sources import PART_FINDINGS_SQL, part_findings
from tallymark.plans.registry import finding, text

_DAYS_SQL = f"""WITH e AS (SELECT {SUBJECT_SQL} AS subject, {SEVERITY_SQL} AS severity, event_type, value FROM events),
  d AS (SELECT subject, count(*) AS n, bool_or(severity = 'error') AS err, bool_or(severity = 'warn') AS wrn,
    bool_or(severity = 'info') AS inf FROM e GROUP BY 1)"""


def _days(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """User-days as subjects, their findings and a publication status."""
    rows = user_days(t.events).withColumn("severity", severity_of())
    status = rows.groupBy("subject").agg(
        F.when(F.count(F.lit(1)) > 1, "complete").otherwise("partial").alias("state")
    )
    return status.select("subject"), rows.filter("severity IS NOT NULL"), status


@query(
    "q_derive_state",
    _DAYS_SQL
    + """ SELECT subject, CASE WHEN err THEN 'FAIL' WHEN n <= 1 THEN 'PENDING' WHEN wrn THEN 'PASS WITH WARNINGS'
      WHEN inf THEN 'PASS WITH NOTES' ELSE 'PASS' END AS state FROM d""",
)
def derived_states(t) -> DataFrame:
    subjects, found, status = _days(t)
    return derive_state(subjects, found.select("subject", "severity"), status).select("subject", "state")


@query(
    "q_lookup_errors",
    _DAYS_SQL + " SELECT CAST(bool_or(err) AS INT) AS blocked, count(*) FILTER (WHERE err) AS n_outages, count(*) AS n_subjects FROM d",
)
def lookup_errors(t) -> DataFrame:
    outcome = F.when(F.bool_or(F.col("event_type") == "error"), "outage").otherwise("resolved")
    days = user_days(t.events).groupBy("subject").agg(outcome.alias("outcome"))
    guard = any_outage(days)
    total = days.agg(F.count(F.lit(1)).alias("n_subjects"))
    # Both sides are one row; the totals ride along as a scalar subquery.
    return guard.select(flag(F.col("blocked")).alias("blocked"), "n_outages", total.scalar().alias("n_subjects"))


@query(
    "q_findings_all",
    f"""WITH f AS ({PART_FINDINGS_SQL}
      UNION ALL SELECT 'Y001', 'error', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
      UNION ALL SELECT 'Y002', 'warn', l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus <> o_orderstatus)
    SELECT id, severity, count(*) AS n, count(DISTINCT subject) AS n_subjects FROM f GROUP BY 1, 2""",
)
def findings_all(t) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("subject"), "o_orderstatus")
    lines = t.lineitem.select(F.col("l_orderkey").alias("subject"), "l_linestatus", "l_linenumber")
    empty = missing_from(orders, lines.select("subject").distinct(), ["subject"])
    # Orders are the small and unique side, so lines need not be sorted to meet them.
    odd = lines.join(orders.hint("shuffle_hash"), "subject").filter("l_linestatus <> o_orderstatus")
    found = [
        part_findings(t),
        finding(empty, "Y001", "error", text("no line item")),
        finding(odd, "Y002", "warn", text("status"), line=F.col("l_linenumber")),
    ]
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("id", "severity", "subject")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("id", "severity")
        .agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_subjects"))
    )


@query(
    "q_build_record",
    """WITH l AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n_error, count(*) FILTER (WHERE l_returnflag = 'A') AS n_warn,
        count(*) FILTER (WHERE l_returnflag = 'N') AS n_info FROM lineitem GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS subject, CASE WHEN n_error > 0 THEN 'FAIL' WHEN o_orderstatus <> 'F' THEN 'PENDING'
        WHEN n_warn > 0 THEN 'PASS WITH WARNINGS' WHEN n_info > 0 THEN 'PASS WITH NOTES' ELSE 'PASS' END AS state,
      coalesce(n_error, 0) AS n_error, coalesce(n_warn, 0) AS n_warn, 'README.txt=sha256:' || sha256(o_orderpriority) || ';config.yaml=sha256:' || sha256(o_orderstatus) AS inputs,
      CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'partial' ELSE 'absent' END AS published, 1 AS is_partial FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""",
)
def built_records(t) -> DataFrame:
    subject = F.col("o_orderkey").cast("string").alias("subject")
    severity = F.when(F.col("l_returnflag") == "R", "error").when(F.col("l_returnflag") == "A", "warn").otherwise("info")
    found = t.lineitem.select(F.col("l_orderkey").cast("string").alias("subject"), severity.alias("severity"))
    state = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "O", "partial").otherwise("absent")
    status = t.orders.select(subject, state.alias("state"))
    files = F.array(
        F.struct(F.lit("config.yaml").alias("name"), sha256_tag(F.col("o_orderstatus")).alias("digest")),
        F.struct(F.lit("README.txt").alias("name"), sha256_tag(F.col("o_orderpriority")).alias("digest")),
    )
    inputs = t.orders.select(subject, F.inline(files))
    data = t.orders.select(subject, F.struct(F.lit(True).alias("published"), F.lit(None).cast("string").alias("accession")).alias("data"))
    records = build_records(
        derive_state(status, found, status), inputs, data, status, checks_run=["R001", "S001"], checks_available=44,
        catalog="sha256:0", tool_version="1", validated_at="2024-01-01T00:00:00Z",
    )
    pairs = F.transform(F.array_sort(F.map_entries("inputs")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return records.select(
        "subject", "state", F.col("counts.n_error").alias("n_error"), F.col("counts.n_warn").alias("n_warn"),
        F.array_join(pairs, ";").alias("inputs"), F.col("status.state").alias("published"), flag(F.col("is_partial")).alias("is_partial"),
    )


def _documents(t) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents as subjects whose labels hold an earlier verdict.

    The recorded input is the text without its digits, so a document has
    changed exactly when it holds a digit.
    """
    subject = F.col("doc_id").cast("string").alias("subject")
    text_of = t.documents.select(subject, "text", "n_chars", "lang")
    then = sha256_tag(F.regexp_replace("text", "[0-9]", ""))
    state = F.when(F.col("quality") == 0, "FAIL").otherwise("PASS")
    known = t.labels.select(F.col("doc_id").cast("string").alias("subject"), "quality", "toxic")
    records = text_of.join(known, "subject").select(
        "subject",
        state.alias("state"),
        F.lit("2024-01-01T00:00:00Z").alias("validated_at"),
        F.lit("1").alias("tool_version"),
        F.when(F.col("toxic") == 1, "old").otherwise("new").alias("catalog"),
        F.create_map(F.lit("README.txt"), then).alias("inputs"),
        F.struct(
            (F.col("lang") != "de").alias("published"), F.concat(F.lit("acc-"), "lang").alias("accession")
        ).alias("data"),
        F.struct(F.when(F.col("n_chars") > 3000, 1).otherwise(0).alias("n_warn")).alias("counts"),
        F.lit(None).cast("struct<state:string,validated_at:string,tool_version:string,catalog:string,stale_reason:string>").alias("superseded"),
        F.lit(None).cast("string").alias("stale_reason"),
    )
    digests = text_of.select("subject", F.lit("README.txt").alias("name"), sha256_tag(F.col("text")).alias("digest"))
    published = t.documents.select(F.concat(F.lit("acc-"), "lang").alias("accession")).distinct()
    return text_of.select("subject"), records, digests, published, text_of


_STALE_SQL = """WITH r AS (SELECT CAST(d.doc_id AS VARCHAR) AS subject, quality, CASE WHEN quality IS NULL THEN 'no previous report'
    WHEN regexp_matches(text, '[0-9]') THEN 'README.txt changed since validation' WHEN toxic = 1 THEN 'the check catalog changed'
    WHEN lang = 'de' THEN 'data has been published since validation' WHEN quality = 0 THEN 'last validation was FAIL'
    WHEN n_chars > 3000 THEN 'last validation raised warnings' END AS reason FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


@query("q_staleness", _STALE_SQL + " SELECT subject, reason, CAST(reason IS NOT NULL AS INT) AS stale FROM r")
def staleness(t) -> DataFrame:
    subjects, records, digests, published, _ = _documents(t)
    reasons = assess(subjects, records, digests, catalog="new", published=published)
    return reasons.withColumn("stale", flag(F.col("stale")))


@query(
    "q_mark_stale",
    _STALE_SQL
    + """, m AS (SELECT *, coalesce(contains(reason, ' since validation'), FALSE) AS stamp, CASE WHEN quality = 0 THEN 'FAIL' ELSE 'PASS' END AS old FROM r WHERE quality IS NOT NULL)
    SELECT subject, CASE WHEN stamp THEN 'STALE' ELSE old END AS state, CASE WHEN stamp THEN old END AS superseded, CASE WHEN stamp THEN reason END AS stale_reason FROM m""",
)
def marked_stale(t) -> DataFrame:
    subjects, records, digests, published, _ = _documents(t)
    reasons = assess(subjects, records, digests, catalog="new", published=published)
    once = mark_stale(records, reasons)
    return once.select("subject", "state", F.col("superseded.state").alias("superseded"), "stale_reason")


CHECKS = ("click", "error", "purchase", "signup", "view", "absent")

_GATE_SQL = f"""WITH e AS (SELECT {SUBJECT_SQL} AS subject, event_type AS id, CASE WHEN value < 5 THEN 'skipped' ELSE 'warn' END AS severity,
    value FROM events),
  d AS (SELECT subject, list(DISTINCT id) AS ran FROM e GROUP BY 1),
  f AS (SELECT subject, id, bool_or(severity <> 'skipped') AS fired FROM e WHERE value < 20 GROUP BY 1, 2),
  o AS (SELECT d.subject, c.id AS "check", c.rank, CASE WHEN NOT list_contains(ran, c.id) THEN 'not_run' WHEN fired IS NULL THEN 'passed'
      WHEN fired THEN 'fired' ELSE 'skipped' END AS outcome
    FROM d CROSS JOIN (VALUES ('click', 0), ('error', 1), ('purchase', 2), ('signup', 3), ('view', 4), ('absent', 5)) c(id, rank)
    LEFT JOIN f ON f.subject = d.subject AND f.id = c.id),
  v AS (SELECT subject, bool_and(outcome = 'passed') FILTER (WHERE outcome <> 'not_run') AS cited,
    bool_or("check" IN ('error', 'view') AND outcome = 'fired') AS wrong, bool_or("check" = 'error' AND outcome = 'fired') AS blocked FROM o GROUP BY 1),
  g AS (SELECT subject, CASE WHEN blocked THEN 'truncated' ELSE 'full' END AS mode, CAST(coalesce(cited, TRUE) AS INT) AS cited,
    CASE WHEN NOT coalesce(cited, TRUE) THEN CASE WHEN wrong THEN 'wrong' ELSE 'missing' END END AS provenance FROM v)"""


def _gating(t) -> DataFrame:
    days = user_days(t.events)
    # At most one entry per event type.
    ran = days.groupBy("subject").agg(F.collect_set("event_type").alias("checks_run"))
    severity = F.when(F.col("value") < 5, "skipped").otherwise("warn")
    found = days.filter("value < 20").select("subject", F.col("event_type").alias("id"), severity.alias("severity"))
    return gate_outcomes(ran, found, CHECKS)


@query("q_gate_outcomes", _GATE_SQL + ' SELECT subject, "check", outcome FROM o')
def gating_outcomes(t) -> DataFrame:
    return _gating(t).select("subject", F.inline("gating"))


def _verdicts(t) -> DataFrame:
    gated = _gating(t)
    # Only checks that ran take part here, so that some days are citable.
    ran = F.filter("gating", lambda g: g["outcome"] != "not_run")
    cited, provenance = soundness(ran, ("error", "view"))
    broken = F.exists("gating", lambda g: (g["check"] == "error") & (g["outcome"] == "fired"))
    return gated.select(
        "subject", F.when(broken, "truncated").otherwise("full").alias("mode"), cited.alias("cited"), provenance.alias("provenance")
    )


@query("q_gate_verdict", _GATE_SQL + " SELECT subject, mode, cited, provenance FROM g")
def gate_verdicts(t) -> DataFrame:
    return _verdicts(t).withColumn("cited", flag(F.col("cited")))


@query(
    "q_gate_report",
    _GATE_SQL
    + """ SELECT v.name AS "group", v.rank, count(g.subject) AS n FROM (VALUES ('cited', 0), ('blocked', 1), ('truncated', 2)) v(name, rank)
    LEFT JOIN g ON v.name = CASE WHEN mode = 'truncated' THEN 'truncated' WHEN cited = 1 THEN 'cited' ELSE 'blocked' END GROUP BY 1, 2""",
)
def gate_groups(t) -> DataFrame:
    group = F.when(F.col("mode") == "truncated", "truncated").when(F.col("cited"), "cited").otherwise("blocked")
    return counts_with_zeros(_verdicts(t).select(group.alias("group")), "group", ("cited", "blocked", "truncated"))


@query(
    "q_lookup_expired",
    """WITH f AS (SELECT DISTINCT user_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY AND event_type = 'purchase')
    SELECT user_id, max(event_id) AS last_seen FROM events WHERE user_id NOT IN (SELECT user_id FROM f) GROUP BY 1""",
)
def lookup_expired(t) -> DataFrame:
    now = t.events.select(F.max("ts")).scalar()
    fresh = t.events.filter((F.col("event_type") == "purchase") & (F.col("ts") > now - F.expr("INTERVAL 7 DAYS")))
    return (
        t.events.groupBy("user_id")
        .agg(F.max("event_id").alias("last_seen"))
        .join(fresh.select("user_id"), "user_id", "left_anti")
    )
