"""Queries on scanning, parsing and single-table predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.identifiers import (
    counterpart,
    extract_ids,
    same_assembly,
)
from tallymark.functions.text import (
    binomial_slug,
    blank_to_null,
    describe,
    normalized_document,
    reference_line,
    sha256_tag,
    slugify,
)
from tallymark.functions.values import SEVERITIES, nested
from tallymark.operators.lookup import resolve_unique
from tallymark.operators.ranking import (
    described,
    first_n,
    first_per_key,
    last_per_key,
    later_occurrences,
    numbered,
    segment_by_marker,
)
from tallymark.operators.reconcile import missing_from, two_sided, without_companion
from tallymark.operators.rollup import counts_with_zeros, long_metrics
from tallymark.operators.upsert import change_only, without_failed
from tallymark.plans.catalog import issues_to_findings
from tallymark.plans.driver import (
    DAY_SQL,
    SEVERITY_SQL,
    SUBJECT_SQL,
    cents,
    cents_sql,
    described_sql,
    flag,
    query,
    severity_of,
    since,
    user_days,
)
from tallymark.plans.registry import Check, finding, prefixes, skipped, text
from tallymark.sources.lines import comma_fields, is_blank, quoted_records
from tallymark.sources.metadata import labelled_value
from tallymark.sources.observed import classify_lines, tag_records
from tallymark.sources.records import projected


@query(
    "q_subjects_by_partition",
    """SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders GROUP BY 1""",
)
def subjects_by_partition(t) -> DataFrame:
    return (
        t.orders.groupBy("o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@query(
    "q_lookup_unambiguous",
    """WITH t AS (SELECT DISTINCT p_brand || '-' || s AS key FROM part, range(1, 61) r(s)),
    c AS (SELECT p_brand || '-' || p_size AS key, count(*) AS n, min(p_partkey) AS one FROM part GROUP BY 1)
    SELECT t.key, coalesce(n, 0) AS n,
      CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'missing' END AS outcome,
      CASE WHEN n = 1 THEN one END AS p_partkey
    FROM t LEFT JOIN c USING (key)""",
)
def lookup_unambiguous(t) -> DataFrame:
    key = lambda size: F.concat_ws("-", "p_brand", size.cast("string"))
    targets = (
        t.part.select("p_brand").distinct()
        .withColumn("_s", F.explode(F.sequence(F.lit(1), F.lit(60))))
        .select(key(F.col("_s")).alias("key"))
    )
    candidates = t.part.select(key(F.col("p_size")).alias("key"), "p_partkey")
    return resolve_unique(targets, candidates, "key", "p_partkey")


@query(
    "q_tolerant_rows",
    """WITH l AS (SELECT source, trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
    k AS (SELECT source, CASE WHEN line = '' THEN 'blank'
        WHEN len(string_split(line, ' ')) < 3 THEN 'short' ELSE 'kept' END AS kind FROM l)
    SELECT source, count(*) FILTER (WHERE kind = 'kept') AS kept,
      count(*) FILTER (WHERE kind = 'blank') AS blank,
      count(*) FILTER (WHERE kind = 'short') AS short FROM k GROUP BY 1""",
)
def tolerant_rows(t) -> DataFrame:
    lines = t.documents.select("source", F.explode(F.split("text", "\n")).alias("line"))
    fields = F.split(F.trim("line"), " ")
    kind = F.when(is_blank(fields), "blank").when(F.size(fields) < 3, "short").otherwise("kept")
    return (
        lines.withColumn("kind", kind)
        .groupBy("source")
        .agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("kept", "blank", "short")])
    )


@query(
    "q_quoted_records",
    """SELECT source AS path, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS line, length(text) AS n_chars, md5(text) AS digest
    FROM (SELECT coalesce(source, '') AS source, doc_id, coalesce(text, '') AS text FROM documents)""",
)
def quoted_records_of_documents(t) -> DataFrame:
    """A file for each source with a row for each document, whose text is a quoted field over many lines."""
    text = F.coalesce("text", F.lit(""))
    row = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    parts = t.documents.select(F.coalesce("source", F.lit("")).alias("path"), "doc_id", F.posexplode(F.split(row, "\n")).alias("k", "value"))
    numbered_lines = numbered(parts, ["path"], [F.floor(F.col("doc_id") / 1000)], ["doc_id", "k"], out="line")
    records = quoted_records(numbered_lines.select("path", "line", "value"), ["path"], longest=1 << 28)
    fields = comma_fields(F.col("value"))
    return records.filter("whole").select(
        "path", F.get(fields, F.lit(0)).cast("bigint").alias("doc_id"), "line",
        F.length(F.get(fields, F.lit(1))).cast("bigint").alias("n_chars"), F.md5(F.get(fields, F.lit(1)).cast("binary")).alias("digest"),
    )


PLACE = ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "q_duplicate_pairs",
    """WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_partkey
      ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
    SELECT l_orderkey, count(*) AS n, min(l_partkey) AS first_part FROM r WHERE rn > 1 GROUP BY 1""",
)
def duplicate_pairs(t) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", *PLACE)
    return (
        later_occurrences(rows, ["l_orderkey", "l_partkey"], PLACE)
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("first_part"))
    )


@query(
    "q_last_row_wins",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def last_row_wins(t) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    return last_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "q_param_row",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def param_row(t) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "q_authority_issues",
    """SELECT 'duplicate_name' AS code, p_name AS key, count(*) AS n FROM part GROUP BY 2 HAVING count(*) > 1
    UNION ALL
    SELECT 'duplicate_key', p_brand || '-' || p_size, count(*) FROM part GROUP BY 2 HAVING count(*) > 1""",
)
def authority_issues(t) -> DataFrame:
    def repeated(key, code):
        counted = t.part.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
        return counted.filter(F.col("n") > 1).select(F.lit(code).alias("code"), "key", "n")

    brand_size = F.concat_ws("-", "p_brand", F.col("p_size").cast("string"))
    return repeated(F.col("p_name"), "duplicate_name").unionByName(
        repeated(brand_size, "duplicate_key")
    )


@query(
    "q_required_keys",
    """SELECT o_orderkey, f AS missing_key FROM orders, (VALUES ('A'), ('N'), ('R')) v(f)
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = f)""",
)
def required_keys(t) -> DataFrame:
    keys = ("A", "N", "R")
    have = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.max(F.col("l_returnflag") == k).alias(k) for k in keys]
    )
    named = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.col(k), F.lit(False)), F.lit(k)) for k in keys])
    )
    return t.orders.select("o_orderkey").join(have, "o_orderkey", "left").select(
        "o_orderkey", F.explode(named).alias("missing_key")
    )


@query(
    "q_extract_ids",
    r"""WITH e AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
      regexp_extract_all(url, '\d+') AS l FROM pages)
    SELECT page_id, host, coalesce(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ','), '') AS ids FROM e""",
)
def extract_id_lists(t) -> DataFrame:
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.array_join(extract_ids(F.col("url"), r"\d+"), ",").alias("ids"),
    )


@query(
    "q_kv_text",
    """SELECT page_id, nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS species,
      regexp_extract(html, '<html lang="([^"]*)"', 1) AS accession FROM pages""",
)
def kv_text(t) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    lang = F.regexp_extract("html", '<html lang="([^"]*)"', 1)
    doc = F.concat(
        F.lit("Species: none\nSPECIES: "), title, F.lit("\nother: x\nAccession number: "), lang
    )
    return t.pages.select("page_id", doc.alias("doc")).select(
        "page_id",
        labelled_value(F.col("doc"), "species").alias("species"),
        labelled_value(F.col("doc"), "accession number").alias("accession"),
    )


@query(
    "q_json_tolerant",
    """WITH b AS (SELECT 'events' AS source, props AS body FROM events UNION ALL SELECT 'documents', text FROM documents),
    k AS (SELECT source, TRY_CAST(CASE WHEN json_valid(body) THEN json_extract_string(body, '$.k') END AS BIGINT) AS k FROM b)
    SELECT source, count(*) AS n, count(k) AS n_parsed, CAST(coalesce(sum(k), 0) AS BIGINT) AS total FROM k GROUP BY 1""",
)
def json_tolerant(t) -> DataFrame:
    bodies = t.events.select(F.lit("events").alias("source"), F.col("props").alias("body")).unionByName(
        t.documents.select(F.lit("documents").alias("source"), F.col("text").alias("body"))
    )
    k = nested(F.col("body"), "k").try_cast("bigint")
    return (
        bodies.select("source", k.alias("k"))
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("k").alias("n_parsed"),
            F.coalesce(F.sum("k"), F.lit(0)).alias("total"),
        )
    )


@query(
    "q_json_nested",
    """WITH e AS (SELECT user_id, props, unnest(json_keys(props)) AS key FROM events)
    SELECT user_id, key, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.' || key) AS BIGINT)) AS BIGINT) AS total
    FROM e GROUP BY 1, 2""",
)
def json_nested(t) -> DataFrame:
    entries = t.events.select("user_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "v"))
    return entries.groupBy("user_id", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


@query(
    "q_object_rollup",
    """SELECT source, lang, CAST(sum(n_chars) AS BIGINT) AS size, count(*) AS n,
      count(*) FILTER (WHERE n_chars = 0) AS n_empty FROM documents GROUP BY 1, 2""",
)
def object_rollup(t) -> DataFrame:
    return t.documents.groupBy("source", "lang").agg(
        F.sum("n_chars").alias("size"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("n_chars") == 0).alias("n_empty"),
    )


@query(
    "q_runinfo_clean",
    """SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, count(*) AS n FROM orders GROUP BY 1""",
)
def runinfo_clean(t) -> DataFrame:
    clean = blank_to_null(F.col("o_orderpriority"), ("", "4-NOT SPECIFIED"))
    return t.orders.groupBy(clean.alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_nullify_tokens",
    r"""SELECT CASE WHEN p_type NOT IN ('SMALL', 'PROMO') THEN p_type END AS kind, count(*) AS n,
      CAST(sum(TRY_CAST(regexp_extract(p_brand, '(\d+)$', 1) AS BIGINT)) AS BIGINT) AS brands FROM part GROUP BY 1""",
)
def nullify_tokens(t) -> DataFrame:
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).try_cast("bigint")
    return t.part.groupBy(blank_to_null(F.col("p_type"), ("SMALL", "PROMO")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(number).alias("brands")
    )


@query(
    "q_header_extract",
    """SELECT page_id, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset,
      regexp_extract(html, '<a href="([^"]*)"', 1) AS href,
      regexp_extract(regexp_extract(html, '<a href="([^"]*)"', 1), '([^/]*)$', 1) AS name FROM pages""",
)
def header_extract(t) -> DataFrame:
    href = F.regexp_extract("html", '<a href="([^"]*)"', 1)
    return t.pages.select(
        "page_id",
        F.regexp_extract("html", '<meta charset="([^"]*)"', 1).alias("charset"),
        href.alias("href"),
        F.substring_index(href, "/", -1).alias("name"),
    )


@query(
    "q_tag_maps",
    r"""WITH q AS (SELECT page_id, string_split(regexp_extract(url, '\?([^#]*)', 1), '&') AS l FROM pages),
    p AS (SELECT page_id, unnest(l) AS pair, generate_subscripts(l, 1) AS i FROM q),
    kv AS (SELECT page_id, split_part(pair, '=', 1) AS key,
      CASE WHEN contains(pair, '=') THEN substr(pair, strpos(pair, '=') + 1) ELSE '' END AS value, i FROM p)
    SELECT page_id, key, arg_max(value, i) AS value FROM kv WHERE key <> '' GROUP BY 1, 2""",
)
def tag_maps(t) -> DataFrame:
    asked = F.regexp_extract("url", r"\?([^#]*)", 1)
    # The query string takes the shape of a header record: tab-separated KEY:value fields.
    pairs = F.transform(F.split(asked, "&"), lambda p: F.regexp_replace(p, "^([^=]*)=", "$1:"))
    line = F.concat_ws("\t", F.lit("@URL"), F.array_join(pairs, "\t"))
    records = tag_records(t.pages.select("page_id", F.lit(1).alias("line"), line.alias("value")), ["page_id"])
    return records.select("page_id", F.explode("fields").alias("key", "value"))


@query(
    "q_topn_per_key",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank FROM (SELECT *, row_number() OVER
      (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_quantity) AS rank
      FROM lineitem) WHERE rank <= 5""",
)
def topn_per_key(t) -> DataFrame:
    cols = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    top = first_n(t.lineitem.select(*cols), ["l_suppkey"], order, 5).drop("l_quantity")
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "q_reference_line",
    """SELECT c_custkey, c_name || ' (' || n_name || ') ' || c_mktsegment || '.' AS line
    FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def reference_lines(t) -> DataFrame:
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    line = reference_line(F.col("c_name"), F.col("n_name"), F.lit(""), F.col("c_mktsegment"))
    return t.customer.join(nation, "c_nationkey").select("c_custkey", line.alias("line"))


@query(
    "q_segment_blocks",
    """WITH b AS (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER
      (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS block FROM conversations)
    SELECT conv_id, coalesce(block, -1) AS block, count(*) AS n, count(*) FILTER (WHERE role <> 'user') AS n_other,
      max(turn) AS last_turn FROM b GROUP BY 1, 2""",
)
def segment_blocks(t) -> DataFrame:
    rows = t.conversations.select("conv_id", "turn", "role")
    return (
        segment_by_marker(rows, ["conv_id"], "turn", F.col("role") == "user")
        .groupBy("conv_id", F.coalesce("block", F.lit(-1)).alias("block"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("role") != "user").alias("n_other"),
            F.max("turn").alias("last_turn"),
        )
    )


@query(
    "q_unpivot_metrics",
    """SELECT l_returnflag, 'quantity' AS metric, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) * 100 AS BIGINT) AS total
      FROM lineitem WHERE l_quantity = floor(l_quantity) GROUP BY 1
    UNION ALL SELECT l_returnflag, 'discount', count(*), CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) FROM lineitem GROUP BY 1
    UNION ALL SELECT l_returnflag, 'tax', count(*), CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) FROM lineitem GROUP BY 1""",
)
def unpivot_metrics(t) -> DataFrame:
    mapping = {
        "l_quantity": ("quantity", "bigint"),
        "l_discount": ("discount", "double"),
        "l_tax": ("tax", "double"),
    }
    long = long_metrics(t.lineitem, ["l_returnflag"], mapping)
    return long.groupBy("l_returnflag", "metric").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("total")
    )


# After all orders: the second state of the table covers the whole of it.
FUTURE = "2100-01-01"


def _customer_totals(t, until: str) -> DataFrame:
    return (
        t.orders.filter(since("o_orderdate", "1900-01-01", until))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(cents("o_totalprice")).alias("total"),
            F.lit(until).alias("stamp"),
        )
    )


_TOTALS_SQL = f"""SELECT o_custkey AS c_custkey, count(*) AS n_orders,
  CAST(sum({cents_sql('o_totalprice')}) AS BIGINT) AS total, '%s' AS stamp FROM orders
  WHERE o_orderdate < TIMESTAMP '%s' GROUP BY 1"""
_UPSERT_SQL = """WITH o AS (""" + _TOTALS_SQL % ("1996-01-01", "1996-01-01") + """),
n AS (SELECT * FROM (""" + _TOTALS_SQL % (FUTURE, FUTURE) + """) %s),
p AS (SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NULL THEN 'kept'
  WHEN o.c_custkey IS NULL THEN 'new' WHEN o.n_orders = n.n_orders AND o.total = n.total THEN 'unchanged' ELSE 'changed' END AS outcome,
  o.n_orders AS on_, n.n_orders AS nn, o.total AS ot, n.total AS nt, o.stamp AS os, n.stamp AS ns
  FROM o FULL JOIN n ON o.c_custkey = n.c_custkey)
SELECT c_custkey, outcome, CASE WHEN outcome IN ('new', 'changed') THEN nn ELSE on_ END AS n_orders,
  CASE WHEN outcome IN ('new', 'changed') THEN nt ELSE ot END AS total,
  CASE WHEN outcome IN ('new', 'changed') THEN ns ELSE os END AS stamp FROM p"""


@query("q_upsert_changed_only", _UPSERT_SQL % "")
def upsert_changed_only(t) -> DataFrame:
    old, new = _customer_totals(t, "1996-01-01"), _customer_totals(t, FUTURE)
    return change_only(old, new, ["c_custkey"], ["stamp"])


@query(
    "q_upsert_skip_failed",
    _UPSERT_SQL % "WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def upsert_skip_failed(t) -> DataFrame:
    old, new = _customer_totals(t, "1996-01-01"), _customer_totals(t, FUTURE)
    failed = t.customer.filter("c_acctbal < 0")
    return change_only(old, without_failed(new, failed, ["c_custkey"]), ["c_custkey"], ["stamp"])


@query(
    "q_severity_counts",
    f"""WITH f AS (SELECT {SEVERITY_SQL} AS severity FROM events),
    v AS (SELECT * FROM (VALUES ('error', 0), ('warn', 1), ('info', 2), ('skipped', 3)) x(severity, rank))
    SELECT v.severity, v.rank, count(f.severity) AS n,
      CASE WHEN (SELECT count(*) FROM f WHERE severity = 'error') > 0 THEN 1 ELSE 0 END AS exit_code,
      CASE WHEN (SELECT count(*) FROM f WHERE severity IN ('error', 'warn')) > 0 THEN 1 ELSE 0 END AS strict_exit
    FROM v LEFT JOIN f ON f.severity = v.severity GROUP BY 1, 2""",
)
def severity_counts(t) -> DataFrame:
    counts = counts_with_zeros(t.events.select(severity_of().alias("severity")), "severity", SEVERITIES)
    # Four rows, one per severity.
    all_rows = W.partitionBy(F.lit(1))
    worst = lambda *s: flag(F.max(F.when(F.col("severity").isin(*s), F.col("n"))).over(all_rows) > 0)
    return counts.withColumn("exit_code", worst("error")).withColumn("strict_exit", worst("error", "warn"))


@query(
    "q_csv_projection",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, '' AS s_phone,
      CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier""",
)
def csv_projection(t) -> DataFrame:
    return projected(t.supplier, ["s_suppkey", "s_name", "s_phone", "s_nationkey"])


@query(
    "q_id_predicates",
    r"""SELECT 'customer' AS kind, count(*) AS n, count(*) FILTER (WHERE regexp_matches(c_name, '^Customer#\d{9}$')) AS n_match FROM customer
    UNION ALL SELECT 'brand', count(*), count(*) FILTER (WHERE regexp_matches(p_brand, '^Brand#\d$')) FROM part
    UNION ALL SELECT 'supplier', count(*), count(*) FILTER (WHERE regexp_matches(s_name, '^Supplier#0+1\d*$')) FROM supplier""",
)
def id_predicates(t) -> DataFrame:
    def matching(df, kind, column, pattern):
        return df.agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).rlike(pattern)).alias("n_match")
        ).select(F.lit(kind).alias("kind"), "n", "n_match")

    parts = [
        matching(t.customer, "customer", "c_name", r"^Customer#\d{9}$"),
        matching(t.part, "brand", "p_brand", r"^Brand#\d$"),
        matching(t.supplier, "supplier", "s_name", r"^Supplier#0+1\d*$"),
    ]
    return reduce(DataFrame.unionByName, parts)


def accession_of(key: str, prefix):
    return F.concat(prefix, F.lpad(F.col(key).cast("string"), 9, "0"), F.lit(".1"))


@query(
    "q_counterpart",
    """WITH a AS (SELECT l_returnflag, CASE l_returnflag WHEN 'A' THEN 'GCA_' WHEN 'R' THEN 'GCF_' ELSE 'XXX_' END
        || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '.1' AS acc,
        'GCA_' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '.1' AS canonical FROM lineitem),
    f AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 'GCF_' || substr(acc, 5) WHEN 'R' THEN 'GCA_' || substr(acc, 5) END AS other FROM a)
    SELECT l_returnflag, count(*) AS n, count(other) AS n_flipped, min(other) AS first_other,
      count(*) FILTER (WHERE l_returnflag IN ('A', 'R') AND (canonical = acc OR canonical = other)) AS n_same FROM f GROUP BY 1""",
)
def counterparts(t) -> DataFrame:
    rf = F.col("l_returnflag")
    prefix = F.when(rf == "A", "GCA_").when(rf == "R", "GCF_").otherwise("XXX_")
    rows = t.lineitem.select(
        "l_returnflag",
        accession_of("l_partkey", prefix).alias("acc"),
        accession_of("l_partkey", F.lit("GCA_")).alias("canonical"),
    )
    other = counterpart(F.col("acc"))
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(other).alias("n_flipped"),
        F.min(other).alias("first_other"),
        F.count_if(same_assembly(F.col("acc"), F.col("canonical"))).alias("n_same"),
    )


@query(
    "q_issue_to_finding",
    """WITH c AS (SELECT * FROM (VALUES ('AF', 'R010'), ('AO', 'R011'), ('RF', 'R012'), ('RO', 'R014')) x(code, id))
    SELECT id, 'error' AS severity, count(*) AS n, min(l_orderkey) AS first_order
    FROM lineitem JOIN c ON c.code = l_returnflag || l_linestatus GROUP BY 1""",
)
def issue_to_finding(t) -> DataFrame:
    codes = {"AF": "R010", "AO": "R011", "RF": "R012", "RO": "R014"}
    issues = t.lineitem.select(
        F.col("l_orderkey").alias("subject"),
        F.concat("l_returnflag", "l_linestatus").alias("code"),
        F.lit("line item").alias("message"),
        F.lit(None).cast("string").alias("path"),
        F.col("l_linenumber").alias("line"),
    )
    return (
        issues_to_findings(issues, codes)
        .groupBy("id", "severity")
        .agg(F.count(F.lit(1)).alias("n"), F.min("subject").alias("first_order"))
    )


def part_findings(t) -> DataFrame:
    """Four predicates read as checks over parts and line items."""
    parts = t.part.select(F.col("p_partkey").alias("subject"), "p_name", "p_size", "p_retailprice")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("subject"), "l_linenumber", "l_quantity", "l_discount"
    )
    found = [
        finding(parts.filter("p_size > 45"), "Z001", "error", text("size ", F.col("p_size"))),
        finding(parts.filter(F.col("p_name").startswith("red")), "Z002", "warn", text(F.col("p_name"))),
        finding(lines.filter("l_discount = 0.1"), "Z003", "info", text("discount"), line=F.col("l_linenumber")),
        finding(lines.filter("l_quantity = 50"), "Z004", "warn", text("quantity"), line=F.col("l_linenumber")),
    ]
    return reduce(DataFrame.unionByName, found)


PART_FINDINGS_SQL = """SELECT 'Z001' AS id, 'error' AS severity, p_partkey AS subject FROM part WHERE p_size > 45
  UNION ALL SELECT 'Z002', 'warn', p_partkey FROM part WHERE starts_with(p_name, 'red')
  UNION ALL SELECT 'Z003', 'info', l_orderkey FROM lineitem WHERE l_discount = 0.1
  UNION ALL SELECT 'Z004', 'warn', l_orderkey FROM lineitem WHERE l_quantity = 50"""


@query(
    "q_check_predicates",
    f"""SELECT id, severity, count(*) AS n, min(subject) AS first_subject, max(subject) AS last_subject
    FROM ({PART_FINDINGS_SQL}) GROUP BY 1, 2""",
)
def check_predicates(t) -> DataFrame:
    return part_findings(t).groupBy("id", "severity").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("subject").alias("first_subject"),
        F.max("subject").alias("last_subject"),
    )


@query(
    "q_distinct_offenders",
    f"""SELECT c_nationkey, count(*) AS n, {described_sql('c_name')} AS names
    FROM (SELECT DISTINCT c_nationkey, c_name FROM customer WHERE c_acctbal < 0) GROUP BY 1""",
)
def distinct_offenders(t) -> DataFrame:
    odd = described(t.customer.filter("c_acctbal < 0"), ["c_nationkey"], "c_name")
    return odd.select("c_nationkey", "n", describe(F.col("head"), F.col("n")).alias("names"))


@query(
    "q_missing_required",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def missing_required(t) -> DataFrame:
    have = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return missing_from(t.orders.select("o_orderkey"), have, ["o_orderkey"])


@query(
    "q_missing_companion",
    f"""SELECT user_id, {DAY_SQL} AS day FROM events GROUP BY 1, 2
    HAVING bool_or(event_type = 'view') AND NOT bool_or(event_type IN ('click', 'purchase'))""",
)
def missing_companion(t) -> DataFrame:
    days = user_days(t.events).select("user_id", "day", "event_type")
    items = days.filter("event_type = 'view'").select("user_id", "day").distinct()
    companions = days.filter(F.col("event_type").isin("click", "purchase"))
    return without_companion(items, companions, ["user_id", "day"])


@query(
    "q_zero_size",
    """SELECT l_orderkey, count(*) AS n, min(l_partkey) AS first_part FROM lineitem WHERE l_discount = 0 AND l_tax = 0 GROUP BY 1""",
)
def zero_size(t) -> DataFrame:
    return t.lineitem.filter("l_discount = 0 AND l_tax = 0").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("first_part")
    )


@query(
    "q_select_by_prefix",
    """SELECT event_type, count(*) AS n FROM events WHERE (starts_with(event_type, 'p') OR starts_with(event_type, 'c')
      OR starts_with(event_type, 'v')) AND NOT starts_with(event_type, 'cl') GROUP BY 1""",
)
def select_by_prefix(t) -> DataFrame:
    only, skip = prefixes(["p", " c", "v", ""]), prefixes(["cl", " "])
    begins = lambda ps: reduce(lambda a, b: a | b, [F.col("event_type").startswith(p) for p in ps])
    return t.events.filter(begins(only) & ~begins(skip)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_skipped_checks",
    f"""WITH a AS (SELECT {SUBJECT_SQL} AS subject, list(DISTINCT event_type) AS have FROM events GROUP BY 1),
    c AS (SELECT * FROM (VALUES ('C1', ['error']), ('C2', ['purchase', 'signup']), ('C3', ['view', 'click'])) x(id, needs)),
    m AS (SELECT id, subject, list_filter(needs, lambda n: NOT list_contains(have, n)) AS missing FROM a, c)
    SELECT id, subject, 'skipped' AS severity, 'needs ' || array_to_string(missing, ', ') AS detail FROM m WHERE len(missing) > 0""",
)
def skipped_checks(t) -> DataFrame:
    needs = {"C1": ("error",), "C2": ("purchase", "signup"), "C3": ("view", "click")}
    checks = [Check(k, "C", "error", k, v, None) for k, v in needs.items()]
    # At most one entry per event type.
    available = user_days(t.events).groupBy("subject").agg(F.collect_set("event_type").alias("have"))
    return skipped(available, checks).select("id", "subject", "severity", "detail")


@query(
    "q_content_digest",
    "SELECT doc_id, 'sha256:' || sha256(text) AS digest FROM documents",
)
def content_digest(t) -> DataFrame:
    return t.documents.select("doc_id", sha256_tag(F.col("text")).alias("digest"))


_SLUG_SQL = "trim(regexp_replace(regexp_replace(lower(%s), '[’''.]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-')"


@query(
    "q_slugify",
    f"""WITH s AS (SELECT 'part' AS kind, p_partkey AS key, {_SLUG_SQL % 'p_name'} AS slug FROM part
    UNION ALL SELECT 'document', doc_id, {_SLUG_SQL % 'text'} FROM documents)
    SELECT kind, key, md5(slug) AS slug_md5, array_to_string(list_slice(string_split(slug, '-'), 1, 2), '-') AS binomial FROM s""",
)
def slugs(t) -> DataFrame:
    def named(df, kind, key, column):
        return df.select(
            F.lit(kind).alias("kind"),
            F.col(key).alias("key"),
            F.md5(slugify(F.col(column))).alias("slug_md5"),
            binomial_slug(F.col(column)).alias("binomial"),
        )

    return named(t.part, "part", "p_partkey", "p_name").unionByName(
        named(t.documents, "document", "doc_id", "text")
    )


LABELS = (
    ("year", r"\b(19|20)\d\d\b"),
    ("link", r"https?://"),
    ("mail", r"[A-Za-z0-9._]+@[A-Za-z0-9]+\."),
    ("accent", r"[éèêçñüß]"),
    ("license", r"(?i)license|copyright"),
    ("capital", r"^[A-Z]"),
    ("question", r"\?"),
    ("capital", r"^\s*[A-Z]{2}"),
)


@query(
    "q_pattern_classify",
    "WITH h AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label FROM documents WHERE regexp_matches(text, '{pattern}')"
        for label, pattern in LABELS
    )
    + ") SELECT label, count(DISTINCT doc_id) AS n FROM h GROUP BY 1",
)
def pattern_classify(t) -> DataFrame:
    hits = classify_lines(t.documents.select("doc_id", "text"), ["doc_id"], LABELS, "text")
    return hits.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_two_sided_text",
    """WITH p AS (SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
        CASE WHEN d.doc_id IS NOT NULL THEN CASE WHEN n_chars > 1000 THEN '1' ELSE '0' END END AS a,
        CAST(quality AS VARCHAR) AS b FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id)
    SELECT CASE WHEN b IS NULL THEN 'left only' WHEN a IS NULL THEN 'right only' WHEN a = b THEN 'same' ELSE 'differ' END AS side,
      count(*) AS n, min(doc_id) AS first_doc FROM p GROUP BY 1""",
)
def two_sided_text(t) -> DataFrame:
    # Trailing blanks and line-end style do not count as a difference.
    guess = F.when(F.col("n_chars") > 1000, "1 \r\n").otherwise("0")
    left = t.documents.select("doc_id", normalized_document(guess).alias("a"))
    right = t.labels.select("doc_id", F.col("quality").cast("string").alias("b"))
    return two_sided(left, right, ["doc_id"], "a", "b").groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")
    )
