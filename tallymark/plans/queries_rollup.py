"""Queries on aggregation, ranking and publication status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.values import PUBLICATION_STATES, SEVERITIES, nested, severity_rank
from tallymark.operators.gates import codes_present
from tallymark.operators.ranking import milestones, numbered, stable_sample
from tallymark.operators.records import severity_tallies
from tallymark.operators.records import skip_reasons as reasons_of
from tallymark.operators.rollup import optional_coverage as coverage_of
from tallymark.operators.curation import ranked_queue
from tallymark.operators.rollup import (
    constant_column,
    counts_disagree,
    counts_with_zeros,
    extremes,
    histogram,
    input_mix,
    long_metrics,
    merge_metrics,
    missing_share,
    project_weights,
    publication_status,
    quantiles,
    set_fingerprint,
)
from tallymark.plans.driver import (
    DAY_SQL,
    SEVERITY_SQL,
    cents,
    cents_sql,
    flag,
    joined,
    query,
    severity_of,
)

# -- publication status -----------------------------------------------------

REQUIRED = ("has_a", "has_n", "has_r", "has_f", "has_o")


def order_flags(t) -> DataFrame:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.max(rf == k).alias(f"has_{k.lower()}") for k in ("A", "N", "R")],
        *[F.max(ls == k).alias(f"has_{k.lower()}") for k in ("F", "O")],
        F.max(F.col("l_tax") == 0).alias("tax_free"),
        F.lit(True).alias("listed"),
    )
    return t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority").join(lines, "o_orderkey", "left")


def order_status(t) -> DataFrame:
    return publication_status(order_flags(t), ["o_orderkey"], REQUIRED, ("tax_free",), F.col("listed"))


_STATUS_SQL = """WITH l AS (SELECT l_orderkey, bool_or(l_returnflag = 'A') AS has_a, bool_or(l_returnflag = 'N') AS has_n,
    bool_or(l_returnflag = 'R') AS has_r, bool_or(l_linestatus = 'F') AS has_f, bool_or(l_linestatus = 'O') AS has_o,
    bool_or(l_tax = 0) AS tax_free FROM lineitem GROUP BY 1),
  m AS (SELECT o_orderkey, l_orderkey IS NOT NULL AS listed, tax_free, list_filter([CASE WHEN has_a THEN '' ELSE 'has_a' END, CASE WHEN has_n THEN '' ELSE 'has_n' END,
    CASE WHEN has_r THEN '' ELSE 'has_r' END, CASE WHEN has_f THEN '' ELSE 'has_f' END, CASE WHEN has_o THEN '' ELSE 'has_o' END], lambda x: x <> '') AS missing
    FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
  s AS (SELECT o_orderkey, CASE WHEN NOT listed THEN 'absent' WHEN len(missing) = 0 THEN 'complete' ELSE 'partial' END AS state,
    coalesce(array_to_string(missing, ','), '') AS missing, CASE WHEN listed AND NOT tax_free THEN 'tax_free' ELSE '' END AS missing_optional, coalesce(tax_free, FALSE) AS tax_free FROM m)"""


@query("q_status_model", _STATUS_SQL + " SELECT o_orderkey, state, missing, missing_optional FROM s")
def status_model(t) -> DataFrame:
    return order_status(t).select(
        "o_orderkey", "state", joined("missing").alias("missing"), joined("missing_optional").alias("missing_optional")
    )


@query(
    "q_status_counts",
    _STATUS_SQL
    + """ SELECT v.state, v.rank, count(s.state) AS n FROM (VALUES ('absent', 0), ('partial', 1), ('complete', 2)) v(state, rank)
    LEFT JOIN s ON s.state = v.state GROUP BY 1, 2""",
)
def status_counts(t) -> DataFrame:
    return counts_with_zeros(order_status(t), "state", PUBLICATION_STATES)


@query(
    "q_optional_coverage",
    _STATUS_SQL
    + " SELECT 'tax_free' AS artifact, count(*) FILTER (WHERE tax_free) AS n, count(*) AS n_published FROM s WHERE state <> 'absent'",
)
def optional_coverage(t) -> DataFrame:
    return coverage_of(order_status(t), ("tax_free",))


@query(
    "q_skip_reasons",
    """SELECT coalesce(json_extract_string(props, '$.k'), 'unavailable') AS reason, count(*) AS n
    FROM events WHERE event_type = 'view' GROUP BY 1""",
)
def skip_reasons(t) -> DataFrame:
    found = t.events.select(severity_of().alias("severity"), nested(F.col("props"), "k").alias("detail"))
    return reasons_of(found, [])


@query(
    "q_corpus_table",
    f"""WITH f AS (SELECT user_id, ts, {SEVERITY_SQL} AS severity FROM events)
    SELECT user_id, count(*) FILTER (WHERE severity = 'error') AS n_error, count(*) FILTER (WHERE severity = 'warn') AS n_warn,
      count(*) FILTER (WHERE severity = 'info') AS n_info, count(*) FILTER (WHERE severity = 'skipped') AS n_skipped,
      strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest FROM f GROUP BY 1""",
)
def corpus_table(t) -> DataFrame:
    found = t.events.select("user_id", "ts", severity_of().alias("severity"))
    latest = found.groupBy("user_id").agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("latest"))
    return severity_tallies(found, "user_id").join(latest, "user_id")


# -- fingerprints and shares ------------------------------------------------


# A digest of part digests, as the operator defines it.
FINGERPRINT_SQL = """SELECT %(k)s, CAST(sum(n) AS BIGINT) AS count, 'sha256:' || sha256(string_agg(part || ':sha256:' || d, chr(10) ORDER BY part)) AS digest
    FROM (SELECT %(k)s, part, sum(n) AS n, sha256(string_agg(item || chr(9) || n, chr(10) ORDER BY item || chr(9) || n)) AS d
      FROM (SELECT %(k)s, item, substr(sha256(item), 1, 4) AS part, count(*) AS n
        FROM (SELECT %(k)s, l_partkey || ':' || CAST(l_quantity AS BIGINT) AS item FROM lineitem) GROUP BY ALL) GROUP BY ALL) GROUP BY ALL"""


@query(
    "q_set_fingerprint",
    FINGERPRINT_SQL % {"k": "l_orderkey"},
)
def fingerprints(t) -> DataFrame:
    item = F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"))
    return set_fingerprint(t.lineitem.select("l_orderkey", item.alias("item")), ["l_orderkey"], "item")


@query(
    "q_data_staleness",
    f"""WITH d AS ({FINGERPRINT_SQL % {'k': 'l_orderkey, l_linestatus'}})
    SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, CAST(a.digest IS DISTINCT FROM b.digest AS INT) AS stale
    FROM (SELECT * FROM d WHERE l_linestatus = 'F') a FULL JOIN (SELECT * FROM d WHERE l_linestatus = 'O') b ON a.l_orderkey = b.l_orderkey""",
)
def data_staleness(t) -> DataFrame:
    item = F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"))
    rows = t.lineitem.select("l_orderkey", "l_linestatus", item.alias("item"))
    # One pass for both sides: the status is part of the fingerprinted subject.
    both = set_fingerprint(rows, ["l_orderkey", "l_linestatus"], "item")
    sides = both.groupBy("l_orderkey").agg(
        *[F.max(F.when(F.col("l_linestatus") == s, F.col("digest"))).alias(s) for s in ("F", "O")]
    )
    return sides.select("l_orderkey", flag(~F.col("F").eqNullSafe(F.col("O"))).alias("stale"))


@query(
    "q_weighted_missing",
    f"""WITH w AS (SELECT o_orderpriority, o_orderkey, {cents_sql('o_totalprice')} AS w, o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AS gone FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, gone ORDER BY w DESC, o_orderkey) AS rn FROM w)
    SELECT o_orderpriority, count(*) FILTER (WHERE gone) AS n_missing, CAST(sum(w) FILTER (WHERE gone) AS BIGINT) AS missing_weight,
      round(CAST(sum(w) FILTER (WHERE gone) AS DOUBLE) / CAST(sum(w) AS DOUBLE) * 100, 6) AS percent,
      CASE WHEN CAST(sum(w) FILTER (WHERE gone) AS DOUBLE) / CAST(sum(w) AS DOUBLE) * 100 > 1.7 THEN 'warn' ELSE 'info' END AS severity,
      string_agg(o_orderkey, ',' ORDER BY rn) FILTER (WHERE gone AND rn <= 3) AS largest
    FROM r GROUP BY 1 HAVING count(*) FILTER (WHERE gone) > 0""",
)
def weighted_missing(t) -> DataFrame:
    wanted = t.orders.select("o_orderpriority", "o_orderkey", cents("o_totalprice").alias("w"))
    have = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    present = wanted.join(have, "o_orderkey", "left_semi")
    gone = missing_share(wanted, present, ["o_orderpriority"], "o_orderkey", "w", threshold=1.7)
    return gone.select(
        "o_orderpriority", "n_missing", "missing_weight", F.round("percent", 6).alias("percent"), "severity",
        F.array_join(F.transform("largest", lambda e: e["key"].cast("string")), ",").alias("largest"),
    )


@query(
    "q_constant_column",
    """SELECT p_brand, p_size, count(DISTINCT p_type) AS n_values, CASE WHEN count(DISTINCT p_type) = 1 THEN min(p_type) END AS value
    FROM part GROUP BY 1, 2""",
)
def constants(t) -> DataFrame:
    return constant_column(t.part, ["p_brand", "p_size"], "p_type")


# -- distributions ----------------------------------------------------------


@query(
    "q_quantiles",
    """SELECT c_mktsegment, count(*) AS n, round(min(o_totalprice), 4) AS q0, round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
      round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75, round(max(o_totalprice), 4) AS q100
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""",
)
def price_quantiles(t) -> DataFrame:
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    priced = t.orders.select("o_custkey", "o_totalprice").join(segments, "o_custkey")
    out = quantiles(priced, ["c_mktsegment"], "o_totalprice")
    return out.select("c_mktsegment", "n", *[F.round(q, 4).alias(q) for q in ("q0", "q25", "q50", "q75", "q100")])


_LADDER_SQL = """WITH v AS (SELECT p_brand, CASE WHEN l_quantity >= 100 THEN 8 WHEN l_quantity >= 60 THEN 7 WHEN l_quantity >= 40 THEN 6 WHEN l_quantity >= 30 THEN 5
      WHEN l_quantity >= 20 THEN 4 WHEN l_quantity >= 15 THEN 3 WHEN l_quantity >= 10 THEN 2 WHEN l_quantity >= 5 THEN 1 WHEN l_quantity >= 0 THEN 0 END AS bucket
      FROM lineitem JOIN part ON p_partkey = l_partkey),
  c AS (SELECT p_brand, bucket, count(*) AS n FROM v GROUP BY 1, 2),
  e AS (SELECT p_brand, min(bucket) AS lo, max(bucket) AS hi, max(n) AS peak FROM c GROUP BY 1),
  g AS (SELECT p_brand, unnest(range(lo, hi + 1)) AS bucket, peak FROM e)
  SELECT g.p_brand, CAST(g.bucket AS INT) AS bucket, [0, 5, 10, 15, 20, 30, 40, 60, 100][g.bucket + 1]::DOUBLE AS low, coalesce(n, 0) AS n,
    CASE WHEN coalesce(n, 0) > 0 THEN greatest(1, CAST(round_even(30.0 * n / peak, 0) AS INT)) ELSE 0 END AS bar
  FROM g LEFT JOIN c ON c.p_brand = g.p_brand AND c.bucket = g.bucket"""


@query("q_histogram_ladder", _LADDER_SQL)
def quantity_histogram(t) -> DataFrame:
    # Counted per part and quantity first, so a part with very many lines joins as a few rows.
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    counted = t.lineitem.groupBy("l_partkey", "l_quantity").agg(F.count(F.lit(1)).alias("_k"))
    return histogram(counted.join(brands, "l_partkey"), ["p_brand"], "l_quantity", weight=F.col("_k"))


@query(
    "q_argminmax",
    """SELECT p_brand, min(p_retailprice) AS low, min(p_partkey) FILTER (WHERE p_retailprice = lo) AS low_name,
      max(p_retailprice) AS high, min(p_partkey) FILTER (WHERE p_retailprice = hi) AS high_name
    FROM (SELECT *, min(p_retailprice) OVER (PARTITION BY p_brand) AS lo, max(p_retailprice) OVER (PARTITION BY p_brand) AS hi FROM part) GROUP BY 1""",
)
def arg_extremes(t) -> DataFrame:
    return extremes(t.part, ["p_brand"], "p_partkey", "p_retailprice")


@query(
    "q_input_mix",
    """WITH o AS (SELECT l_orderkey, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_keys FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_returnflag, count(*) AS n, any_value(n_rows) AS n_rows, any_value(n_keys) AS n_keys
    FROM lineitem JOIN o USING (l_orderkey) GROUP BY 1, 2""",
)
def flag_mix(t) -> DataFrame:
    return input_mix(t.lineitem.select("l_orderkey", "l_returnflag", "l_partkey"), ["l_orderkey"], "l_returnflag", "l_partkey")


@query(
    "q_count_disagreement",
    """SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers
    FROM lineitem GROUP BY 1 HAVING NOT (count(*) = count(DISTINCT l_partkey) AND count(*) = count(DISTINCT l_suppkey))""",
)
def count_disagreement(t) -> DataFrame:
    counts = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("l_partkey").alias("n_parts"),
        F.count_distinct("l_suppkey").alias("n_suppliers"),
    )
    return counts_disagree(counts, ["n_lines", "n_parts", "n_suppliers"])


# -- weights, metrics, ranks ------------------------------------------------


@query(
    "q_project_weights",
    """WITH a AS (SELECT DISTINCT p_brand, l_orderkey, l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey),
    s AS (SELECT p_brand, l_orderkey FROM a UNION SELECT p_brand, -1 FROM part)
    SELECT s.p_brand, (SELECT count(*) FROM a WHERE a.p_brand = s.p_brand) AS weight, count(*) AS n_subjects FROM s GROUP BY 1""",
)
def brand_weights(t) -> DataFrame:
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    attributed = t.lineitem.select("l_orderkey", "l_partkey").join(brands, "l_partkey")
    declared = t.part.select("p_brand", F.lit(-1).cast("bigint").alias("l_orderkey")).distinct()
    return project_weights(attributed, declared, "p_brand", "l_orderkey", "l_partkey", t.lineitem.count())


@query(
    "q_merge_metrics",
    """WITH l AS (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS total_quantity, max(l_extendedprice) AS top_price FROM lineitem GROUP BY 1),
    r AS (SELECT l_suppkey, CAST(count(*) AS DOUBLE) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT s_suppkey, total_quantity, top_price, n_returned, s_acctbal AS balance FROM supplier LEFT JOIN l ON l.l_suppkey = s_suppkey
    LEFT JOIN r ON r.l_suppkey = s_suppkey""",
)
def merged_metrics(t) -> DataFrame:
    lines = t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey")
    totals = lines.groupBy("s_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty"), F.max("l_extendedprice").alias("price"))
    returned = lines.filter("l_returnflag = 'R'").groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n"))
    keys = ["s_suppkey"]
    tables = [
        long_metrics(totals, keys, {"qty": ("total_quantity", "bigint"), "price": ("top_price", "double")}),
        long_metrics(returned, keys, {"n": ("n_returned", "bigint")}),
        long_metrics(t.supplier, keys, {"s_acctbal": ("balance", "double")}),
    ]
    return merge_metrics(tables, keys, ["total_quantity", "top_price", "n_returned", "balance"])


@query(
    "q_milestones",
    """WITH r AS (SELECT row_number() OVER w AS rank, sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS running,
      (SELECT sum(n_chars) FROM documents) AS total FROM documents WINDOW w AS (ORDER BY n_chars DESC, doc_id))
    SELECT target, min(rank) AS items FROM r, (VALUES (50), (75), (90)) v(target) WHERE running * 100 >= total * target GROUP BY 1""",
)
def weight_milestones(t) -> DataFrame:
    return milestones(t.documents, "n_chars")


@query(
    "q_stable_sample",
    """WITH f AS (SELECT c_nationkey, c_name, md5('0:' || c_nationkey || ':' || c_name) AS h,
      row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS rn FROM customer),
    d AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, rn = 1 ORDER BY h, c_name) AS draw FROM f)
    SELECT c_nationkey, c_name, CAST(rn = 1 AS INT) AS is_first FROM d WHERE rn = 1 OR draw <= 2""",
)
def sampled(t) -> DataFrame:
    return stable_sample(t.customer, ["c_nationkey"], "c_name", 3, "0")


@query(
    "q_findings_ranked",
    f"""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY
      CASE {SEVERITY_SQL} WHEN 'error' THEN 0 WHEN 'warn' THEN 1 WHEN 'info' THEN 2 ELSE 3 END, event_id) AS seq
    FROM events""",
)
def findings_ranked(t) -> DataFrame:
    found = t.events.select("user_id", "event_id", F.coalesce(severity_rank(severity_of()), F.lit(3)).alias("_rank"))
    cut = [F.col("_rank"), F.floor(F.col("event_id") / 65536)]
    return numbered(found, ["user_id"], cut, ["_rank", "event_id"]).select("user_id", "event_id", "seq")


@query(
    "q_rank_queue",
    """SELECT bioproject, weight, n_subjects, row_number() OVER (ORDER BY weight DESC, n_subjects DESC, bioproject) AS place FROM
    (SELECT p_brand || '/' || p_type AS bioproject, count(*) AS weight, count(DISTINCT p_size) AS n_subjects FROM part GROUP BY 1)
    ORDER BY place LIMIT 15""",
)
def queue_head(t) -> DataFrame:
    projects = t.part.groupBy(F.concat_ws("/", "p_brand", "p_type").alias("bioproject")).agg(
        F.count(F.lit(1)).alias("weight"), F.count_distinct("p_size").alias("n_subjects")
    )
    # The report shows the first fifteen; only those are numbered.
    top = ranked_queue(projects, limit=15)
    place = W.partitionBy(F.lit(1)).orderBy(F.desc("weight"), F.desc("n_subjects"), "bioproject")
    return top.withColumn("place", F.row_number().over(place).cast("bigint"))


@query(
    "q_rank_queue_all",
    """SELECT bioproject, weight, n_subjects, row_number() OVER (ORDER BY weight DESC, n_subjects DESC, bioproject) AS place FROM
    (SELECT p_brand || '/' || p_type AS bioproject, count(*) AS weight, count(DISTINCT p_size) AS n_subjects FROM part GROUP BY 1)""",
)
def whole_queue(t) -> DataFrame:
    """Every project's place: numbered within its weight, after all that are heavier."""
    projects = t.part.groupBy(F.concat_ws("/", "p_brand", "p_type").alias("bioproject")).agg(
        F.count(F.lit(1)).alias("weight"), F.count_distinct("p_size").alias("n_subjects")
    )
    # One row for each weight that occurs.
    heavier = projects.groupBy("weight").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(W.orderBy(F.desc("weight")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    same = W.partitionBy("weight").orderBy(F.desc("n_subjects"), "bioproject")
    placed = projects.withColumn("_place", F.row_number().over(same)).join(heavier, "weight")
    return placed.select("bioproject", "weight", "n_subjects", (F.col("_before") + F.col("_place")).alias("place"))


# -- facts worth showing ----------------------------------------------------


@query(
    "q_gate_blockers",
    _STATUS_SQL
    + """, g AS (SELECT o_orderkey, list_filter([CASE WHEN s.state = 'absent' THEN 'no_data' ELSE '' END,
        CASE WHEN s.state = 'partial' THEN 'incomplete_upload' ELSE '' END, CASE WHEN o_orderstatus = 'P' THEN 'stale_record' ELSE '' END,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'validation_errors' ELSE '' END], lambda x: x <> '') AS codes
      FROM s JOIN orders USING (o_orderkey))
    SELECT o_orderkey, coalesce(array_to_string(codes, ','), '') AS codes, codes[1] AS leading, len(codes) AS n FROM g""",
)
def gate_blockers(t) -> DataFrame:
    none = F.lit("")
    codes = codes_present(
        [
            ("no_data", F.col("state") == "absent", none),
            ("incomplete_upload", F.col("state") == "partial", F.array_join("missing", ", ")),
            ("stale_record", F.col("o_orderstatus") == "P", none),
            ("validation_errors", F.col("o_orderpriority") == "1-URGENT", none),
        ]
    )
    return order_status(t).withColumn("_codes", codes).select(
        "o_orderkey",
        joined(F.transform("_codes", lambda c: c["code"])).alias("codes"),
        F.get("_codes", F.lit(0))["code"].alias("leading"),
        F.size("_codes").cast("bigint").alias("n"),
    )


@query(
    "q_deviations",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'status=P' END,
      CASE WHEN c_nationkey <> 0 AND c_acctbal < 0 THEN 'balance' END, CASE WHEN o_totalprice > 490000 THEN 'price' END) AS facts
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderstatus = 'P' OR (c_nationkey <> 0 AND c_acctbal < 0) OR o_totalprice > 490000""",
)
def deviations(t) -> DataFrame:
    owners = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal")
    facts = codes_present(
        [
            ("status=P", F.col("o_orderstatus") == "P", F.lit("")),
            ("balance", (F.col("c_nationkey") != 0) & (F.col("c_acctbal") < 0), F.lit("")),
            ("price", F.col("o_totalprice") > 490000, F.lit("")),
        ]
    )
    rows = t.orders.join(owners, "o_custkey").withColumn("_f", facts).filter(F.size("_f") > 0)
    return rows.select("o_orderkey", joined(F.transform("_f", lambda f: f["code"])).alias("facts"))
