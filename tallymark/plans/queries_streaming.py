"""The incremental query: events arrive as files, touched users are re-checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.records import verdict
from tallymark.operators.upsert import read_current
from tallymark.plans.driver import SEVERITY_SQL, query, severity_of
from tallymark.session import scratch
from tallymark.streaming.incremental import added_up, listing_stream, run_incremental
from tallymark.streaming.lookups import REQUESTS, run_lookups

TALLIES = ("n_seen", "n_error", "n_warn", "n_info")
STATES = T.StructType(
    [
        T.StructField("subject", T.LongType()),
        T.StructField("state", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in TALLIES],
    ]
)


def refresh_states(arrived: DataFrame, current: DataFrame) -> DataFrame:
    """Verdict per user from the recorded tallies plus the new events."""
    severity = severity_of()
    new = arrived.groupBy("subject").agg(
        F.count(F.lit(1)).alias("n_seen"),
        *[F.count_if(severity == s).alias(f"n_{s}") for s in ("error", "warn", "info")],
    )
    published = F.when(F.col("n_seen") > 1, "complete").otherwise("partial")
    return added_up(new, current, ["subject"], TALLIES).withColumn("state", verdict(published))


@query(
    "q_incremental_stale",
    f"""WITH f AS (SELECT user_id AS subject, {SEVERITY_SQL} AS severity FROM events)
    SELECT subject, CASE WHEN bool_or(coalesce(severity, '') = 'error') THEN 'FAIL' WHEN count(*) <= 1 THEN 'PENDING'
      WHEN bool_or(coalesce(severity, '') = 'warn') THEN 'PASS WITH WARNINGS' WHEN bool_or(coalesce(severity, '') = 'info') THEN 'PASS WITH NOTES' ELSE 'PASS' END AS state,
      count(*) FILTER (WHERE severity = 'error') AS n_error, count(*) FILTER (WHERE severity = 'warn') AS n_warn FROM f GROUP BY 1""",
)
def incremental_stale(t) -> DataFrame:
    spark = t.spark
    stream = listing_stream(spark, f"{t.root}/events*.parquet", t.events.schema).select(
        F.col("user_id").alias("subject"), "event_type"
    )
    target = scratch(spark, "states")
    run_incremental(
        spark, stream, ["subject"], refresh_states, STATES, target, scratch(spark, "progress")
    )
    return read_current(spark, target, ["subject"], STATES).select("subject", "state", "n_error", "n_warn")


DAY_MS = 86_400_000


@query(
    "q_expiring_lookups",
    """WITH e AS (SELECT user_id, date_trunc('milliseconds', ts) AS seen, event_type = 'purchase' AS good FROM events),
      k AS (SELECT user_id, max(seen) FILTER (WHERE good) AS answered, max(seen) FILTER (WHERE NOT coalesce(good, false)) AS asked FROM e GROUP BY 1),
      d AS (SELECT user_id, coalesce(answered + INTERVAL 2 DAY, asked) AS due FROM k
        WHERE answered IS NULL OR answered + INTERVAL 2 DAY < (SELECT max(seen) FROM e))
    SELECT CAST(user_id AS VARCHAR) AS key, strftime(due, '%Y-%m-%d %H:%M:%S.%g') AS due FROM d""",
)
def expiring_lookups(t) -> DataFrame:
    """Purchases as answers about a user, good for two days of the stream's time; other events as questions."""
    spark = t.spark
    events = listing_stream(spark, f"{t.root}/events*.parquet", t.events.schema).select(
        F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_type") == "purchase").alias("answered")
    )
    target = scratch(spark, "requests")
    run_lookups(events, 2 * DAY_MS, target, scratch(spark, "progress"))
    due = F.date_format(F.timestamp_millis("due_ms"), "yyyy-MM-dd HH:mm:ss.SSS")
    return spark.read.schema(REQUESTS).parquet(target).select("key", due.alias("due"))
