"""Batches add up, and a second run over the same files changes nothing."""

import re

from conftest import rows

from tallymark.operators.upsert import read_current
from tallymark.plans.queries_streaming import STATES, refresh_states
from tallymark.streaming.incremental import expired, listing_stream, run_incremental

EVENTS = "subject bigint, event_type string"


def test_incremental_over_several_batches(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def arrive(*events):
        spark.createDataFrame(list(events), EVENTS).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = listing_stream(spark, source, spark.read.parquet(source).schema, 1)
        run_incremental(spark, stream, ["subject"], refresh_states, STATES, target, progress)
        return rows(read_current(spark, target, ["subject"], STATES), "subject", "state", "n_seen", "n_error")

    arrive((1, "click"), (2, "view"), (2, "purchase"))
    arrive((1, "error"), (3, "signup"))
    first = run()
    assert first == [(1, "FAIL", 2, 1), (2, "PASS WITH WARNINGS", 2, 0), (3, "PENDING", 1, 0)]
    assert run() == first
    arrive((3, "signup"))
    assert run() == [(1, "FAIL", 2, 1), (2, "PASS WITH WARNINGS", 2, 0), (3, "PASS WITH NOTES", 2, 0)]
    # Only the touched subject was written again.
    assert rows(spark.read.parquet(f"{target}/batch=2"), "subject") == [(3,)]


def test_expired(spark):
    from pyspark.sql import functions as F

    df = spark.sql("SELECT * FROM VALUES ('old', TIMESTAMP '2024-01-01 00:00:00'), ('new', TIMESTAMP '2024-01-09 00:00:00') t(k, at)")
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    assert rows(expired(df, "at", now, "7 DAYS"), "k") == [("old",)]


def test_lookups_expire_and_are_renewed(spark, tmp_path):
    from pyspark.sql import functions as F

    from tallymark.streaming.lookups import REQUESTS, run_lookups

    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "key string, day int, answered boolean"

    def arrive(*events):
        spark.createDataFrame(list(events), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = listing_stream(spark, source, spark.read.parquet(source).schema, 1)
        at = F.timestamp_seconds(F.col("day") * 86_400)
        run_lookups(stream.select("key", at.alias("at"), "answered"), 7 * 86_400_000, target, progress)
        return [(k, due // 86_400_000) for k, due in rows(spark.read.schema(REQUESTS).parquet(target), "key", "due_ms")]

    arrive(("a", 1, True), ("b", 1, True), ("c", 1, False))
    assert run() == [("c", 1)]
    # Asked again while the answer is good; one answer is renewed. The query starts anew each time.
    arrive(("a", 6, True), ("b", 6, False), ("d", 6, None))
    assert run() == [("c", 1), ("d", 6)]
    assert run() == [("c", 1), ("d", 6)]
    # Time moves on by another key's event: both answers expire, each a week after its newest.
    arrive(("e", 20, True))
    assert run() == [("a", 13), ("b", 8), ("c", 1), ("d", 6)]
    # What has expired is forgotten: a question about it is a request of its own.
    arrive(("b", 21, False))
    assert ("b", 21) in run()


def test_current_records_over_batches_a_repeat_and_a_base(spark, tmp_path):
    from tallymark.operators.upsert import compact, write_changes

    root = str(tmp_path / "records")
    schema = spark.createDataFrame([], "k long, v string").schema

    def write(n, *pairs):
        write_changes(spark.createDataFrame([(*p, "changed") for p in pairs], "k long, v string, outcome string"), root, n, ["k"])

    def current(**more):
        return rows(read_current(spark, root, ["k"], schema, **more), "k", "v")

    write(0, *((i, "a") for i in range(300)))
    write(1, (3, "b"), (900, "b"))
    write(1, (3, "c"), (901, "c"))  # the attempt before is replaced
    want = [(i, "c" if i == 3 else "a") for i in range(300)] + [(901, "c")]
    assert current() == sorted(want, key=repr)
    compact(spark, root, ["k"], schema, 1)
    write(2, (4, "d"))
    after = sorted([(i, "d" if i == 4 else v) for i, v in want], key=repr)
    assert current() == after and current(before=2) == sorted(want, key=repr) and current(before=1) == sorted([(i, "a") for i in range(300)], key=repr)
    touched = spark.createDataFrame([(3,), (4,), (999,)], "k long")
    found = read_current(spark, root, ["k"], schema, touched=touched)
    assert rows(found, "k", "v") == [(3, "c"), (4, "d")]
    # Three buckets of the base and of the batch after it are opened, and the names reach their files.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket[^\]]*\bIN\b", plan, re.IGNORECASE) and "In(k" in plan


def test_a_stream_with_compactions_between(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for i in range(7):
        spark.createDataFrame([(i % 3, "error" if i == 4 else "click"), (10 + i, "view")], EVENTS).coalesce(1).write.mode("append").parquet(source)
    stream = listing_stream(spark, source, spark.read.parquet(source).schema, 1)
    run_incremental(spark, stream, ["subject"], refresh_states, STATES, target, progress, compact_every=3)
    got = rows(read_current(spark, target, ["subject"], STATES), "subject", "n_seen", "n_error")
    assert got[:3] == [(0, 3, 0), (1, 2, 1), (10, 1, 0)] and len(got) == 10
