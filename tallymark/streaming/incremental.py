"""Keep records current as new objects arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.upsert import COMPACT_EVERY, change_only, compact, read_current, write_changes


def listing_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A directory of listing files as a stream of their rows.

    Without a limit everything that has arrived is one batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_incremental(
    spark: SparkSession,
    stream: DataFrame,
    keys: Sequence[str],
    refresh: Callable[[DataFrame, DataFrame], DataFrame],
    schema: T.StructType,
    target: str,
    checkpoint: str,
    volatile: Sequence[str] = (),
    compact_every: int = COMPACT_EVERY,
) -> None:
    """Process everything that has arrived, then stop.

    ``refresh(arrived, current)`` returns fresh records of the subjects the
    batch touches; ``current`` are their records from earlier batches. Only
    new and changed records are written, to a directory per batch that a
    repeated attempt replaces, and ``current`` never includes what a failed
    attempt of the same batch left behind. Reading it opens what may hold touched
    keys; every ``compact_every`` batches the earlier ones become one base.
    """
    # An empty first batch, so that the target can always be read.
    spark.createDataFrame([], schema).withColumn("bucket", F.lit(0)).write.mode("ignore").partitionBy("bucket").parquet(f"{target}/batch=-1")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            compact(spark, target, keys, schema, batch_id - 1)
        current = read_current(spark, target, keys, schema, before=batch_id, touched=batch.select(*keys))
        fresh = refresh(batch, current).select(*schema.names)
        write_changes(change_only(current, fresh, keys, volatile), target, batch_id, keys)

    (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def added_up(
    arrived: DataFrame, current: DataFrame, keys: Sequence[str], tallies: Sequence[str]
) -> DataFrame:
    """Tallies of new rows added to recorded ones; earlier rows are not read again."""
    columns = [*keys, *tallies]
    return (
        arrived.select(*columns)
        .unionByName(current.select(*columns))
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in tallies])
    )


def expired(lookups: DataFrame, stored_at: str, now, ttl: str) -> DataFrame:
    """Lookups too old to be trusted, to be requested again."""
    return lookups.filter(F.col(stored_at) <= now - F.expr(f"INTERVAL {ttl}"))
