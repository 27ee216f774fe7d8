"""Writing only what changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.ranking import last_per_key


def _comparable(c: Column, kind: T.DataType) -> Column:
    # Maps cannot be compared directly; their sorted entries can.
    return F.array_sort(F.map_entries(c)) if isinstance(kind, T.MapType) else c


def change_only(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    volatile: Sequence[str],
) -> DataFrame:
    """What writing ``new`` over ``old`` would do, one row per key.

    Both sides have one row per key and the same columns. The ``volatile``
    columns describe the act of writing, not the content: a row whose other
    columns are equal keeps its old ones. ``outcome`` is ``new``,
    ``changed``, ``unchanged`` or ``kept`` (nothing new for this key).
    """
    cols = [c for c in new.columns if c not in keys]
    content = [c for c in cols if c not in volatile]
    before = old.select(*keys, F.struct(*cols).alias("_old"))
    after = new.select(*keys, F.struct(*cols).alias("_new"))
    same = F.lit(True)
    for c in content:
        kind = new.schema[c].dataType
        same = same & _comparable(F.col(f"_old.{c}"), kind).eqNullSafe(
            _comparable(F.col(f"_new.{c}"), kind)
        )
    outcome = (
        F.when(F.col("_new").isNull(), "kept")
        .when(F.col("_old").isNull(), "new")
        .when(same, "unchanged")
        .otherwise("changed")
    )
    paired = before.join(after, list(keys), "full_outer").withColumn("outcome", outcome)
    row = F.when(F.col("outcome").isin("new", "changed"), F.col("_new")).otherwise(F.col("_old"))
    return paired.withColumn("_row", row).select(*keys, "outcome", "_row.*")


def without_failed(new: DataFrame, failed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop fresh rows of failed keys, so their earlier row survives."""
    return new.join(failed.select(*keys).distinct(), list(keys), "left_anti")


def change_report(outcomes: DataFrame) -> DataFrame:
    """Keys per outcome, in one row; what a dry run shows."""
    names = ("new", "changed", "unchanged", "kept")
    return outcomes.agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in names]).withColumn(
        "would_change", F.col("new") + F.col("changed") > 0
    )


# Parts of a table of records, by hash of the key, and keys that are looked for by name.
BUCKETS = 64
BY_NAME = 2_000
# Batches between two compactions.
COMPACT_EVERY = 16


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A directory a bucket, sorted by key, with a Bloom filter of the first key in every file."""
    placed = rows.withColumn("bucket", _bucket(keys, buckets)).repartition("bucket").sortWithinPartitions("bucket", *keys)
    placed.write.mode("overwrite").partitionBy("bucket").option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").parquet(path)


def write_changes(outcomes: DataFrame, root: str, batch: int, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write new and changed rows as one numbered batch.

    The batch directory is replaced as a whole, so a repeated attempt
    leaves the same result. Nothing already written is touched.
    """
    _write(outcomes.filter(F.col("outcome").isin("new", "changed")).drop("outcome"), f"{root}/batch={batch}", keys, buckets)


def _compacted(spark: SparkSession, root: str, before: int | None) -> int | None:
    """The last batch that a complete base takes in, of those before one."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/_base")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    done = [
        int(s.getPath().getName().split("=")[1]) for s in files.listStatus(folder)
        if files.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return max((n for n in done if before is None or n < before), default=None)


def compact(spark: SparkSession, root: str, keys: Sequence[str], schema: T.StructType, through: int, buckets: int = BUCKETS) -> None:
    """Write the latest rows of all batches up to one as a base, which later reads start from.

    A base counts once it is complete; batches stay as they are until someone removes them.
    """
    _write(read_current(spark, root, keys, schema, before=through + 1), f"{root}/_base/through={through}", keys, buckets)


def read_current(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    schema: T.StructType,
    before: int | None = None,
    touched: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The latest row of every key over all batches, or those before one.

    Reads the last complete base and the batches after it. Of ``touched`` keys only
    their buckets are opened; up to BY_NAME of them are looked for by name as well, so
    that file statistics and Bloom filters leave out files and row groups.
    """
    placed = [*schema.fields, T.StructField("bucket", T.IntegerType())]
    rows = spark.read.schema(T.StructType([*placed, T.StructField("batch", T.LongType())])).parquet(root)
    if before is not None:
        rows = rows.filter(F.col("batch") < before)
    through = _compacted(spark, root, before)
    if through is not None:
        base = spark.read.schema(T.StructType(placed)).parquet(f"{root}/_base/through={through}")
        rows = rows.filter(F.col("batch") > through).unionByName(base.withColumn("batch", F.lit(through).cast("long")))
    if touched is not None:
        wanted = touched.select(*keys).distinct()
        # At most as many numbers as there are buckets.
        numbers = [r["b"] for r in wanted.select(_bucket(keys, buckets).alias("b")).distinct().collect()]
        rows = rows.filter(F.col("bucket").isin(numbers))
        named = wanted.select(keys[0]).distinct().limit(BY_NAME + 1).collect()
        if len(named) <= BY_NAME:
            rows = rows.filter(F.col(keys[0]).isin([r[0] for r in named]))
        rows = rows.join(wanted, list(keys), "left_semi")
    return last_per_key(rows.drop("bucket"), keys, ["batch"]).drop("batch").select(*schema.names)
