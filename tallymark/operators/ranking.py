"""Order-dependent operators that stay bounded per task.

A single subject may own a large share of all rows, so nothing here puts a
whole group into one window partition or one array. Top-n filters are
written as ``row_number() <= n``, which Spark limits on the map side before
the shuffle; running values are computed per fixed-width stretch of the
ordering and then corrected by what the earlier stretches add up to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Positions per stretch when a running value is split up.
STRETCH = 65536


# Rows that are grouped in one task.
ROWS_A_TASK = 250_000


def dealt(df: DataFrame, keys: Sequence[str | Column], n_rows: int) -> DataFrame:
    """Rows by the hash of their keys, some ROWS_A_TASK a task.

    Groupings on these keys need no further exchange. Left alone, adaptive execution
    puts 64 MB of compressed rows together, which may be many millions of narrow ones.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(least, -(-n_rows // ROWS_A_TASK)), *keys)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_n(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of every group."""
    window = W.partitionBy(*group).orderBy(*[_col(c) for c in order])
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def heads(
    members: DataFrame, group: Sequence[str], key: str, limit: int = 5, out: str = "head"
) -> DataFrame:
    """Sorted array of the first ``limit`` members; ``members`` are distinct."""
    return (
        first_n(members, group, [key], limit)
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list(key)).alias(out))
    )


def described(
    members: DataFrame, group: Sequence[str], key: str, limit: int = 5
) -> DataFrame:
    """Per group: ``n`` distinct members and ``head``, the first of them."""
    distinct = members.select(*group, key).distinct()
    counts = distinct.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(heads(distinct, group, key, limit), list(group))


def last_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The last row of every key; duplicates earlier in the order are dropped."""
    return _edge_per_key(df, keys, order, F.max_by)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    return _edge_per_key(df, keys, order, F.min_by)


def _edge_per_key(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    place = F.struct(*[_col(c) for c in order])
    return df.groupBy(*keys).agg(pick(row, place).alias("_row")).select(*keys, "_row.*")


def later_occurrences(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Second and later rows of a repeated key.

    Only repeated keys are joined back. A key with very many copies is a
    skewed stream side against one row, which adaptive execution splits.
    """
    first = (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    return (
        df.join(first, list(keys))
        .filter(F.struct(*order) > F.col("_first"))
        .drop("_first")
    )


def numbered(
    df: DataFrame,
    group: Sequence[str],
    stretch: Sequence[Column],
    order: Sequence[str | Column],
    out: str = "seq",
) -> DataFrame:
    """1-based position of every row inside its group.

    ``stretch`` cuts the ordering into pieces that sort like the rows do,
    so each window partition is one piece of a group.
    """
    names = [f"_s{i}" for i in range(len(stretch))]
    cut = df
    for name, expr in zip(names, stretch):
        cut = cut.withColumn(name, expr)
    before = W.partitionBy(*group).orderBy(*names).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*group, *names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = W.partitionBy(*group, *names).orderBy(*[_col(c) for c in order])
    return (
        cut.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*group, *names])
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside", *names)
    )


def segment_by_marker(
    df: DataFrame,
    group: Sequence[str],
    pos: str,
    starts: Column,
    out: str = "block",
    stretch: int = STRETCH,
) -> DataFrame:
    """Position of the last starting row at or before each row.

    Rows before the first start of their group get null. ``pos`` is a whole
    number giving the order.
    """
    marked = df.withColumn("_start", F.when(starts, F.col(pos))).withColumn(
        "_piece", F.floor(F.col(pos) / stretch)
    )
    earlier = W.partitionBy(*group).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        marked.groupBy(*group, "_piece")
        .agg(F.max("_start").alias("_last"))
        .withColumn("_carry", F.max("_last").over(earlier))
        .drop("_last")
    )
    here = (
        W.partitionBy(*group, "_piece")
        .orderBy(pos)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        marked.withColumn("_here", F.max("_start").over(here))
        .join(carried, [*group, "_piece"])
        .withColumn(out, F.coalesce("_here", "_carry"))
        .drop("_start", "_piece", "_here", "_carry")
    )


def stable_sample(
    members: DataFrame, group: Sequence[str], name: str, size: int, seed: str
) -> DataFrame:
    """The first member by name, then ``size - 1`` others in hash order.

    The draw depends on the seed and the names only, so every run agrees.
    """
    hashed = members.select(*group, name).distinct()
    hashed = hashed.withColumn(
        "_draw", F.md5(F.concat_ws(":", F.lit(seed), *[F.col(g) for g in group], F.col(name)))
    )
    lead = hashed.groupBy(*group).agg(F.min(name).alias(name))
    drawn = first_n(hashed, group, ["_draw", name], size, "_r").drop("_r")
    rest = first_n(
        drawn.join(lead, [*group, name], "left_anti"), group, ["_draw", name], size - 1, "_r"
    )
    return lead.withColumn("is_first", F.lit(1)).unionByName(
        rest.select(*group, name).withColumn("is_first", F.lit(0))
    )


def milestones(
    df: DataFrame, weight: str, targets: Sequence[int] = (50, 75, 90)
) -> DataFrame:
    """How many of the heaviest items reach each share of the total weight.

    Weights are whole numbers. Items are first counted per weight and the
    weights gathered into logarithmic bands, of which there are at most a
    few thousand; only the bands where a target is crossed are opened.
    """
    by_weight = (
        df.filter(F.col(weight) > 0)
        .groupBy(F.col(weight).cast("bigint").alias("_w"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_band", F.floor(F.log2("_w") * 64))
    )
    down = W.orderBy(F.desc("_band"))
    before = down.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.desc("_band")).rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing
    )
    bands = (
        by_weight.groupBy("_band")
        .agg(F.sum("_n").alias("_items"), F.sum(F.col("_w") * F.col("_n")).alias("_mass"))
        .withColumn("_rank0", F.coalesce(F.sum("_items").over(before), F.lit(0)))
        .withColumn("_mass0", F.coalesce(F.sum("_mass").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_mass").over(everything))
        .withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
        .withColumn("_need", F.expr("(_total * target + 99) div 100"))
        .filter("_mass0 < _need AND _mass0 + _mass >= _need")
        .select("_band", "target", "_need", "_rank0", "_mass0")
    )
    inside = (
        W.partitionBy("target").orderBy(F.desc("_w")).rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        by_weight.join(F.broadcast(bands), "_band")  # at most one row per target
        .withColumn(
            "_m", F.col("_mass0") + F.coalesce(F.sum(F.col("_w") * F.col("_n")).over(inside), F.lit(0))
        )
        .withColumn("_r", F.col("_rank0") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .filter("_m < _need AND _m + _w * _n >= _need")
        .select("target", F.expr("_r + (_need - _m + _w - 1) div _w").alias("items"))
    )
