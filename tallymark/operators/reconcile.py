"""Comparing a declared side with an observed side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import describe
from tallymark.operators.ranking import first_n


def presence(
    left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Distinct keys of both sides with flags ``in_left`` and ``in_right``.

    One exchange with map-side combination, so repeated keys collapse
    before they are moved.
    """
    both = (
        left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    )
    return both.groupBy(*keys).agg(
        F.max("_l").alias("in_left"), F.max("_r").alias("in_right")
    )


def reconcile_sets(
    left: DataFrame,
    right: DataFrame,
    subject: Sequence[str],
    key: str,
    *,
    limit: int = 5,
    keep_equal: bool = False,
) -> DataFrame:
    """Per subject: sizes, one-sided counts and the first one-sided names.

    Subjects whose two sets agree are left out unless ``keep_equal``.
    """
    keys = [*subject, key]
    flags = presence(left, right, keys)
    only_left = F.col("in_left") > F.col("in_right")
    only_right = F.col("in_right") > F.col("in_left")
    counts = flags.groupBy(*subject).agg(
        F.sum("in_left").cast("bigint").alias("n_left"),
        F.sum("in_right").cast("bigint").alias("n_right"),
        F.count_if(only_left).alias("n_only_left"),
        F.count_if(only_right).alias("n_only_right"),
    )
    if not keep_equal:
        counts = counts.filter("n_only_left + n_only_right > 0")
    strays = first_n(
        flags.filter("in_left <> in_right"), [*subject, "in_left"], [key], limit
    )
    names = strays.groupBy(*subject).agg(
        F.array_sort(F.collect_list(F.when(F.col("in_left") == 1, F.col(key)))).alias("_lefts"),
        F.array_sort(F.collect_list(F.when(F.col("in_right") == 1, F.col(key)))).alias("_rights"),
    )
    return (
        counts.join(names, list(subject), "left")
        .withColumn("only_left", describe(F.col("_lefts"), F.col("n_only_left"), limit))
        .withColumn("only_right", describe(F.col("_rights"), F.col("n_only_right"), limit))
        .drop("_lefts", "_rights")
    )


def missing_from(
    wanted: DataFrame, present: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows of ``wanted`` whose key is not present."""
    return wanted.join(present.select(*keys), list(keys), "left_anti")


def without_companion(
    items: DataFrame, companions: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Items lacking every accepted companion.

    ``companions`` carries the key of the item each companion belongs to,
    so any number of accepted forms is one anti join.
    """
    return missing_from(items, companions, keys)


def mismatched(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    a: str,
    b: str,
) -> DataFrame:
    """Matched rows whose two values are both known and differ."""
    return left.join(right, list(keys)).filter(F.col(a) != F.col(b))


def sequences_differ(
    rows: DataFrame,
    subject: Sequence[str],
    side: str,
    sides: tuple[str, str],
    seq: str,
    values: Sequence[str],
    key: str,
) -> DataFrame:
    """Per subject: ``same``, ``same keys`` or ``different keys``.

    ``rows`` holds both sides, told apart by the column ``side`` and numbered
    by ``seq`` within each. They are compared position by position.
    """
    left, right = (F.col(side) == s for s in sides)
    equal = F.lit(True)
    for v in values:
        equal = equal & F.col(f"_l_{v}").eqNullSafe(F.col(f"_r_{v}"))
    paired = (
        rows.groupBy(*subject, seq)
        .agg(
            F.count_if(left).alias("_l"),
            F.count_if(right).alias("_r"),
            *[F.max(F.when(left, F.col(v))).alias(f"_l_{v}") for v in values],
            *[F.max(F.when(right, F.col(v))).alias(f"_r_{v}") for v in values],
        )
        .groupBy(*subject)
        .agg(F.bool_and((F.col("_l") == F.col("_r")) & equal).alias("_same"))
    )
    keys = (
        rows.groupBy(*subject, key)
        .agg(F.bool_or(left).alias("_l"), F.bool_or(right).alias("_r"))
        .groupBy(*subject)
        .agg(F.bool_and(F.col("_l") == F.col("_r")).alias("_keys"))
    )
    outcome = F.when(F.col("_same"), "same").when(F.col("_keys"), "same keys")
    return paired.join(keys, list(subject)).select(
        *subject, outcome.otherwise("different keys").alias("outcome")
    )


def map_differences(
    left: DataFrame,
    right: DataFrame,
    subject: Sequence[str],
    key: str,
    value: str,
    *,
    limit: int = 5,
) -> DataFrame:
    """Per subject: how two key-to-value maps differ, null values unknown."""
    number = left.schema[value].dataType
    both = left.select(
        *subject, key, F.lit(1).alias("_l"), F.lit(0).alias("_r"),
        F.col(value).alias("_a"), F.lit(None).cast(number).alias("_b"),
    ).unionByName(
        right.select(
            *subject, key, F.lit(0).alias("_l"), F.lit(1).alias("_r"),
            F.lit(None).cast(number).alias("_a"), F.col(value).alias("_b"),
        )
    )
    merged = both.groupBy(*subject, key).agg(
        F.max("_l").alias("_l"), F.max("_r").alias("_r"),
        F.max("_a").alias("_a"), F.max("_b").alias("_b"),
    )
    return paired_differences(merged, subject, key, limit=limit)


def paired_differences(
    pairs: DataFrame, subject: Sequence[str], key: str, *, limit: int = 5
) -> DataFrame:
    """``map_differences`` of maps that are side by side already.

    ``pairs`` has a row for each subject and key: ``_l`` and ``_r``, 1 where the
    left or right map has the key, and the values ``_a`` and ``_b``.
    """
    merged = pairs.withColumn(
        "kind",
        F.when(F.col("_r") == 0, "only_left")
        .when(F.col("_l") == 0, "only_right")
        .when(F.col("_a") != F.col("_b"), "value"),
    )
    kinds = ("only_left", "only_right", "value")
    counts = (
        merged.groupBy(*subject)
        .agg(
            F.sum("_l").cast("bigint").alias("n_left"),
            F.sum("_r").cast("bigint").alias("n_right"),
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds],
        )
        .filter("n_only_left + n_only_right + n_value > 0")
    )
    named = (
        first_n(merged.filter("kind IS NOT NULL"), [*subject, "kind"], [key], limit)
        .groupBy(*subject)
        .agg(
            *[
                F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col(key)))).alias(f"_{k}")
                for k in kinds
            ]
        )
    )
    out = counts.join(named, list(subject))
    for k in kinds:
        out = out.withColumn(f"{k}_names", describe(F.col(f"_{k}"), F.col(f"n_{k}"), limit)).drop(f"_{k}")
    return out


def unlike_first(
    entries: DataFrame, subject: Sequence[str], member: str, values: Sequence[str]
) -> DataFrame:
    """Members whose set of entries is not that of the subject's first member.

    Exact: entries matched by the first member are counted, and a member
    agrees when its matches, its entries and the first one's are equally
    many. Returns every member with flag ``differs``.
    """
    distinct = entries.select(*subject, member, *values).distinct()
    sizes = distinct.groupBy(*subject, member).agg(F.count(F.lit(1)).alias("_size"))
    lead = sizes.groupBy(*subject).agg(F.min(F.struct(member, "_size")).alias("_lead"))
    first = lead.select(*subject, F.col(f"_lead.{member}").alias(member))
    base = distinct.join(first, [*subject, member], "left_semi").select(*subject, *values)
    hits = (
        distinct.join(base, [*subject, *values], "left_semi")
        .groupBy(*subject, member)
        .agg(F.count(F.lit(1)).alias("_hits"))
    )
    agrees = (F.col("_size") == F.col("_lead._size")) & (F.col("_hits") == F.col("_size"))
    return (
        sizes.join(hits, [*subject, member], "left")
        .join(lead, list(subject))
        .select(*subject, member, (~F.coalesce(agrees, F.lit(False))).alias("differs"))
    )


def set_equals(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """Per key present on both sides: whether the two value sets are equal."""
    flags = presence(left, right, [*keys, value])
    return (
        flags.groupBy(*keys)
        .agg(
            F.max("in_left").alias("_l"),
            F.max("in_right").alias("_r"),
            F.bool_and(F.col("in_left") == F.col("in_right")).alias("equal"),
        )
        .filter("_l = 1 AND _r = 1")
        .drop("_l", "_r")
    )


def two_sided(
    left: DataFrame, right: DataFrame, keys: Sequence[str], a: str, b: str
) -> DataFrame:
    """Outer pairing with ``side``: left only, right only, same or differ."""
    paired = left.join(right, list(keys), "full_outer")
    side: Column = (
        F.when(F.col(b).isNull() & F.col(a).isNull(), "neither")
        .when(F.col(b).isNull(), "left only")
        .when(F.col(a).isNull(), "right only")
        .when(F.col(a) == F.col(b), "same")
        .otherwise("differ")
    )
    return paired.withColumn("side", side)
