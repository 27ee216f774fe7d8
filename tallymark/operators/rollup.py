"""Aggregations over subjects, artifacts and per-sample metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.text import sha256_tag
from tallymark.operators.ranking import dealt, first_n
from tallymark.session import cut

# What a finished publication holds, in report order.
REQUIRED_ARTIFACTS = ("raw_vcf", "raw_vcf_index", "bams", "qc", "callable_sites")
OPTIONAL_ARTIFACTS = ("filtered_vcf",)

# Lower edges of the depth histogram; the last bucket is open.
DEPTH_LADDER = (0, 5, 10, 15, 20, 30, 40, 60, 100)
BAR_WIDTH = 30


def counts_with_zeros(
    df: DataFrame, column: str, values: Sequence[str], out: str = "n"
) -> DataFrame:
    """Rows per value, including values that do not occur.

    One aggregation with one counter per value, then unpivoted.
    """
    counted = df.agg(
        *[F.count_if(F.col(column) == v).alias(f"_{i}") for i, v in enumerate(values)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(v).alias(column), F.lit(i).alias("rank"), F.col(f"_{i}").alias(out))
            for i, v in enumerate(values)
        ]
    )
    return counted.select(F.inline(pairs))


def publication_status(
    flags: DataFrame,
    subject: Sequence[str],
    required: Sequence[str],
    optional: Sequence[str],
    exists: Column,
) -> DataFrame:
    """State and missing artifacts from one boolean column per artifact.

    ``absent`` when nothing is listed at all, ``complete`` when no required
    artifact is missing, else ``partial``. Optional artifacts never change
    the state and are not missed where nothing is published.
    """
    def absent(names: Sequence[str]) -> Column:
        return F.array_compact(
            F.array(*[F.when(~F.coalesce(F.col(n), F.lit(False)), F.lit(n)) for n in names])
        )

    listed = F.coalesce(exists, F.lit(False))
    missing = F.when(listed, absent(required)).otherwise(
        F.array(*[F.lit(n) for n in required])
    )
    none = F.array().cast("array<string>")
    everything = [*required, *optional]
    present = F.array_compact(
        F.array(*[F.when(F.coalesce(F.col(n), F.lit(False)), F.lit(n)) for n in everything])
    )
    state = (
        F.when(~listed, "absent").when(F.size("missing") == 0, "complete").otherwise("partial")
    )
    return flags.withColumn("missing", missing).select(
        *flags.columns,
        "missing",
        state.alias("state"),
        F.when(listed, F.array_sort(present)).otherwise(none).alias("present"),
        F.when(listed, absent(optional)).otherwise(none).alias("missing_optional"),
    )


def optional_coverage(status: DataFrame, artifacts: Sequence[str] = OPTIONAL_ARTIFACTS) -> DataFrame:
    """How many of the published subjects have each optional artifact."""
    counted = status.filter("state <> 'absent'").agg(
        F.count(F.lit(1)).alias("n_published"),
        *[F.count_if(F.array_contains("present", a)).alias(f"_{i}") for i, a in enumerate(artifacts)],
    )
    pairs = [F.struct(F.lit(a).alias("artifact"), F.col(f"_{i}").alias("n")) for i, a in enumerate(artifacts)]
    return counted.select(F.inline(F.array(*pairs)), "n_published")


def set_fingerprint(df: DataFrame, subject: Sequence[str], item: str) -> DataFrame:
    """Per subject: member count and one digest of its members, whatever its size.

    Members are counted, dealt by the first four hex digits of their own hash,
    and each of the parts that occur, 65,536 at most, is digested with its
    members in order; the subject's digest is that of its parts. Copies collapse
    before a part is gathered, so no task holds a whole subject.
    """

    def digest(parts: Column) -> Column:
        return sha256_tag(F.array_join(F.array_sort(parts), "\n"))

    part = F.substring(F.sha2("_item", 256), 1, 4)
    members = df.groupBy(*subject, F.col(item).alias("_item")).agg(F.count(F.lit(1)).alias("_n"))
    parts = members.groupBy(*subject, part.alias("_part")).agg(
        F.sum("_n").alias("_n"), digest(F.collect_list(F.concat_ws("\t", "_item", "_n"))).alias("_d")
    )
    return parts.groupBy(*subject).agg(
        F.sum("_n").alias("count"), digest(F.collect_list(F.concat_ws(":", "_part", "_d"))).alias("digest")
    )


def missing_share(
    wanted: DataFrame,
    present: DataFrame,
    subject: Sequence[str],
    key: str,
    weight: str,
    threshold: float = 1.0,
    top: int = 3,
) -> DataFrame:
    """Per subject: how many wanted keys are missing and what they weigh.

    ``severity`` is ``warn`` when the share of the total weight is strictly
    above ``threshold`` percent, else ``info``. ``largest`` holds the
    heaviest missing keys.
    """
    marks = present.select(*subject, key, F.lit(1).alias("_p")).distinct()
    flagged = wanted.join(marks, [*subject, key], "left").withColumn(
        "_weight", F.coalesce(F.col(weight), F.lit(0))
    )
    gone = F.col("_p").isNull()
    totals = (
        flagged.groupBy(*subject)
        .agg(
            F.count_if(gone).alias("n_missing"),
            F.sum(F.when(gone, F.col("_weight")).otherwise(0)).alias("missing_weight"),
            F.sum("_weight").alias("total_weight"),
        )
        .filter("n_missing > 0")
        .withColumn(
            "percent",
            F.when(
                F.col("total_weight") > 0,
                F.col("missing_weight") / F.col("total_weight") * 100,
            ).otherwise(F.lit(0.0)),
        )
        .withColumn("severity", F.when(F.col("percent") > threshold, "warn").otherwise("info"))
    )
    biggest = (
        first_n(flagged.filter(gone), subject, [F.desc("_weight"), key], top)
        .groupBy(*subject)
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", key, "_weight"))),
                lambda r: F.struct(r[key].alias("key"), r["_weight"].alias("weight")),
            ).alias("largest")
        )
    )
    return totals.join(biggest, list(subject))


def sizes_by_prefix(
    objects: DataFrame, subject: Sequence[str], path: str, size: str, prefixes: Sequence[str]
) -> DataFrame:
    """Bytes and objects per subject, in total and below each prefix."""
    below = {"all": F.lit(True), **{p.strip("/"): F.col(path).startswith(p) for p in prefixes}}
    return objects.groupBy(*subject).agg(
        *[F.sum(F.when(c, F.col(size)).otherwise(0)).alias(f"size_{n}") for n, c in below.items()],
        *[F.count_if(c).alias(f"count_{n}") for n, c in below.items()],
    )


def constant_column(df: DataFrame, subject: Sequence[str], value: str) -> DataFrame:
    """The value where it is the same on all rows, else how many there are."""
    n = F.count_distinct(value)
    return df.groupBy(*subject).agg(n.alias("n_values"), F.min(value).alias("_v")).select(
        *subject, "n_values", F.when(F.col("n_values") == 1, F.col("_v")).alias("value")
    )


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    fractions: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0),
    cells: int = 65_536,
    per_cell: int = 4_000_000,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    The needed order statistics are located by counting: a round splits the
    value range of the cells that hold one into ``cells`` equal parts,
    counts them (combined on the map side) and keeps the parts that hold a
    needed rank. Rounds repeat while a kept part has more than ``per_cell``
    rows and its range can be split. What is left is counted per distinct
    value. No group is ever gathered in one place.

    The kept parts, a few rows per group, are written out after each round;
    the rounds run when this is called.
    """
    fs = [float(f) for f in fractions]
    names = [f"q{int(round(f * 100))}" for f in fs]
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        *group, F.col(value).cast("double").alias("_v")
    )
    spot = [F.lit(f) * (F.col("n") - 1) for f in fs]
    wanted = F.array_distinct(
        F.array(
            *[F.floor(p) for p in spot],
            *[F.least(F.floor(p) + 1, F.col("n") - 1) for p in spot],
        )
    )

    def holding(base: Column, size: Column) -> Column:
        return F.filter("_want", lambda x: (x >= base) & (x < base + size))

    # Infinite values get parts of their own, so ranges stay finite; halving
    # keeps the width of any finite range from overflowing.
    finite = F.when(F.abs("_v") < F.lit(float("inf")), F.col("_v"))
    width = F.col("_hi") / 2 - F.col("_lo") / 2
    place = (
        F.when(finite.isNull(), F.when(F.col("_v") < 0, -1).otherwise(cells + 1).cast("bigint"))
        .when(width > 0, F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / width * cells))
        .otherwise(F.lit(0).cast("bigint"))
    )
    keys = list(group)
    summary = cut(
        rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.min(finite).alias("_lo"), F.max(finite).alias("_hi")
        )
    )
    cell = summary.withColumn("_want", wanted).withColumn("_base", F.lit(0).cast("bigint"))
    level, crowded = 0, True
    while crowded:
        part = f"_c{level}"
        rows = rows.join(cell.select(*keys, "_lo", "_hi"), keys).select(*keys, place.alias(part), "_v")
        counted = rows.groupBy(*keys, part).agg(
            F.count(F.lit(1)).alias("_k"), F.min(finite).alias("_lo2"), F.max(finite).alias("_hi2")
        )
        before = W.partitionBy(*keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
        cell = cut(
            counted.join(cell.select(*keys, "_want", "_base"), keys)
            .withColumn("_base", F.col("_base") + F.coalesce(F.sum("_k").over(before), F.lit(0)))
            .withColumn("_want", holding(F.col("_base"), F.col("_k")))
            .filter(F.size("_want") > 0)
            .select(
                *keys, part, "_want", "_base", "_k", F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi")
            )
        )
        keys = [*keys, part]
        rows = rows.join(cell.select(*keys), keys, "left_semi")
        crowded = not cell.filter((F.col("_k") > per_cell) & (width > 0)).isEmpty()
        level += 1
    before = W.partitionBy(*keys).orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    found = (
        rows.groupBy(*keys, "_v")
        .agg(F.count(F.lit(1)).alias("_k"))
        .join(cell.select(*keys, "_want", "_base"), keys)
        .withColumn("_base", F.col("_base") + F.coalesce(F.sum("_k").over(before), F.lit(0)))
        .select(*group, F.explode(holding(F.col("_base"), F.col("_k"))).alias("_rank"), "_v")
        .groupBy(*group)
        .agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    )
    out = summary.select(*group, "n").join(found, list(group))

    def pick(p: Column) -> Column:
        low = F.element_at("_at", F.floor(p))
        high = F.element_at("_at", F.least(F.floor(p) + 1, F.col("n") - 1))
        share = p - F.floor(p)
        return F.when(share == 0, low).otherwise(low + (high - low) * share)

    return out.select(*group, "n", *[pick(p).alias(name) for p, name in zip(spot, names)])


def histogram(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    ladder: Sequence[float] = DEPTH_LADDER,
    weight: Column | None = None,
) -> DataFrame:
    """Counts on a fixed ladder, empty edges trimmed and inner zeros kept.

    Rows counted beforehand bring their number as ``weight``. ``bar`` is the length of the longest-is-thirty bar, at least one where
    anything was counted.
    """
    v = F.col(value)
    rung = F.lit(None).cast("int")
    for i, edge in enumerate(ladder):
        rung = F.when(v >= edge, F.lit(i)).otherwise(rung)
    counted = (
        df.withColumn("bucket", rung)
        .filter("bucket IS NOT NULL")
        .groupBy(*group, "bucket")
        .agg(F.sum(F.lit(1) if weight is None else weight).alias("_n"))
    )
    # At most one entry per rung of the ladder.
    packed = counted.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "_n"))).alias("_counts"),
        F.min("bucket").alias("_from"),
        F.max("bucket").alias("_to"),
        F.max("_n").alias("_peak"),
    )
    n = F.coalesce(F.element_at("_counts", F.col("bucket")), F.lit(0).cast("bigint"))
    bar = F.greatest(F.lit(1), F.bround(F.lit(float(BAR_WIDTH)) * F.col("n") / F.col("_peak"), 0))
    edges = F.array(*[F.lit(float(e)) for e in ladder])
    return (
        packed.withColumn("bucket", F.explode(F.sequence("_from", "_to")))
        .withColumn("n", n)
        .select(
            *group,
            "bucket",
            F.get(edges, F.col("bucket")).alias("low"),
            "n",
            F.when(F.col("n") > 0, bar.cast("int")).otherwise(F.lit(0)).alias("bar"),
        )
    )


def extremes(df: DataFrame, group: Sequence[str], name: str, value: str) -> DataFrame:
    """Lowest and highest member; the smallest name wins ties on both ends."""
    v = F.col(value)
    return df.groupBy(*group).agg(
        F.min(v).alias("low"),
        F.min_by(name, F.struct(v, F.col(name))).alias("low_name"),
        F.max(v).alias("high"),
        F.min_by(name, F.struct(-v, F.col(name))).alias("high_name"),
    )


def input_mix(df: DataFrame, subject: Sequence[str], kind: str, key: str) -> DataFrame:
    """Rows per input kind with the subject's row and distinct-key totals."""
    kinds = df.groupBy(*subject, kind).agg(F.count(F.lit(1)).alias("n"))
    totals = (
        df.groupBy(*subject, key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*subject)
        .agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))
    )
    return kinds.join(totals, list(subject))


def project_weights(
    attributed: DataFrame, declared: DataFrame, project: str, subject: str, sample: str, n_rows: int | None = None
) -> DataFrame:
    """Distinct samples and subjects per project; declared ones weigh nothing.

    A sample counts once per project and subject. Where the number of rows is
    given they are dealt out by it, and both groupings share that exchange.
    """
    kind = attributed.schema[sample].dataType
    rows = attributed.select(project, subject, sample, F.lit(1).alias("_w")).unionByName(
        declared.select(project, subject, F.lit(None).cast(kind).alias(sample), F.lit(0).alias("_w"))
    )
    if n_rows is not None:
        rows = dealt(rows, [project, subject], n_rows)
    pairs = rows.distinct().groupBy(project, subject).agg(F.sum("_w").alias("_w"))
    return pairs.groupBy(project).agg(
        F.sum("_w").alias("weight"), F.count(F.lit(1)).alias("n_subjects")
    )


def long_metrics(
    table: DataFrame, keys: Sequence[str], mapping: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """One row per key and mapped column; columns outside the map are dropped.

    ``mapping`` gives each source column its metric name and its kind,
    ``double`` or ``bigint``; text that is no such number is left out.
    """
    from tallymark.functions.values import as_number, as_whole

    entries = [
        F.struct(
            F.lit(metric).alias("metric"),
            (as_whole(F.col(f"`{column}`")).cast("double") if kind == "bigint"
             else as_number(F.col(f"`{column}`"))).alias("value"),
        )
        for column, (metric, kind) in mapping.items()
    ]
    return table.select(*keys, F.inline(F.array(*entries))).filter("value IS NOT NULL")


def merge_metrics(
    tables: Sequence[DataFrame], keys: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Outer merge of long metric tables into one wide row per key."""
    union = tables[0]
    for t in tables[1:]:
        union = union.unionByName(t)
    return union.groupBy(*keys).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )


def counts_disagree(df: DataFrame, counts: Sequence[str]) -> DataFrame:
    """Rows where at least two known counts differ."""
    known = F.array_distinct(F.array_compact(F.array(*[F.col(c).cast("bigint") for c in counts])))
    return df.filter(F.size(known) > 1)
