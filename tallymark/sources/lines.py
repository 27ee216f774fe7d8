"""Text files as numbered lines and separated fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.text import strip
from tallymark.operators.ranking import STRETCH, numbered, segment_by_marker
from tallymark.session import cut


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, line, value)`` with 1-based line numbers.

    Files stay splittable: lines are numbered per file block and shifted by
    the line counts of the blocks before. The lines are written out once,
    because two scans need not cut a file into the same blocks.
    """
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )
    return (
        numbered(cut(raw), ["path"], [F.col("_block")], ["_id"], out="line")
        .select("path", F.col("line").cast("int").alias("line"), "value")
    )


# Whole fields of a line and then one whose quote does not end in it.
_OPENS = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+$'
# The rest of a quoted field that began in an earlier line.
_CLOSES = r'^[^"]*+(?:""[^"]*+)*+"[^,]*+,?'
# Characters of a record over several lines; a quote that never ends would swallow its file.
LONGEST = 131_072


def quoted_records(lines: DataFrame, keys: Sequence[str], stretch: int = STRETCH, longest: int = LONGEST) -> DataFrame:
    """Records of ``keys, line, value`` whose quoted fields may hold line ends.

    ``line`` of the result is the number of the record; ``whole`` is false for a record
    beyond ``longest`` characters, of which the first line is kept.

    Whether a line begins inside quotes follows from the lines before it: each sends
    the states (outside, inside) to states, so a line leaves them, swaps them or ends in
    the same state from both. The state before a line is that of the last line of the
    third kind, turned over once for each swap since. Both are running values, taken per
    stretch of lines and carried over the stretches, so files of any size stay split.
    """
    keys = list(keys)
    bit = lambda c: c.cast("int")
    from_outside = F.col("value").rlike(_OPENS)
    closed = F.regexp_replace("value", _CLOSES, "")
    from_inside = ~F.col("value").rlike(_CLOSES) | closed.rlike(_OPENS)
    moved = lines.select(
        *keys, "line", "value", F.floor(F.col("line") / stretch).alias("_piece"),
        bit(from_outside & ~from_inside).alias("_swap"), F.when(from_outside == from_inside, bit(from_outside)).alias("_ends"),
    )
    here = W.partitionBy(*keys, "_piece").orderBy("line")
    upto, before = (here.rowsBetween(W.unboundedPreceding, n) for n in (0, -1))
    # Where a state is certain it is noted as it would be without the swaps so far.
    moved = moved.withColumn("_swaps", F.sum("_swap").over(upto)).withColumn("_base", F.col("_ends").bitwiseXOR(bit(F.col("_swaps") % 2)))
    moved = moved.withColumn("_last", F.last("_base", ignorenulls=True).over(before))
    pieces = moved.groupBy(*keys, "_piece").agg(F.sum("_swap").alias("_n"), F.max_by("_base", F.when(F.col("_base").isNotNull(), F.col("line"))).alias("_b"))
    earlier = W.partitionBy(*keys).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("_turn", bit(F.coalesce(F.sum("_n").over(earlier), F.lit(0)) % 2))
    pieces = pieces.withColumn("_carry", F.last(F.col("_b").bitwiseXOR(F.col("_turn")), ignorenulls=True).over(earlier)).drop("_n", "_b")
    state = F.coalesce(F.col("_last").bitwiseXOR(F.col("_turn")), F.col("_carry"), F.lit(0)).bitwiseXOR(
        bit((F.col("_swaps") - F.col("_swap") + F.col("_turn")) % 2)
    )
    told = moved.join(pieces, [*keys, "_piece"]).select(*keys, "line", "value", state.alias("_inside"))
    told = segment_by_marker(told, keys, "line", F.col("_inside") == 0, "_record", stretch)
    several = told.groupBy(*keys, "_record").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.length("value") + 1).alias("_size")).filter("_n > 1")
    told = told.join(several.drop("_n"), [*keys, "_record"], "left")
    inside = F.array_sort(F.collect_list(F.struct("line", "value")))
    joined = told.filter(F.col("_size") <= longest).groupBy(*keys, "_record").agg(F.array_join(F.transform(inside, lambda x: x["value"]), "\n").alias("value"))
    first = told.filter("_size IS NULL OR _size > " + str(longest)).filter("line = _record")
    every = first.select(*keys, "_record", "value", F.col("_size").isNull().alias("whole")).unionByName(joined.withColumn("whole", F.lit(True)))
    records = numbered(every, keys, [F.floor(F.col("_record") / stretch)], ["_record"], out="line")
    return records.select(*keys, F.col("line").cast("int").alias("line"), "value", "whole")


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, content)``, one row per file, for small documents."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.regexp_replace("value", "^﻿", "").alias("content"),
    )


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, size)`` of every file with content; contents are not read.

    File scans pass over empty files, so only a listing table shows those.
    """
    return spark.read.format("binaryFile").load(paths).select(
        "path", F.col("length").alias("size")
    )


def with_subject(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``subject`` (``clade/slug``) from a ``.../clade/slug/file`` path."""
    parts = F.split(F.col(path), "/")
    return df.withColumn(
        "subject", F.concat_ws("/", F.element_at(parts, -3), F.element_at(parts, -2))
    )


def comma_fields(line: Column) -> Column:
    """Fields of one comma-separated line, quotes removed."""
    # With a comma in front, every field starts with one, empty ones too.
    quoted = F.regexp_extract_all(
        F.concat(F.lit(","), line), F.lit(',("[^"]*+(?:""[^"]*+)*+"|[^,]*)'), F.lit(1)
    )
    return F.transform(
        quoted,
        lambda f: F.when(
            f.startswith('"') & f.endswith('"') & (F.length(f) > 1),
            F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )


def tab_fields(line: Column) -> Column:
    return F.split(line, "\t", -1)


def trimmed(fields: Column) -> Column:
    return F.transform(fields, strip)


def is_blank(fields: Column) -> Column:
    return F.forall(fields, lambda f: strip(f) == "")


def last_index(header: Column, name: Column) -> Column:
    """0-based position of the last header cell with a name; null if none."""
    back = F.array_position(F.reverse(header), name)
    return F.when(back > 0, (F.size(header) - back).cast("int"))


def cell(header: Column, fields: Column, name: str) -> Column:
    """Trimmed cell under a header name; empty when the row or table lacks it."""
    value = F.get(fields, last_index(header, F.lit(name)))
    return F.coalesce(strip(value), F.lit(""))


def as_map(header: Column, fields: Column) -> Column:
    """Header names to trimmed cells, short rows padded with empty cells."""
    last = F.transform(
        header,
        lambda name, i: F.struct(
            name.alias("name"),
            F.coalesce(strip(F.get(fields, i)), F.lit("")).alias("value"),
            i.alias("i"),
        ),
    )
    kept = F.filter(last, lambda e: e["i"] == last_index(header, e["name"]))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["name"], e["value"])))


def headed(
    lines: DataFrame, keys: Sequence[str], split=tab_fields, *, first_line_only: bool = False
) -> DataFrame:
    """Rows below each file's header: ``keys``, ``line``, ``header``, ``fields``.

    The header is the first line, or the first one that is not blank; blank
    lines below are kept for the caller to judge.
    """
    candidates = lines.filter("line = 1") if first_line_only else lines.filter(strip(F.col("value")) != "")
    header = candidates.groupBy(*keys).agg(
        F.min("line").alias("_at"), F.min_by("value", "line").alias("_h")
    )
    return (
        lines.join(header, list(keys))
        .filter("line > _at")
        .select(
            *keys,
            "line",
            trimmed(split(F.col("_h"))).alias("header"),
            split(F.col("value")).alias("fields"),
        )
    )
