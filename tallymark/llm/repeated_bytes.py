"""Bytes of strings that stand elsewhere too, by prefix-free parsing.

A window is a string of WIDTH bytes. Its trigger is the place, among the first
WIDTH - KEY + 1, whose hash of eight bytes is least (the first of equals). It depends on
the window alone, so equal windows have it at the same distance. Triggers cut the texts
into phrases: those windows that share a trigger start in one stretch before it. Such a
stretch has a *phrase*, the bytes from its first start to the trigger, and a *right
side*, the bytes from the trigger to its last window's end. The phrases are the
dictionary, the right sides the suffixes of the parse.

* Only triggers whose first KEY bytes occur twice can have a repeated window; the others
  are left out by a count of hashes (a filter, it decides nothing else).
* Equal stretches (phrase and right side) are one; of those met twice all windows repeat.
* Two arrays are sorted over all different stretches: the phrases read backwards, which
  is the order of the dictionary's suffixes that end at a trigger, and the right sides,
  the suffix array of the parse. Common prefixes of neighbours give, for every stretch and
  depth, the interval of the array that agrees with it to that depth; an interval is named
  by its first place. The arrays are sorted in ranges; a range goes on with the intervals
  that were open at the end of the one before.
* A window with l bytes before the trigger is named by the dictionary's interval at depth
  l and the parse's at depth WIDTH - l. Together these are its interval in the suffix array
  of all texts; equal names are equal strings. Names met twice are repeats, at every place.

Counting is by hash aggregation and all joins are on keys with one row on one side, so a
passage that a third of all documents share is nowhere gathered in one task.

Defined cases: a null text is an empty one. Texts under WIDTH bytes lose nothing. Repeated
rows are copies of each other and lose all (from WIDTH bytes on). An empty table gives an
empty one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import ship, shuffled, stored, text_key

WIDTH = 200
KEY = 80
# Bytes that are hashed together, below 2**24.
TOGETHER = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def pieces_of(texts: list[bytes], together: int = TOGETHER) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, place, bytes) in lists of bounded length; a long text is cut so that each window is in one piece."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - WIDTH + 1, 0), together):
            piece = text[at : at + together + WIDTH - 1]
            if held and size + len(piece) > together:
                yield held
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
    if held:
        yield held


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def stretches(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """text, first start, trigger, last start and hash of the trigger's KEY bytes of every stretch."""
    sizes = np.array([len(p[2]) for p in pieces], np.int64)
    offsets = np.cumsum(sizes) - sizes
    buffer = b"".join(p[2] for p in pieces) + bytes(8)
    n = len(buffer) - 8
    eight = np.ndarray((n,), "<u8", buffer, strides=(1,))
    mixed = eight * _ODD[0]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _ODD[1]
    # The place stands in the last bits: the least value tells it, and the first of equals wins.
    least = (mixed & ~_PLACE) | np.arange(n, dtype=np.uint64)
    reach, wide = WIDTH - KEY + 1, 1
    while 2 * wide <= reach:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < reach:
        least = np.minimum(least[: len(least) - (reach - wide)], least[reach - wide :])
    start = _spread(offsets, sizes - WIDTH + 1)
    owner = np.repeat(np.arange(len(pieces)), sizes - WIDTH + 1)
    trigger = (least[start] & _PLACE).astype(np.int64)
    heads = np.flatnonzero(np.r_[True, (trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1])])
    ends = np.r_[heads[1:], len(start)] - 1
    t, owner = trigger[heads], owner[heads]
    key = np.zeros(len(t), np.uint64)
    for j in range(0, KEY, 8):
        key = (key ^ eight[t + j]) * _ODD[2]
        key ^= key >> np.uint64(31)
    shift = np.array([p[1] for p in pieces], np.int64)[owner] - offsets[owner]
    text = np.array([p[0] for p in pieces], np.int64)[owner]
    return text, start[heads] + shift, t + shift, start[ends] + shift, (key * _ODD[3]).view(np.int64)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [one or b"" for one in batch.column(column).cast(pa.binary()).to_pylist()]


def packed(texts: DataFrame) -> DataFrame:
    """The same rows, their texts compressed one by one for the way through a shuffle."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in texts.schema])
    at = texts.columns.index("text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            columns = batch.columns
            columns[at] = pa.array(list(map(compress, _texts(batch, at))), pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(compute, schema)


def _unpacked(batch: pa.RecordBatch, column: int) -> list[bytes]:
    decompress = zstandard.ZstdDecompressor().decompress
    return [decompress(one) for one in batch.column(column).to_pylist()]


def trigger_keys(texts: DataFrame) -> DataFrame:
    """key (of a text), trigger (hash of its KEY bytes) and n, how often it stands in the text; columns key, text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for pieces in pieces_of(_texts(batch, 1)):
                text, _, _, _, key = stretches(pieces)
                sort = np.lexsort((key, text))
                text, key = text[sort], key[sort]
                heads = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (key[1:] != key[:-1])])
                counts = np.diff(np.r_[heads, len(key)])
                yield pa.RecordBatch.from_arrays([pa.array(own[text[heads]]), pa.array(key[heads]), pa.array(counts, pa.int64())], names=["key", "trigger", "n"])

    return texts.mapInArrow(compute, "key long, trigger long, n long")


def found_stretches(texts: DataFrame) -> DataFrame:
    """The stretches at the wanted triggers: doc_id, key, first, trigger, last, name; columns doc_id, key, text (packed), wanted.

    The phrase read backwards and the right side stand where a batch meets a name for the first time.
    """
    id_type = texts.schema["doc_id"].dataType
    kinds = (("doc_id", id_type), ("key", T.LongType()), ("first", T.IntegerType()), ("trigger", T.IntegerType()), ("last", T.IntegerType()), ("name", T.BinaryType()), ("back", T.BinaryType()), ("ahead", T.BinaryType()))
    schema = T.StructType([T.StructField(*k) for k in kinds])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, lists = _unpacked(batch, 2), batch.column(3)
            lengths = np.asarray(lists.value_lengths(), np.int64)
            wanted = np.repeat(np.arange(len(every)), lengths).astype(np.uint64) * _ODD[1] ^ np.asarray(lists.flatten()).view(np.uint64)
            for pieces in pieces_of(every):
                text, first, trigger, last, key = stretches(pieces)
                # A chance hit here only brings a stretch too many.
                good = np.isin(text.astype(np.uint64) * _ODD[1] ^ key.view(np.uint64), wanted)
                text, first, trigger, last = (x[good] for x in (text, first, trigger, last))
                met, names, backs, aheads = set(), [], [], []
                for i, a, t, b in zip(text.tolist(), first.tolist(), trigger.tolist(), last.tolist(), strict=True):
                    one = every[i]
                    name = xxhash.xxh3_128_digest(one[a : b + WIDTH], t - a)
                    names.append(name)
                    new = name not in met
                    met.add(name)
                    backs.append(one[a:t][::-1] if new else None)
                    aheads.append(one[t : b + WIDTH] if new else None)
                places = pa.array(text)
                columns = [batch.column(0).take(places), batch.column(1).take(places), *(pa.array(x, pa.int32()) for x in (first, trigger, last)), *(pa.array(x, pa.binary()) for x in (names, backs, aheads))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.select("doc_id", "key", "text", "wanted").mapInArrow(compute, schema)


def common_prefixes(values: list[bytes]) -> np.ndarray:
    """Of every value with the one before; -1 for the first."""
    out = np.full(len(values), -1, np.int64)
    width = max(map(len, values), default=0)
    if len(values) > 1 and width:
        lengths = np.array([len(v) for v in values])
        padded = np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(len(values), width)
        differ = padded[1:] != padded[:-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[1:] = np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))
    elif len(values) > 1:
        out[1:] = 0
    return out


def intervals(values: DataFrame, least_depth: int = 0) -> tuple[DataFrame, dict[int, tuple[int, list[int], list[int]]]]:
    """The sorted array of the values (columns c, value): depths and names of the intervals of each c.

    A row's interval at depth d is named by the last of ``names`` whose ``depths`` is at most
    d, for depths from ``least_depth`` to ``most``, beyond which no other value agrees. The
    second result renames, by range, those that began in earlier ranges (see ``renamed``).
    """
    ship(values.sparkSession)
    ordered = values.select("value", "c").repartitionByRange("value", "c").sortWithinPartitions("value", "c")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = TaskContext.get().partitionId() << 40, 0
        open_depths, open_names = [], []
        head = tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(0).to_pylist()
            with_last = [tail, *rows] if tail is not None else rows
            same = common_prefixes(with_last)[-len(rows) :].tolist()
            head, tail = rows[0] if head is None else head, rows[-1]
            depths, names, most, ends = [], [], [], [0]
            for i, value in enumerate(rows):
                v = same[i]
                while open_depths and open_depths[-1] > v:
                    open_depths.pop()
                    open_names.pop()
                open_depths.append(v + 1)
                open_names.append(own + at)
                # Beyond its neighbours a value is alone; at the edges of batches and ranges that stays open.
                far = len(value) if i + 1 == len(rows) or v < 0 else min(len(value), max(v, same[i + 1]))
                most.append(far)
                a = 0
                while a + 1 < len(open_depths) and open_depths[a + 1] <= least_depth:
                    a += 1
                b = len(open_depths)
                while b > a and open_depths[b - 1] > far:
                    b -= 1
                depths.extend(open_depths[a:b])
                names.extend(open_names[a:b])
                ends.append(len(depths))
                at += 1
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, t)) for x, t in ((depths, pa.int32()), (names, pa.int64()))]
            none = pa.nulls(len(rows), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(most, pa.int32()), *lists, none, none], names=["c", "most", "depths", "names", "head", "tail"])
        if head is not None:
            # The range itself: its ends, and what is open at its end.
            columns = [pa.array(x, t) for x, t in (([own >> 40], pa.int64()), ([-1], pa.int32()), ([open_depths], pa.list_(pa.int32())), ([open_names], pa.list_(pa.int64())), ([head], pa.binary()), ([tail], pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["c", "most", "depths", "names", "head", "tail"])

    swept = stored(ordered.mapInArrow(sweep, "c long, most int, depths array<int>, names array<long>, head binary, tail binary"), "suffix-intervals")
    before, carried = None, {}
    for r in sorted(swept.filter("head is not null").collect(), key=lambda r: r["c"]):
        if before is not None:
            shared = int(common_prefixes([bytes(before["tail"]), bytes(r["head"])])[1])
            depths, names = renamed_steps(before["depths"], before["names"], before["c"], carried.get(before["c"]))
            carried[r["c"]] = (shared, depths, names)
        before = r
    return swept.filter("head is null").select("c", "most", "depths", "names"), carried


def renamed_steps(depths: list[int], names: list[int], part: int, earlier: tuple | None) -> tuple[list[int], list[int]]:
    """Steps in which the intervals open since before the range bear their first names."""
    if earlier is None or not names or names[0] != part << 40:
        return list(depths), list(names)
    shared, old_depths, old_names = earlier
    end = depths[1] if len(depths) > 1 else None
    out = [(d, n) for d, n in zip(old_depths, old_names, strict=True) if d <= shared and (end is None or d < end)]
    if end is None or end > shared + 1:
        out.append((shared + 1, names[0]))
    out += list(zip(depths[1:], names[1:], strict=True))
    return [d for d, _ in out], [n for _, n in out]


def named_windows(rows: DataFrame, before: dict, after: dict) -> DataFrame:
    """c, l, a and b: the two intervals of every window of each stretch that may repeat.

    Columns c, near and far (the least and greatest l), and for the dictionary (1) and the
    parse (2) most, depths and names; before and after rename their intervals.
    """

    def resolved(depths: np.ndarray, names: np.ndarray, carried: dict) -> tuple[np.ndarray, np.ndarray]:
        part = int(names[0]) >> 40 if len(names) else 0
        if part in carried and int(names[0]) == part << 40:
            shared, old_depths, old_names = carried[part]
            d, n = renamed_steps(depths.tolist(), names.tolist(), part, (shared, old_depths, old_names))
            return np.array(d, np.int64), np.array(n, np.int64)
        return depths, names

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, near, far, most_1, most_2 = (batch.column(i).to_numpy() for i in (0, 1, 2, 3, 6))
            low, high = np.maximum(near, WIDTH - most_2), np.minimum(far, most_1)
            out: list[list[np.ndarray]] = [[], [], [], []]
            for i in np.flatnonzero(low <= high):
                l = np.arange(low[i], high[i] + 1)
                sides = []
                for at, depth, carried in ((4, l, before), (7, WIDTH - l, after)):
                    depths, names = (np.asarray(batch.column(at + k)[i].values, np.int64) for k in (0, 1))
                    depths, names = resolved(depths, names, carried)
                    sides.append(names[np.searchsorted(depths, depth, side="right") - 1])
                for held, one in zip(out, (np.full(len(l), c[i]), l, *sides), strict=True):
                    held.append(one)
            columns = [np.concatenate(x) if x else np.array([], np.int64) for x in out]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int16(), pa.int64(), pa.int64()), strict=True)], names=["c", "l", "a", "b"])

    return rows.select("c", "near", "far", "most_1", "depths_1", "names_1", "most_2", "depths_2", "names_2").mapInArrow(compute, "c long, l short, a long, b long")


def repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, key and places of every document with repeated windows: structs of trigger, first and last, or the l of single windows."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text")).filter(F.octet_length("text") >= WIDTH)
    triggers = trigger_keys(texts.select("key", "text"))
    twice = stored(triggers.groupBy("trigger").agg(F.sum("n").alias("n")).filter("n > 1").select("trigger"), "repeated-triggers")
    wanted = stored(triggers.select("key", "trigger").join(shuffled(twice), "trigger").groupBy("key").agg(F.collect_set("trigger").alias("wanted")), "wanted-triggers")
    met = stored(found_stretches(packed(texts).join(shuffled(wanted), "key")), "stretches")
    one = met.groupBy("name").agg(
        F.count("*").alias("n"), F.min("back").alias("back"), F.min("ahead").alias("ahead"),
        F.min(F.col("trigger") - F.col("last")).alias("near"), F.min(F.col("trigger") - F.col("first")).alias("far"),
    )
    one = stored(one.withColumn("c", F.monotonically_increasing_id()), "different-stretches")
    dictionary, before = intervals(one.select("c", F.col("back").alias("value")))
    parse, after = intervals(one.select("c", F.col("ahead").alias("value")), KEY)
    both = one.select("c", "near", "far").join(shuffled(dictionary.toDF("c", "most_1", "depths_1", "names_1")), "c").join(shuffled(parse.toDF("c", "most_2", "depths_2", "names_2")), "c")
    windows = stored(named_windows(both, before, after), "named-windows")
    again = windows.groupBy("l", "a", "b").agg(F.count("*").alias("m")).filter("m > 1").select("l", "a", "b")
    single = windows.join(shuffled(stored(again, "repeated-windows")), ["l", "a", "b"]).groupBy("c").agg(F.collect_set("l").alias("single"))
    decided = one.select("name", "n", "c").join(shuffled(single), "c", "left").filter("n > 1 or single is not null")
    decided = stored(decided.select("name", F.when(F.col("n") == 1, F.col("single")).alias("single")), "decided-stretches")
    places = met.select("doc_id", "key", "name", "first", "trigger", "last").join(shuffled(decided), "name")
    return places.groupBy("doc_id", "key").agg(F.collect_set(F.struct("trigger", "first", "last", "single")).alias("places"))


def covered(n: int, places: list[dict]) -> np.ndarray:
    """Starts and ends of the removed runs of a text of n bytes."""
    edge = np.zeros(n + 1, np.int64)
    for p in places:
        if p["single"] is None:
            edge[p["first"]] += 1
            edge[p["last"] + WIDTH] -= 1
        else:
            starts = p["trigger"] - np.array(p["single"], np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + WIDTH, -1)
    inside = np.r_[False, np.cumsum(edge[:-1]) > 0, False]
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)


def without_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, spans (starts and ends of removed runs), n_removed and the kept bytes of every row."""
    ship(docs.sparkSession)
    found = stored(repeats(docs, text, id_col), "repeats")
    rows = packed(docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text")))
    held = found.withColumnsRenamed({"doc_id": "of", "key": "of_key"})
    joined = rows.join(shuffled(held), rows["key"].eqNullSafe(held["of_key"]) & rows["doc_id"].eqNullSafe(held["of"]), "left").select("doc_id", "text", "places")
    kinds = (("doc_id", rows.schema["doc_id"].dataType), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("spans", T.ArrayType(T.LongType())), ("kept", T.BinaryType()))
    schema = T.StructType([T.StructField(*k) for k in kinds])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for one, places in zip(_unpacked(batch, 1), batch.column(2).to_pylist(), strict=True):
                spans = covered(len(one), places) if places else np.zeros((0, 2), np.int64)
                at = [0, *spans.ravel().tolist(), len(one)]
                kept = b"".join(one[a:b] for a, b in zip(at[::2], at[1::2], strict=True))
                for held, value in zip(out, (len(one), len(one) - len(kept), at[1:-1], kept), strict=True):
                    held.append(value)
            columns = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return joined.mapInArrow(cut, schema)

