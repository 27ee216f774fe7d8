"""Groups of texts that share four fifths of their word shingles.

Two texts are near when the Jaccard similarity of their sets of SHINGLE-word shingles
is at least 4/5. Groups are the connected components of all such pairs, and no pair is
missed: with shingles in one order for all texts, two near sets of n and m shingles
share one of their first n - ceil(4n/5) + 1 and m - ceil(4m/5) + 1. Only those are
shuffled, as rows of 24 bytes, and only those that two texts share go on.

* Order: by hash, but shingles that many texts of a sample (one in SAMPLED) hold come
  last, so that a common passage does not bring its texts together. Any order is right;
  the sample only decides how many pairs are looked at.
* Stars: the smallest and the greatest text at each shared shingle are compared with all
  others there. A large group of near copies becomes one component without its pairs.
* Pairs: of what is left, two texts at one shingle are compared unless their components
  are the same already. Texts meet by bands of size, each its own and the next one, and
  one side must have the shingle among its first ninth: from its first common shingle on,
  the smaller of two near sets still holds 4(n + m)/9 members, at least 8/9 of its own.
  So small texts that differ in a word each do not meet at the words they share. Each
  brings a sketch of MEETING bits, so that texts with one passage in common are told
  apart where they meet, and are no pairs.
* Sizes and parity sketches rule most pairs out before a text is looked at. Neither loses
  a near pair: a sketch has a bit for the parity of the shingles that fall on it, so
  sketches differ in no more bits than the sets in members. Sketches grow with the set;
  a larger one folds onto a smaller one.
* What remains is verified on the whole sets.

Defined cases: words stand between ASCII white space, A-Z in lower case. A text of fewer
words is one shingle; texts without words, null ones too, are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import ship, shuffled, stored, text_key, tidy
from tallymark.llm.components import components

SHINGLE = 5
# Bytes of text that are hashed together.
TOGETHER = 1 << 18
# Texts of a batch that are worked on at a time.
PORTION = 500
# Bits of the smallest sketch.
SKETCH = 512
# Bits of the sketch that a text takes along to where it meets others; whole longs.
MEETING = 256
SAMPLED = 16
OFTEN = 4
MOST_OFTEN = 200_000

_WORD_BYTES = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
SHORT = [f"short{j}" for j in range(MEETING // 64)]
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_NO_WORDS = np.uint64(0x2545F4914F6CDD1D)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and of its inverse."""
    base = int(_ODD[3])
    return tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)]) for b in (base, pow(base, -1, 1 << 64)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[1]
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one after the other, and the number of words of each text."""
    joined = b" ".join([*texts, b""]).translate(_WORD_BYTES)
    letters = np.frombuffer(joined, np.uint8)
    inside = np.r_[False, letters != 32, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(TOGETHER.bit_length(), len(joined).bit_length())
    powers, inverse = _powers(size)
    running = np.r_[np.uint64(0), np.cumsum(letters * powers[: len(joined)], dtype=np.uint64)]
    words = (running[ends] - running[starts]) * inverse[starts]
    words = _mixed(words ^ (ends - starts).astype(np.uint64) * _ODD[2])
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return words, np.bincount(np.searchsorted(bounds, starts, side="right"), minlength=len(texts))


def shingle_sets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, ascending distinct shingle hashes) of every text."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= TOGETHER):
            size += len(texts[last])
            last += 1
        words, counts = word_hashes(texts[first:last])
        ends = np.cumsum(counts)
        rolled = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
        for j in range(SHINGLE):
            rolled = _mixed((rolled ^ words[j : j + len(rolled)]) * _ODD[0])
        for i, (n, end) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
            if n >= SHINGLE:
                yield first + i, np.unique(rolled[end - n : end - SHINGLE + 1])
            elif n:
                one = np.array([n], np.uint64)
                for w in words[end - n : end]:
                    one = _mixed((one ^ w) * _ODD[0])
                yield first + i, one
            else:
                yield first + i, np.array([_NO_WORDS])
        first = last


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Similarity of at least 4/5."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def sketch(members: np.ndarray) -> bytes:
    """Parities of the members by their last bits; the number of bits is a power of two that grows with them."""
    bits = max(SKETCH, 1 << (len(members) // 2).bit_length())
    return np.packbits(parities(members, bits), bitorder="little").tobytes()


def parities(members: np.ndarray, bits: int) -> np.ndarray:
    """Of each of that many places, whether an odd number of members falls on it by its last bits."""
    return (np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)


def apart(a: bytes, b: bytes) -> int:
    """A number of members in which the two sets differ at least."""
    short, long = sorted((a, b), key=len)
    folded = int.from_bytes(long, "little")
    n = len(long)
    while n > len(short):
        n //= 2
        folded = folded >> 8 * n ^ folded & (1 << 8 * n) - 1
    return (folded ^ int.from_bytes(short, "little")).bit_count()


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut into PORTION rows, so that a worker never holds copies and shingles of a whole batch."""
    for batch in batches:
        for first in range(0, batch.num_rows, PORTION):
            yield batch.slice(first, PORTION)


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    return shingle_sets([one or b"" for one in batch.column(1).cast(pa.binary()).to_pylist()])


def signatures(texts: DataFrame) -> DataFrame:
    """key, size, sketch and the short sketch (longs named by SHORT) of every different text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sizes, sketches, short = [], [], np.zeros((batch.num_rows, MEETING), np.uint8)
            for i, every in _sets_of(batch):
                sizes.append(len(every))
                sketches.append(sketch(every))
                short[i] = parities(every, MEETING)
            longs = np.packbits(short, axis=1, bitorder="little").view(np.int64)
            columns = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(longs[:, j]) for j in range(len(SHORT)))], names=["key", "size", "sketch", *SHORT])

    schema = ", ".join(["key long, size int, sketch binary", *(f"{c} long" for c in SHORT)])
    return texts.select("key", "text").mapInArrow(tidy(compute), schema).dropDuplicates(["key"])


def _posted(texts: DataFrame, last: np.ndarray | None) -> DataFrame:
    """shingle, key, place (in the order) and size (of the set): all shingles of each text, or the first ones where ``last`` come after all others."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in portions(batches):
            keys, own, found, place, size = batch.column(0).to_pylist(), [], [], [], []
            for i, every in _sets_of(batch):
                if keys[i] in met:
                    continue
                met.add(keys[i])
                n = len(every)
                if last is not None:
                    often = last[np.searchsorted(last, every).clip(0, len(last) - 1)] == every if len(last) else np.zeros(len(every), bool)
                    if often.any():
                        every = np.concatenate((every[~often], every[often]))
                    every = every[: len(every) - -(-4 * len(every) // 5) + 1]
                found.append(every.view(np.int64))
                own.append(np.full(len(every), keys[i]))
                place.append(np.arange(len(every), dtype=np.int32))
                size.append(np.full(len(every), n, np.int32))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, own, place, size)], names=["shingle", "key", "place", "size"])

    return texts.select("key", "text").mapInArrow(tidy(compute), "shingle long, key long, place int, size int")


def often_shared(texts: DataFrame) -> np.ndarray:
    """Shingles that at least OFTEN texts of the sample hold, ascending; the MOST_OFTEN commonest."""
    sample = _posted(texts.filter(F.pmod(F.col("key"), F.lit(SAMPLED)) == 0), None).select("shingle", "key").distinct()
    counts = sample.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN)
    found = counts.orderBy(F.desc("n"), "shingle").limit(MOST_OFTEN).collect()
    return np.sort(np.array([r["shingle"] for r in found], np.int64).view(np.uint64))


def at_shingles(texts: DataFrame, last: np.ndarray) -> DataFrame:
    """shingle, key, place and size, of the shingles among the first of two texts or more."""

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row so far, and whether it has been given out.
        held, given = None, True
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            if held is not None:
                columns = [np.r_[x, y] for x, y in zip(held, columns, strict=True)]
            shingle, key = columns[:2]
            if not len(shingle):
                continue
            kept = np.flatnonzero(np.r_[True, (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])])
            columns = [x[kept] for x in columns]
            alike = columns[0][1:] == columns[0][:-1]
            good = np.r_[False, alike] | np.r_[alike, False]
            out = good.copy()
            if held is not None:
                out[0] &= not given
                good[0] |= given
            held, given = [x[-1:] for x in columns], bool(good[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in columns], names=batch.schema.names)

    dealt = _posted(texts, last).repartition("shingle").sortWithinPartitions("shingle", "key")
    return dealt.mapInArrow(tidy(shared), "shingle long, key long, place int, size int")


def meeting(rest: DataFrame) -> DataFrame:
    """Pairs (a, b) of different roots that may be near, by their common first shingle; columns shingle, key, place, size, root and SHORT."""
    # Near texts differ in size by a quarter at most: the same band of size, or the next one.
    banded = rest.withColumn("band", F.floor(F.log(F.col("size")) / math.log(1.25)).cast("int"))
    columns = ("shingle", "key", "place", "size", "root", "band", *SHORT)
    # The smaller one has the shingle among its first ninth.
    small = banded.filter("9 * place <= size").select(*[F.col(c).alias(f"{c}_a") for c in columns])
    large = banded.select(*[F.col(c).alias(f"{c}_b") for c in columns])
    enough = F.expr("size_a <= size_b and 5 * size_a >= 4 * size_b and 9 * least(size_a - place_a, size_b - place_b) >= 4 * (size_a + size_b)")
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SHORT), F.lit(0))
    enough &= 9 * differ <= F.col("size_a") + F.col("size_b")
    met = None
    for step in (0, 1):
        same = (F.col("shingle_a") == F.col("shingle_b")) & (F.col("band_a") + step == F.col("band_b"))
        pairs = small.join(shuffled(large), same & (F.col("root_a") != F.col("root_b")) & enough)
        pairs = pairs.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
        met = pairs if met is None else met.unionByName(pairs)
    return met.distinct()


def likely(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs (a, b) that neither sizes nor sketches rule out."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            left, right = (batch.column(i).to_pylist() for i in (4, 5))
            good = [9 * apart(x, y) <= n for x, y, n in zip(left, right, sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    one, two = (signs.select(F.col("key").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
    both = pairs.join(shuffled(one), "a").join(shuffled(two), "b").filter(F.least("size_a", "size_b") * 5 >= F.greatest("size_a", "size_b") * 4)
    return both.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(tidy(compare), "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose texts are near."""
    asked = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "asked-keys")
    found = stored(texts.join(shuffled(asked), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text")), "asked-texts")
    one, two = (found.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(64)(lambda text: next(shingle_sets([text]))[1])
        for batch in batches:
            left, right = (batch.column(i).cast(pa.binary()) for i in (2, 3))
            good = [near(known(x.as_py() or b""), known(y.as_py() or b"")) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(shuffled(one), "a").join(shuffled(two), "b").select("a", "b", "text_a", "text_b").mapInArrow(tidy(compare), "a long, b long")


def groups(docs: DataFrame, text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """key (of a text) and root, the smallest key of its component, of every text near another one.

    ``known`` are links (a, b) of keys found otherwise; they count as well, and texts they bring together are not compared.
    """
    ship(docs.sparkSession)
    texts = docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    places = stored(at_shingles(texts, often_shared(texts)), "shared-shingles")
    signs = stored(signatures(texts).join(shuffled(places.select("key").distinct()), "key", "left_semi"), "signatures")
    ends = places.groupBy("shingle").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count("*").alias("n"))
    stars = places.join(shuffled(ends), "shingle").select("key", F.explode(F.array("least", "most")).alias("end")).filter("key <> end")
    stars = stars.select(F.least("key", "end").alias("a"), F.greatest("key", "end").alias("b")).distinct()
    links = stored(verified(stored(likely(stars, signs), "star-pairs"), texts), "star-links")
    if known is not None:
        links = links.unionByName(known)
    roots = stored(components(links), "star-roots")
    # Where only two texts stand they have been compared.
    rest = places.join(shuffled(ends.filter("n > 2").select("shingle")), "shingle")
    rest = rest.join(shuffled(roots.toDF("key", "root")), "key", "left").withColumn("root", F.coalesce("root", "key"))
    rest = rest.join(shuffled(signs.select("key", *SHORT)), "key")
    others = stored(likely(meeting(stored(rest, "rooted-shingles")), signs), "other-pairs")
    more = stored(verified(others, texts), "other-links")
    return components(links.unionByName(more)).toDF("key", "root")
