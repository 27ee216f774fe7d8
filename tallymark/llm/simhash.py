"""SimHash fingerprints, linked through the anchors of a covering code.

A fingerprint's first bits are cut into blocks, and the anchors are the products of
perfect codewords of the blocks: two Golay codes of 23 bits (covering radius 3) and
a Hamming code of 7 (radius 1). Every fingerprint is at home at its nearest anchor,
within the covering radius of each block. It is also sent to every anchor at which
a fingerprint at most ``THRESHOLD`` bits away can be at home: those within radius
plus threshold, the excess summed over the blocks. There it is compared with the
residents on all 64 bits. No link is missed, whatever bits differ, and every
fingerprint goes to about a hundred of 2**28 anchors.

Only distinct fingerprints are compared; copies are gathered beforehand.

Defined cases: a null text is an empty one and has no words. A text without words
has fingerprint zero and is linked like any other. Repeated rows give one result
row each; rows of one id with different texts have their own fingerprints. A null
id takes part, but is never the smallest unless its component has no other. An
empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import near_texts
from tallymark.llm.common import fresh, ship, shuffled, stored, text_key, tidy
from tallymark.llm.components import components

SHINGLE = 3
THRESHOLD = 2
SEED = 42
# Generator polynomials of perfect cyclic codes: (bits, polynomial, radius).
GOLAY = (23, 0b110001110101, 3)
HAMMING = (7, 0b1011, 1)
BLOCKS = (GOLAY, GOLAY, HAMMING)
# Fingerprints replicated at a time.
CHUNK = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' XXH64; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)], ">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, key (tells texts of one id apart) and fp (a signed long) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "key", "fp"])

    return rows.mapInArrow(tidy(compute), schema)


def nearby_errors(bits: int, polynomial: int, radius: int, slack: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Syndrome of each single bit, and for each excess 0..slack a table syndrome -> error patterns.

    A word minus such a pattern is a codeword at distance radius + excess, for an
    excess of 0 at most radius. Tables are padded with -1.
    """
    degree = polynomial.bit_length() - 1
    syndromes = []
    for i in range(bits):
        rest = 1 << i
        while rest.bit_length() > degree:
            rest ^= polynomial << (rest.bit_length() - 1 - degree)
        syndromes.append(rest)
    tables = []
    for excess in range(slack + 1):
        lists: list[list[int]] = [[] for _ in range(1 << degree)]
        for weight in range(radius + 1) if excess == 0 else [radius + excess]:
            for places in combinations(range(bits), weight):
                syndrome = error = 0
                for i in places:
                    syndrome ^= syndromes[i]
                    error |= 1 << i
                lists[syndrome].append(error)
        width = max(map(len, lists))
        tables.append(np.array([one + [-1] * (width - len(one)) for one in lists], np.int64).reshape(len(lists), width))
    return np.array(syndromes, np.int64), tables


class Anchors:
    """The anchors of fingerprints, by how far beyond the covering radius they are."""

    def __init__(self, blocks=BLOCKS, threshold: int = THRESHOLD):
        if sum(b[0] for b in blocks) > 63:
            raise ValueError("anchors hold 63 bits")
        self.blocks, self.threshold = blocks, threshold
        self.codes = [nearby_errors(*b, threshold) for b in blocks]

    def _block(self, part: np.ndarray, i: int) -> list[np.ndarray]:
        """Codewords by excess, a row for each fingerprint, padded with -1."""
        singles, tables = self.codes[i]
        syndrome = np.zeros(len(part), np.int64)
        for bit, one in enumerate(singles):
            syndrome ^= np.where(part >> bit & 1, one, 0)
        out = []
        for table in tables:
            errors = table[syndrome]
            out.append(np.where(errors < 0, -1, part[:, None] ^ errors))
        return out

    def near(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of fingerprint, anchor) for all anchors within reach; its home alone for a threshold of 0."""
        parts, shift, widths = [], 0, []
        for i, (bits, _, _) in enumerate(self.blocks):
            part = (fps >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)
            parts.append(self._block(part, i))
            shift += bits
            widths.append(bits)
        index, anchors = [], []
        for excess in product(range(self.threshold + 1), repeat=len(parts)):
            if sum(excess) > self.threshold:
                continue
            whole, valid, at = np.zeros((len(fps), 1), np.int64), np.ones((len(fps), 1), bool), 0
            for part, e, bits in zip(parts, excess, widths, strict=True):
                one = part[e]
                whole = (whole[:, :, None] | (one[:, None, :] << at)).reshape(len(fps), -1)
                valid = (valid[:, :, None] & (one[:, None, :] >= 0)).reshape(len(fps), -1)
                at += bits
            rows, columns = np.nonzero(valid)
            index.append(rows)
            anchors.append(whole[rows, columns])
        return np.concatenate(index), np.concatenate(anchors)


def links(prints: DataFrame, threshold: int = THRESHOLD, blocks=BLOCKS) -> DataFrame:
    """Pairs a < b of distinct fingerprints (column ``fp``) with at most ``threshold`` differing bits."""
    ship(prints.sparkSession)

    def sent(reach: int):
        def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors = Anchors(blocks, reach)
            for batch in batches:
                every = np.asarray(batch.column(0)).astype(np.int64)
                for first in range(0, len(every), CHUNK):
                    fps = every[first : first + CHUNK]
                    index, near = anchors.near(fps.view(np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(fps[index])], names=["anchor", "fp"])

        return prints.select("fp").mapInArrow(tidy(replicate), "anchor long, fp long")

    residents = sent(0).select("anchor", F.col("fp").alias("a"))
    visitors = sent(threshold).select("anchor", F.col("fp").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return residents.join(shuffled(visitors), "anchor").filter((F.col("a") < F.col("b")) & (apart <= threshold)).select("a", "b")


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE, threshold: int = THRESHOLD, blocks=BLOCKS) -> DataFrame:
    """doc_id, key, fp, root and component_id, the smallest doc_id reachable, of every row.

    ``root`` is the component's smallest fingerprint; it also tells components without ids apart.
    """
    rows = stored(fingerprints(docs, text, id_col, shingle), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(prints, threshold, blocks))
    # A fingerprint without links is its own root.
    rooted = prints.join(shuffled(roots), prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(shuffled(named), "root").select("fp", "root", "component_id")
    return rows.join(shuffled(by_print), "fp").select("doc_id", "key", "fp", "root", "component_id")


def hexadecimal(fp: Column) -> Column:
    """The fingerprint as 16 lower-case digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def print_links(rows: DataFrame) -> DataFrame:
    """Links a < b between the texts (``key``) of each component of fingerprints: the smallest one with each other one."""
    groups = rows.groupBy("root").agg(F.min("key").alias("a"), F.max("key").alias("most")).filter("a <> most")
    return rows.join(shuffled(groups), "root").filter("a <> key").select("a", F.col("key").alias("b")).distinct()


def one_of_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One document of each group of near texts, with its own columns: the row with the smallest id.

    Texts whose fingerprints are linked belong together, as in ``near_duplicates``. Texts
    that share four fifths of their five-word shingles (``near_texts``) may be further
    apart than two bits, so their links are added, and groups are the components of both.
    Rows that agree in id and text are one document.
    """
    rows = stored(near_duplicates(docs, text, id_col).select("doc_id", "key", "root"), "fingerprint-groups")
    near = near_texts.groups(docs, text, stored(print_links(rows), "fingerprint-links"))
    found = stored(rows.drop("root").join(shuffled(near), "key", "left").select("doc_id", "key", F.coalesce("root", "key").alias("root")), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    kept = found.groupBy("root").agg(F.min(order).alias("least")).select(F.col("least.doc_id").alias("kept_id"), F.col("least.key").alias("kept_key"))
    key, names = fresh(docs, "key"), docs.columns
    narrow = docs.withColumn(key, text_key(F.col(text)))
    chosen = narrow.join(shuffled(kept), F.col(id_col).eqNullSafe(F.col("kept_id")) & (F.col(key) == F.col("kept_key")), "left_semi")
    again = found.groupBy("doc_id", "key").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    if again:
        chosen = chosen.dropDuplicates([id_col, key])
    return chosen.select(*names)
