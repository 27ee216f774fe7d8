"""Token counts from pre-token frequencies, without token ids.

A text is cut into pre-tokens; how many tokens a pre-token becomes does not depend
on its place. So every task counts the pre-tokens of its documents, the distinct
ones are shuffled with a posting list (document, frequency), each is put through
the tokenizer's merges once where it arrives, and its count is joined to its
postings there. What goes back to the documents are sums.

* Pre-tokens that are one token, at most one per vocabulary entry, are counted on
  the spot; the commonest never travel.
* Pre-tokens are dealt into buckets by hash, PER_PARTITION for each shuffle partition;
  a row holds those of one batch of documents in one bucket.
* A pre-token in HOT documents or more of a batch is dealt out by batch as well, so
  no pre-token gathers in one task. It is then counted in several tasks.
* Sums go back in a row for each batch and task; what meets for a batch is at most a
  number for each of its postings.

Defined cases: a null text is an empty one, with no bytes and no tokens. Repeated
rows and rows without an id are counted one by one. Special strings in a text are
one token each, as the library takes them. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import ship

# The pre-tokens of a byte-level tokenizer; a fixed value of its file format.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Postings of one pre-token in a batch from which it is dealt out by batch.
HOT = 64
# Buckets of pre-tokens for each shuffle partition.
PER_PARTITION = 16
# Documents of a batch at most; a posting holds the place in 16 bits.
BATCH = 1 << 14
MOST = (1 << 16) - 1
# Pre-tokens and document sums that a task holds at once.
REMEMBERED = 1_000_000


def byte_letters() -> dict[int, str]:
    """Byte to letter: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceCounter:
    """Cuts texts into pre-tokens and counts the tokens of one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if "ByteLevel" not in str(tokenizer.pre_tokenizer) or tokenizer.normalizer is not None:
            raise ValueError("not a byte-level tokenizer without normalizer")
        self.model, self.letters = tokenizer.model, byte_letters()
        self.find = regex.compile(PIECES).findall
        special = [regex.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(special)) if special else None
        self.known: dict[str, int] = {}
        back = {letter: byte for byte, letter in self.letters.items()}
        self.single = set()
        for entry in tokenizer.get_vocab(with_added_tokens=False):
            if all(c in back for c in entry) and len(self.model.tokenize(entry)) == 1:
                try:
                    self.single.add(bytes(map(back.__getitem__, entry)).decode())
                except UnicodeDecodeError:
                    continue

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Pre-tokens with their number, and the number of special strings."""
        parts = self.special.split(text) if self.special and "<" in text else [text]
        return Counter(chain.from_iterable(map(self.find, parts))), len(parts) - 1

    def tokens(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            n = self.known[piece] = len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))
        return n


_COUNTERS: dict[str, PieceCounter] = {}


def _counter(path: str) -> PieceCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def _gathered(path: str, buckets: int, schema: pa.Schema):
    """Per batch of documents: one row with the documents, and one for each bucket of pre-tokens with their postings."""

    def postings_of(part: pa.RecordBatch, number: int) -> Iterator[pa.RecordBatch]:
        counter, postings, n_bytes, counted = _counter(path), {}, [], []
        for place, text in enumerate(part.column(1).to_pylist()):
            text = text or ""
            found, n = counter.frequencies(text)
            for piece, times in found.items():
                if piece in counter.single:
                    n += times
                    continue
                while times > MOST:
                    postings.setdefault(piece, []).append(place << 16 | MOST)
                    times -= MOST
                postings.setdefault(piece, []).append(place << 16 | times)
            n_bytes.append(len(text.encode()))
            counted.append(n)
        own = (None, number, None, None, None, part.column(0).to_pylist(), n_bytes, counted)
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(own, schema, strict=True)], schema=schema)
        if not postings:
            return
        pieces, lists = list(postings), list(postings.values())
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        hashes = np.fromiter((zlib.crc32(piece.encode()) for piece in pieces), np.int64, len(pieces))
        bucket = (hashes + np.where(sizes >= HOT, number * 40_503, 0)) % buckets
        order = np.argsort(bucket, kind="stable")
        names, first = np.unique(bucket[order], return_index=True)
        ordered = order.tolist()
        sizes = sizes[order]
        flat = np.fromiter(chain.from_iterable(lists[i] for i in ordered), "<u4", int(sizes.sum()))
        cuts = np.append(first, len(order)).astype(np.int32)
        ends = np.concatenate(([0], np.cumsum(sizes)))[cuts] * 4
        raw = flat.tobytes()
        columns = (
            names,
            np.full(len(names), number),
            pa.ListArray.from_arrays(cuts, pa.array([pieces[i] for i in ordered], pa.string())),
            pa.ListArray.from_arrays(cuts, pa.array(sizes, pa.int32())),
            [raw[i:j] for i, j in zip(ends, ends[1:], strict=False)],
        )
        arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)]
        arrays += [pa.nulls(len(names), f.type) for f in list(schema)[len(arrays) :]]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for first in range(0, whole.num_rows, BATCH):
                yield from postings_of(whole.slice(first, BATCH), number)
                number += 1

    return gather


def _summed(path: str, schema: pa.Schema):
    """Per task: each pre-token is counted once, its count goes to the sums of its documents."""

    def rows(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for number, one in sums.items():
            places = np.flatnonzero(one)
            values = number, places.astype("<u2").tobytes(), one[places].astype("<i8").tobytes(), None, None, None
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, sums = _counter(path), {}
        for batch in batches:
            documents = batch.filter(pc.is_null(batch.column(0)))
            if documents.num_rows:
                empty = pa.nulls(documents.num_rows, pa.binary())
                columns = [documents.column(1), empty, empty, *(documents.column(k) for k in (5, 6, 7))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            batch = batch.filter(pc.is_valid(batch.column(0)))
            if not batch.num_rows:
                continue
            pieces = batch.column(2).flatten().to_pylist()
            each = np.fromiter(map(counter.tokens, pieces), np.int64, len(pieces))
            lengths = batch.column(3).flatten().to_numpy()
            flat = np.frombuffer(b"".join(batch.column(4).to_pylist()), "<u4").astype(np.int64)
            values = (flat & MOST) * np.repeat(each, lengths)
            owner = np.repeat(np.repeat(batch.column(1).to_numpy(), batch.column(2).value_lengths().to_numpy()), lengths)
            order = np.argsort(owner, kind="stable")
            owner, places, values = owner[order], (flat >> 16)[order], values[order]
            cuts = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(owner)], strict=True):
                one = sums.setdefault(int(owner[a]), np.zeros(BATCH, np.int64))
                one += np.bincount(places[a:b], values[a:b], BATCH).astype(np.int64)
            if len(sums) * BATCH > REMEMBERED * 4:
                yield from rows(sums)
                sums = {}
        yield from rows(sums)

    return add


def _totals(schema: pa.Schema):
    """One batch of documents: what was counted on the spot, and the sums of all tasks."""

    def total(group: pa.Table) -> pa.Table:
        ids, n_bytes, counted = next((i, b, c) for i, b, c in zip(*(group[k].to_pylist() for k in ("ids", "n_bytes", "counted")), strict=True) if i is not None)
        tokens = np.array(counted, np.int64)
        for places, sums in zip(group["places"].to_pylist(), group["sums"].to_pylist(), strict=True):
            if places is not None:
                tokens[np.frombuffer(places, "<u2")] += np.frombuffer(sums, "<i8")
        return pa.table([pa.array(v, f.type) for v, f in zip((ids, n_bytes, tokens), schema, strict=True)], schema=schema)

    return total


def token_counts(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of the documents."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = rows.schema["id"].dataType
    long = T.LongType()
    many, longs = T.ArrayType(id_type), T.ArrayType(long)
    kinds = {
        "bucket": T.IntegerType(), "batch": long, "pieces": T.ArrayType(T.StringType()), "sizes": T.ArrayType(T.IntegerType()),
        "postings": T.BinaryType(), "places": T.BinaryType(), "sums": T.BinaryType(), "ids": many, "n_bytes": longs, "counted": longs,
    }
    fields = lambda *names: T.StructType([T.StructField(n, kinds[n]) for n in names])
    first = fields("bucket", "batch", "pieces", "sizes", "postings", "ids", "n_bytes", "counted")
    second = fields("batch", "places", "sums", "ids", "n_bytes", "counted")
    third = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_bytes", long), T.StructField("n_tokens", long)])
    buckets = PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = rows.mapInArrow(_gathered(path, buckets, to_arrow_schema(first)), first)
    # Rows of documents have no bucket and follow their batch.
    dealt = postings.repartition("bucket", F.when(F.col("bucket").isNull(), F.col("batch")))
    sums = dealt.mapInArrow(_summed(path, to_arrow_schema(second)), second)
    return sums.groupBy("batch").applyInArrow(_totals(to_arrow_schema(third)), third)
