"""Token ids as binary blocks with Elias-Fano document boundaries.

Documents are dealt into shards by ranges of their id and sorted there. A shard is
a run of blocks; a block is one row of a Parquet table, so that any store Spark
writes to can hold it and a lost executor only repeats its own task:

    shard, block      place in the order
    before            ids of the shard's blocks before this one
    n_docs, n_ids     documents and token ids in the block
    width             bytes of an id, 2 where the vocabulary allows it, else 4
    ids               all ids of the block, little endian, one document after the other
    doc_ids           the documents' own ids
    low_bits, low, high, samples
                      n_docs + 1 offsets into ids, Elias-Fano coded

Blocks close once they hold BLOCK_IDS ids; a longer document is a block by itself.

Defined cases: a null text is an empty one, a document then has just the end id.
Null ids come first. Equal ids keep one entry a row, ordered by text, nulls
first. No documents give no blocks. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import ship, stored, tidy
from tallymark.llm.elias_fano import EliasFano

BLOCK_IDS = 1 << 18
# White space beyond what separates words here.
UNICODE_SPACE = regex.compile(r"[^\S ]|[\x1c-\x1f]")
# Words whose ids a Python worker remembers.
REMEMBERED = 1_000_000
# Documents whose words are learned together, where words are carried from task to task and
# where they are not, and words that go to the library at a time.
TOGETHER = 1_000
FEW = 200
LEARNED = 10_000


def block_schema(id_type: T.DataType) -> T.StructType:
    kinds = (
        ("shard", T.IntegerType()), ("block", T.IntegerType()), ("before", T.LongType()), ("n_docs", T.IntegerType()), ("n_ids", T.LongType()),
        ("width", T.IntegerType()), ("ids", T.BinaryType()), ("doc_ids", T.ArrayType(id_type)),
        ("low_bits", T.IntegerType()), ("low", T.BinaryType()), ("high", T.BinaryType()), ("samples", T.BinaryType()),
    )
    return T.StructType([T.StructField(name, kind) for name, kind in kinds])


class WordEncoder:
    """The library's ids of whole texts, looked up by word.

    Only for tokenizers that drop white space, so that ids of a text are those of
    its words one after the other. Words met before are looked up; the rest go to
    the library together.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.remembered, self.known, self.pieces = remembered, {}, {}

    def _learn(self, words: list[bytes]) -> None:
        """Normalise and split all words in one go, then run the model once for each new piece."""
        texts = [word.decode("utf-8", "replace") for word in words]
        joined = " ".join(texts)
        if any(a in joined for a in self.added) or UNICODE_SPACE.search(joined):
            odd = {i for i, text in enumerate(texts) if any(a in text for a in self.added) or UNICODE_SPACE.search(text)}
            for i in odd:
                ids = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
                self.known[words[i]] = array(self.code, ids).tobytes()
            words = [word for i, word in enumerate(words) if i not in odd]
            joined = " ".join(text for i, text in enumerate(texts) if i not in odd)
        if not words:
            return
        if self.tokenizer.normalizer is not None:
            joined = self.tokenizer.normalizer.normalize_str(joined)
        lengths = list(map(len, joined.split(" ")))
        if len(lengths) != len(words):
            raise ValueError("the normalizer changes white space")
        # Pieces come in order; a word ends where the next one begins.
        found, learned, own, last, end = self.pieces, [], [], 0, lengths[0]
        for piece, (at, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(joined):
            while at > end:
                learned.append(b"".join(own))
                own = []
                last += 1
                end += lengths[last] + 1
            ids = found.get(piece)
            if ids is None:
                ids = found[piece] = array(self.code, [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()
            own.append(ids)
        learned.append(b"".join(own))
        learned += [b""] * (len(words) - len(learned))
        self.known.update(zip(words, learned, strict=True))
        if len(found) > self.remembered:
            found.clear()

    def learn(self, texts: list[list[bytes]]) -> None:
        """Meet all words of the texts, each given as its words, at once."""
        words = set(chain.from_iterable(texts))
        new = list(words.difference(self.known))
        if new and len(self.known) + len(new) > self.remembered:
            self.known = {word: self.known[word] for word in words.intersection(self.known)}
        for first in range(0, len(new), LEARNED):
            self._learn(new[first : first + LEARNED])

    def forget(self) -> None:
        """Forget all words and pieces."""
        self.known, self.pieces = {}, {}

    def encode(self, text: bytes) -> bytes:
        """Ids of one text."""
        words = text.split()
        self.learn([words])
        return self.joined(words)

    def joined(self, words: list[bytes]) -> bytes:
        """Ids of words that have been learned."""
        return b"".join(map(self.known.__getitem__, words))


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def _encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """One encoder for a worker process, kept from task to task."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = WordEncoder(path, remembered)
    return _ENCODERS[path, remembered]


def _blocks(path: str, end_id: int, block_ids: int, schema: pa.Schema, remembered: int = REMEMBERED, carried: bool = True) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block = _encoder(path, remembered), TaskContext.get().partitionId(), 0
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        pieces, doc_ids, lengths, held, before = [], [], [], 0, 0
        together = TOGETHER if carried else FEW

        def full() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum(lengths)))
            n, low_bits, low, high, samples = EliasFano.encode(offsets)
            row = (shard, block, before, n - 1, int(offsets[-1]), encoder.width, b"".join(pieces), doc_ids, low_bits, low, high, samples)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for first in range(0, batch.num_rows, together):
                part = batch.slice(first, together)
                texts = [(one or b"").split() for one in part.column(1).cast(pa.binary()).to_pylist()]
                encoder.learn(texts)
                for doc_id, words in zip(part.column(0).to_pylist(), texts, strict=True):
                    piece = encoder.joined(words) + end
                    pieces.append(piece)
                    doc_ids.append(doc_id)
                    lengths.append(len(piece) // encoder.width)
                    held += lengths[-1]
                    if held >= block_ids:
                        yield full()
                        before += held
                        pieces, doc_ids, lengths, held = [], [], [], 0
                        block += 1
        if doc_ids:
            yield full()
        if not carried:
            encoder.forget()

    return write


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def token_blocks(docs: DataFrame, path: str, end_id: int, text: str = "text", id_col: str = "doc_id", block_ids: int = BLOCK_IDS, remembered: int = REMEMBERED, carried: bool = True) -> DataFrame:
    """The documents as blocks; one shuffle, by ranges of the id.

    A Python worker remembers the ids of ``remembered`` words at most, and of none from task
    to task where they are not ``carried``: other operators of the job then have its memory.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    schema = block_schema(rows.schema["id"].dataType)
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    write = _blocks(path, end_id, block_ids, _arrow(schema), remembered, carried)
    return ordered.mapInArrow(write if carried else tidy(write), schema)


def read_blocks(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in stored blocks.

    The blocks stay where they are: only the number of ids of each shard is summed
    up and broadcast, a row for each of the writer's tasks.
    """
    ship(blocks.sparkSession)
    id_type = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    wanted = blocks.join(F.broadcast(bases), "shard").select(
        (F.col("base") + F.col("before")).alias("first"), "n_docs", "width", "ids", "doc_ids", "low_bits", "low", "high", "samples"
    )
    arrow = _arrow(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                offsets = EliasFano(row["n_docs"] + 1, row["low_bits"], row["low"], row["high"], row["samples"]).all()
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4").tobytes()
                ends = (offsets * 4).tolist()
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                columns = row["doc_ids"], offsets[:-1] + row["first"], np.diff(offsets), sums
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return wanted.mapInArrow(tidy(read), schema)


def documents_of(blocks: DataFrame, asked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, start in its shard, n_tokens and ids (with the end id) of the asked documents in stored blocks.

    A document's ids are cut out of its block between two selected offsets; the other
    offsets stay as they are. A repeated id gives a row for each document that has it,
    asked for once or more; null ids and those no block holds give none.
    """
    ship(blocks.sparkSession)
    schema = T.StructType([
        T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())),
    ])
    wanted = asked.select(F.col(id_col).alias("doc_id")).distinct()
    places = blocks.select("shard", "block", F.posexplode("doc_ids").alias("place", "doc_id")).join(wanted, "doc_id", "left_semi")
    # No longer than the block's own list of ids.
    places = places.groupBy("shard", "block").agg(F.collect_list("place").alias("places"))
    found = blocks.join(places, ["shard", "block"]).select("before", "n_docs", "width", "ids", "doc_ids", "low_bits", "low", "high", "samples", "places")
    arrow = _arrow(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                offsets = EliasFano(row["n_docs"] + 1, row["low_bits"], row["low"], row["high"], row["samples"])
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype(np.int64)
                bounds = [(offsets.select(i), offsets.select(i + 1)) for i in row["places"]]
                columns = (
                    [row["doc_ids"][i] for i in row["places"]], [row["before"] + a for a, _ in bounds],
                    [b - a for a, b in bounds], [ids[a:b] for a, b in bounds],
                )
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return found.mapInArrow(cut, schema)


def written(docs: DataFrame, path: str, end_id: int, text: str = "text", id_col: str = "doc_id", remembered: int = REMEMBERED, carried: bool = True) -> DataFrame:
    """Blocks, written to the shared folder and read from there."""
    return stored(token_blocks(docs, path, end_id, text, id_col, remembered=remembered, carried=carried), "token-blocks")
