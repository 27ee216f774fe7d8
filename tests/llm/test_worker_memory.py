"""What a Python worker of the pipeline holds while it works, and what it keeps for the next task."""

import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tallymark.llm import near_texts, queries, token_files  # noqa: E402
from tallymark.llm.common import tidy  # noqa: E402


class Frame:
    """Keeps the function that a frame is mapped with."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        self.function = function
        return self

    def dropDuplicates(self, columns):
        return self


def test_near_texts_do_not_hold_copies_of_a_whole_batch():
    texts = [" ".join(f"w{i * j % 9973}" for j in range(300)) for i in range(1, 8001)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["key", "text"])
    for made in (near_texts.signatures(Frame()), near_texts._posted(Frame(), None)):
        tracemalloc.start()
        rows = sum(out.num_rows for out in made.function(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= len(texts)
        assert peak < 30e6


def test_words_are_not_carried_to_the_next_task(monkeypatch):
    monkeypatch.setattr(token_files, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(token_files, "_ENCODERS", {})
    path, schema = queries.vocabulary(queries.TOKEN_FILE_VOCABULARY), token_files._arrow(token_files.block_schema(T.LongType()))
    texts = [f"word{i} other{i}, end" for i in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])

    def ids(*more):
        return b"".join(out.column(6)[0].as_py() for out in token_files._blocks(path, 2, token_files.BLOCK_IDS, schema, *more)(iter([batch])))

    every, few = ids(), ids(6000, False)
    assert every == few
    assert len(token_files._encoder(path).known) == 10_001
    lean = token_files._encoder(path, 6000)
    assert len(lean.known) <= 2001
    assert not lean.pieces


def test_common_words_are_not_forgotten_with_the_others():
    encoder, met = token_files.WordEncoder(queries.vocabulary(queries.TOKEN_FILE_VOCABULARY), 100), []
    learn = encoder._learn
    encoder._learn = lambda words: (met.extend(words), learn(words))
    for i in range(200):
        encoder.encode(b"common word%d" % i)
    assert met.count(b"common") == 1
    assert len(encoder.known) <= 100


def test_no_word_is_kept_for_the_next_task(monkeypatch):
    monkeypatch.setattr(token_files, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(token_files, "_ENCODERS", {})
    path, schema = queries.vocabulary(queries.TOKEN_FILE_VOCABULARY), token_files._arrow(token_files.block_schema(T.LongType()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array([f"word{i} other{i}, end" for i in range(900)])], names=["id", "text"])
    assert sum(out.column(3)[0].as_py() for out in token_files._blocks(path, 2, 1000, schema, 6000, False)(iter([batch]))) == 900
    assert not token_files._encoder(path, 6000).known


def test_every_stage_feeds_python_workers_little_at_a_time(spark, monkeypatch):
    for module, name in (("quality", "keep_good"), ("simhash", "one_of_each"), ("decontaminate", "clean_documents"), ("mixing", "taken_copies"), ("token_files", "written")):
        monkeypatch.setattr(getattr(corpus_pipeline, module), name, lambda docs, *a, **b: docs)
    monkeypatch.setattr(token_files, "read_blocks", lambda blocks: blocks)
    docs = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    limits = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    try:
        for _, stage in corpus_pipeline.STAGES:
            for limit in limits:
                spark.conf.unset(limit)
            got = stage(spark, docs, "/root/testdata/sf0.001").mapInArrow(tidy(sizes), "n long, size long").collect()
            assert sum(r["n"] for r in got) == 4000
            assert max(r["size"] for r in got) < 3e6
    finally:
        for limit in limits:
            spark.conf.unset(limit)
