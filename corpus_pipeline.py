"""From raw documents to token files: five stages, each written and read again.

Every stage works on all that its predecessor kept; all but the last return the
columns of the documents they are given. Rows of the last: one for each document of
the mix, in the order of the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import decontaminate, mixing, quality, queries, simhash, token_files
from tallymark.llm.common import short_batches, stored


# Words whose ids a Python worker remembers in a task; the stages share the workers.
REMEMBERED = 150_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio; others go."""
    short_batches(spark)
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with linked fingerprints or four fifths of their five-word shingles in common: the one with the smallest id."""
    short_batches(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark's windows cover less than a twentieth."""
    short_batches(spark)
    return decontaminate.clean_documents(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times."""
    short_batches(spark)
    return mixing.taken_copies(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks, written; what is read back from them of every document."""
    short_batches(spark)
    vocabulary = queries.vocabulary(queries.TOKEN_FILE_VOCABULARY)
    blocks = token_files.written(docs, vocabulary, queries.END_ID, remembered=REMEMBERED, carried=False)
    return token_files.read_blocks(blocks)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token output", token_output),
]
# Hashes, components and tokenizers are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
