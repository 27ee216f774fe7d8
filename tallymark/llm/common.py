"""Words of a text, tables kept in the shared folder, and names that do not clash."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words between ASCII white space.
SPACED = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
# Lower-case ASCII letters, digits and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="spark-shared-")
    return _OWN[context.applicationId]


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the Python workers, once for an application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read from there."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffled(frame: DataFrame) -> DataFrame:
    """The frame, as a side of a join for which both sides are shuffled.

    Spark sizes a table by its compressed files, whatever a Python step makes of a row. One
    that grows with the corpus may look small enough to be broadcast, and the driver would
    have to hold it whole.
    """
    return frame.hint("merge")


def short_batches(spark: SparkSession) -> None:
    """From now on the session reads Parquet files and feeds Python workers a few MB at a time.

    Spark's own limits are 4,096 rows, whatever their length, and 64 MB; each batch is held
    more than once, by the executor (beside its heap, too) and by the worker.
    """
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The work, for ``mapInArrow``; at its end the worker, which waits for other tasks, returns to the system what it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # only in glibc
            ctypes.CDLL(None).malloc_trim(0)

    return run


def fresh(frame: DataFrame, name: str) -> str:
    """The name, with underscores in front of it until no column has it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _split(text: Column, gap: str) -> Column:
    return F.array_remove(F.split(text, gap, -1), "")


def spaced_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for a null text."""
    return _split(F.coalesce(text, F.lit("")), SPACE)


def terms(text: Column) -> Column:
    """Runs of a-z, 0-9 and characters beyond ASCII, after lowering A-Z."""
    return _split(ascii_lower(F.coalesce(text, F.lit(""))), TERM_GAP)


def text_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def long_table(values: list[int]) -> Column:
    """A constant array of whole numbers, folded to one literal by the optimizer."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def settled(frame: DataFrame, kept: list[str], *results: Column) -> DataFrame:
    """The kept columns and the results, computed once a row.

    A filter on a result stays above: pushed below the columns that the result is
    made of, it would compute them again for every element of an array.
    """
    name = fresh(frame, "settled")
    once = frame.select(*kept, F.explode(F.array(F.struct(*results))).alias(name))
    return once.select(*kept, f"{name}.*")
