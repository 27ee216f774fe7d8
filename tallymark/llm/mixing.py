"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words: its weight's share of the whole, at
most ``MOST_COPIES`` times its size; what is cut off goes to the others by weight
until none is above. A document should then be taken target / source size times,
which is a whole number of copies and a fractional copy probability.

Probabilities are made whole in pairs: between two documents of a source mass moves
at random, one way or the other, until one of them is certain; words expected from
the pair do not change, nor does either's expectation. So a source's words are its
target, up to the one document that is left over at the end.

The pairs form a reduction tree. Leaves are LEAF documents of one source, dealt by
hash; each leaves one document undecided at most, and FAN_IN leaves meet in the
next level, until each source has one group. A source of any size is spread over
as many groups as it needs. All chance comes from hashes, so reruns agree.

Defined cases: a null or empty text has size 0 and is never taken. A null source is
a source of its own, the last in order. Rows that agree in id, source and text share
one decision, and count as one document of all their words. With an empty table, or
no words at all, targets are 0. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import ship, shuffled, spaced_words, stored, text_key

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3.0
LEAF = 4096
FAN_IN = 64
SEED = 7
# Probabilities this close to 0 or 1 are certain.
CERTAIN = 1e-9


def sized(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, source, key and size in words of every row."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source).alias("source"),
        text_key(F.col(text)).alias("key"),
        F.size(spaced_words(F.col(text))).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, n_docs and target; windows run over one row a source.

    Sources by the number of words that fills them up, relative to their weight:
    those that a level of words per weight would overfill come first, so the level
    of the first that is not overfull holds for it and all after it.
    """
    whole = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    share = F.array(*map(F.lit, weights))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per = per.withColumn("weight", F.get(share, (F.row_number().over(by_name) - 1) % len(weights)))
    per = per.withColumn("most", F.col("source_size") * F.lit(most))
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    left = F.sum(F.col("source_size").cast("double")).over(whole) - earlier("most")
    per = per.withColumn("level", left / (F.sum("weight").over(whole) - earlier("weight"))).withColumn("place", F.row_number().over(filling))
    fits = F.when(F.col("most") > F.col("weight") * F.col("level"), F.struct("place", "level"))
    per = per.withColumn("first", F.min(fits).over(whole))
    target = F.when(F.col("place") < F.coalesce(F.col("first.place"), F.col("place") + 1), F.col("most")).otherwise(F.col("weight") * F.col("first.level"))
    return per.select("source", "source_size", "n_docs", F.least(target, F.col("most")).alias("target"))


def pivot(weight: np.ndarray, chance: np.ndarray, luck: np.ndarray) -> np.ndarray:
    """Make all chances 0 or 1 but one at most, keeping sum(weight * chance); luck is one number in [0, 1) each."""
    p = chance.astype(float).copy()
    held = -1
    for j in range(len(p)):
        if not CERTAIN < p[j] < 1 - CERTAIN:
            p[j] = round(p[j])
            continue
        if held < 0:
            held = j
            continue
        i, a, b = held, weight[held], weight[j]
        up, down = min((1 - p[i]) * a, p[j] * b), min(p[i] * a, (1 - p[j]) * b)
        moved = up if luck[j] * (up + down) < down else -down
        p[i] += moved / a
        p[j] -= moved / b
        for k in (i, j):
            if not CERTAIN < p[k] < 1 - CERTAIN:
                p[k] = round(p[k])
        held = next((k for k in (i, j) if 0 < p[k] < 1), -1)
    return p


def _reduced(rows: pa.Table) -> pa.Table:
    """One group of one source; ``luck`` orders the rows, so that the outcome does not hang on their arrival."""
    rows = rows.sort_by([("luck", "ascending"), ("key", "ascending"), ("size", "ascending")])
    weight, chance, luck = (rows[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("weight", "chance", "luck"))
    even = (luck.astype(np.int64).view(np.uint64) >> np.uint64(11)) / 2.0**53
    return rows.set_column(rows.schema.get_field_index("chance"), "chance", pa.array(pivot(weight, chance, even)))


def decided(rows: DataFrame, weights=WEIGHTS, most: float = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """doc_id, source, key, size, source_size, target and copies of every distinct document.

    ``rows`` comes from ``sized``. Each level is written to the shared folder.
    """
    ship(rows.sparkSession)
    targets = stored(source_targets(rows, weights, most), "source-targets")
    units = rows.groupBy("doc_id", "source", "key", "size").agg(F.count("*").alias("rows"))
    t = targets.withColumnRenamed("source", "of")
    units = units.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    times = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    groups = F.ceil(F.col("n_docs") / LEAF)
    luck = F.xxhash64(F.lit(seed), "doc_id", "key", "source")
    level = units.select(
        "doc_id", "source", "key", "size", "source_size", "target", "n_docs",
        F.floor(times + CERTAIN).alias("whole"),
        F.when(F.col("size") > 0, F.greatest(times - F.floor(times + CERTAIN), F.lit(0.0))).otherwise(0.0).alias("chance"),
        (F.col("size") * F.col("rows")).cast("double").alias("weight"),
        luck.alias("luck"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "key"), groups).alias("bucket"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in level.schema])
    most_groups = targets.agg(F.max(groups)).first()[0] or 0
    done, number = [], 0
    while True:
        level = stored(level.groupBy("source", "bucket").applyInArrow(_reduced, schema), "mix-level")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(level.filter(~open_))
        level = level.filter(open_)
        if most_groups <= 1:
            break
        most_groups = -(-most_groups // FAN_IN)
        number += 1
        level = level.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN)).withColumn("luck", F.xxhash64(F.lit(seed + 1 + number), "doc_id", "key", "source"))
    # The one document a source may have left.
    last = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 99), "doc_id", "key", "source"), 11) / F.lit(2.0**53)
    done.append(level.withColumn("chance", F.when(last < F.col("chance"), 1.0).otherwise(0.0)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("whole") + F.col("chance")).cast("long")
    return out.select("doc_id", "source", "key", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", weights=WEIGHTS, most: float = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words) of every row."""
    rows = stored(sized(docs, text, id_col, source), "sized")
    choice = decided(rows, weights, most, seed).select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("key").alias("k"), "source_size", "target", "copies"
    )
    same = (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s"))
    return rows.join(choice, same).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def taken_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", weights=WEIGHTS, most: float = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The documents, with their own columns, each as often as the mix takes it."""
    choice = stored(decided(stored(sized(docs, text, id_col, source), "sized"), weights, most, seed), "mix-decided").filter("copies > 0")
    names = docs.columns
    choice = choice.select(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("key").alias("mix_key"), F.col("copies").alias("mix_copies"))
    narrow = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], text_key(F.col(text)).alias("key"))
    at = {c: f"c{i}" for i, c in enumerate(names)}
    same = (F.col("key") == F.col("mix_key")) & F.col(at[id_col]).eqNullSafe(F.col("mix_id")) & F.col(at[source]).eqNullSafe(F.col("mix_source"))
    repeated = narrow.join(shuffled(choice), same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return repeated.select(*[F.col(at[c]).alias(c) for c in names])
