"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import shuffled, stored

# Up to so many links Spark may broadcast what they are joined with, two rows a link at most.
FEW = 100_000


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least if few else shuffled(least), "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least if few else shuffled(least), "b").select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b")
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) between longs, (node, root) of each linked node; root is the smallest.

    Rounds grow with the logarithm of the longest chain. Each round is written to
    the shared folder; only a count and a checksum come to the driver.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    now = stored(ordered, "links")
    state = _state(now)
    while state[0]:
        few = state[0] <= FEW
        now = stored(_small_star(_large_star(now, few), few), "links")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
