"""URL filters with dated lists: was a capture listed on the day it was fetched?

List entries are dated: on ``day`` the entry for ``pattern`` becomes ``action``
(block, allow, or remove). Entries become validity intervals, from their day to the
day of the next entry for the same pattern. A capture asks for its host, every
parent domain and every leading part of its path, most specific first; the first
pattern with an active interval decides.

The as-of join runs over distinct (pattern, day) pairs: questions and intervals of a
pattern are sorted into one sequence and every question takes over the last interval
begun. A pattern has one interval and one question a day at most, so a host with a
third of all captures costs no more than another; captures are joined to the
answers by pattern and day.

Defined cases: a URL that is null or has no host asks nothing and is kept. A null
day, pattern or action makes an entry void; a capture without a day is kept. Several
entries for a pattern on a day count as one, remove before allow before block.
Repeated captures are answered each. Without entries everything is kept. Patterns
and hosts are compared in lower case, paths as they are. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"
ORDER = ("remove", "allow", "block")


def host(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), r"\.$", "")


def patterns(url: Column, deepest: int | None = None) -> Column:
    """All patterns that cover a URL, the most specific first: paths of up to ``deepest`` segments, host, parent domains."""
    name = host(url)
    labels = F.split(name, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.array_remove(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), "")
    depth = F.size(parts) if deepest is None else F.least(F.size(parts), F.lit(deepest))
    paths = F.when(depth > 0, F.transform(F.sequence(depth, F.lit(1)), lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    return F.when(name != "", F.concat(F.coalesce(paths, F.array().cast("array<string>")), domains)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, action, valid_from and valid_to (exclusive, null while it lasts)."""
    rank = F.array_position(F.array(*map(F.lit, ORDER)), F.col("action"))
    # Patterns keep the case of their path.
    name = F.concat(F.lower(F.substring_index("pattern", "/", 1)), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)"))
    valid = entries.filter(F.col("pattern").isNotNull() & F.col("day").isNotNull() & (rank > 0))
    daily = valid.groupBy(name.alias("pattern"), "day").agg(F.min_by("action", rank).alias("action"))
    nxt = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    return daily.select("pattern", "action", F.col("day").alias("valid_from"), nxt.alias("valid_to")).filter("action <> 'remove'")


def as_of(questions: DataFrame, valid: DataFrame) -> DataFrame:
    """pattern, day and action for the distinct questions that meet an active interval."""
    none = F.lit(None)
    begun = valid.select("pattern", F.col("valid_from").alias("day"), F.lit(0).alias("asks"), F.struct("action", "valid_to").alias("entry"))
    asked = questions.select("pattern", "day").distinct().select("pattern", "day", F.lit(1).alias("asks"), none.cast(begun.schema["entry"].dataType).alias("entry"))
    order = Window.partitionBy("pattern").orderBy("day", "asks").rowsBetween(Window.unboundedPreceding, 0)
    last = begun.unionByName(asked).withColumn("entry", F.last("entry", ignorenulls=True).over(order)).filter("asks = 1 and entry is not null")
    active = F.col("entry.valid_to").isNull() | (F.col("day") < F.col("entry.valid_to"))
    return last.filter(active).select("pattern", "day", "entry.action")


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day", id_col: str = "page_id") -> DataFrame:
    """id, url, day, pattern (the one that decided, or null), action and kept of every capture."""
    rows = captures.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(day).alias("day"))
    # Captures that agree in URL and day share their answer.
    each = rows.filter("url is not null and day is not null").groupBy("url", "day").agg(F.count("*").alias("n"))
    # No entry has more segments, so longer paths would meet none.
    deepest = entries.agg(F.max(F.size(F.split("pattern", "/"))).alias("n")).first()["n"] or 1
    asked = each.select("url", "day", F.posexplode(patterns(F.col("url"), deepest - 1)).alias("place", "pattern"))
    answers = as_of(asked, intervals(entries)).withColumnRenamed("day", "on").withColumnRenamed("pattern", "p")
    met = asked.join(answers, (F.col("pattern") == F.col("p")) & (F.col("day") == F.col("on")))
    first = met.groupBy("url", "day").agg(F.min_by(F.struct("pattern", "action"), "place").alias("hit"))
    first = first.select(F.col("url").alias("u"), F.col("day").alias("d"), "hit")
    out = rows.join(first, (F.col("url") == F.col("u")) & (F.col("day") == F.col("d")), "left")
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url), F.col("day").alias(day),
        F.col("hit.pattern").alias("pattern"), F.col("hit.action").alias("action"),
        F.coalesce(F.col("hit.action") != "block", F.lit(True)).alias("kept"),
    )


def keep_unlisted(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """The captures, with their own columns, that no active entry blocks."""
    at = {c: f"c{i}" for i, c in enumerate(captures.columns)}
    narrow = captures.select(*[F.col(c).alias(n) for c, n in at.items()])
    asked = narrow.select(F.lit(0).alias("id"), F.col(at[url]).alias("bad_url"), F.col(at[day]).alias("bad_day")).distinct()
    bad = judged(asked, entries, "bad_url", "bad_day", "id").filter("not kept").select("bad_url", "bad_day")
    kept = narrow.join(bad, (F.col(at[url]) == F.col("bad_url")) & (F.col(at[day]) == F.col("bad_day")), "left_anti")
    return kept.select(*[F.col(n).alias(c) for c, n in at.items()])
