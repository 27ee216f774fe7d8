"""Benchmark decontamination by windows of WINDOW words.

A window is WINDOW consecutive words of an item, or the whole item if it has fewer.
Every word of a document inside an occurrence of a window is hit. The scan goes in
two steps: hashes of the first ANCHOR words at each place of a text are looked up in
a bit table of the windows' beginnings inside the row, without a shuffle; only the
places that pass are joined, by the hash of the whole window, to the windows, and
verified word for word.

The windows are broadcast up to BROADCAST_WINDOWS of them; more are joined by a
shuffle of the places that passed. The bit table has a fixed size.

Defined cases: a null or empty text has no words, is not hit and not contaminated;
an item without words has no window. Items that repeat count by their item_id, a
null item_id counts as one item named "". Rows that agree in id and text are one
document in the results of ``hits`` and ``contamination``.
Empty tables give empty results or no hits. Other columns are ignored or, in the
filters, passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import TERM, long_table, stored, terms, text_key

WINDOW = 13
ANCHOR = 3
# Bits of the table of beginnings, as a power of two, in words of 32 bits.
TABLE_BITS = 20
WORD_BITS = 5
BROADCAST_WINDOWS = 2_000_000
# A document is contaminated when it is hit in 1 of so many words.
ONE_IN = 20


def windows(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """item, span (its words, joined by blanks) and length of every distinct window of an item."""
    words = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), terms(F.col(text)).alias("words")).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    spans = words.select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    spans = spans.select("item", F.slice("words", F.col("i") + 1, F.lit(window)).alias("w"))
    return spans.select("item", F.array_join("w", " ").alias("span"), F.size("w").alias("length")).distinct()


def _beginning(words: Column, i: Column, n: int) -> Column:
    """A place in the table for the n words from i on."""
    return F.xxhash64(*[F.get(words, i + k) if k else F.get(words, i) for k in range(n)]).bitwiseAND((1 << TABLE_BITS) - 1)


def _table(spans: DataFrame, n: int) -> Column:
    """The bit table of all beginnings of n words: 2**TABLE_BITS bits, whatever the benchmark."""
    words = F.split("span", " ")
    at = spans.select(words.alias("words")).select(_beginning(F.col("words"), F.lit(0), n).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND((1 << WORD_BITS) - 1).cast("int"))
    filled = at.select(F.shiftright("at", WORD_BITS).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = [0] * (1 << (TABLE_BITS - WORD_BITS))
    for row in filled.collect():
        table[row["word"]] = row["bits"]
    return long_table(table)


def _places(words: Column, table: Column, n: int, length: int) -> Column:
    """Where a window of ``length`` words may begin: the table knows the first n words."""
    last = F.size(words) - length
    every = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(every, lambda i: _beginning(words, i, n))
    known = lambda h: F.call_function(
        "shiftright", F.get(table, F.shiftright(h, WORD_BITS).cast("int")), h.bitwiseAND((1 << WORD_BITS) - 1).cast("int")
    ).bitwiseAND(1)
    marked = F.transform(hashes, lambda h, i: F.when(known(h) == 1, i).otherwise(-1))
    return F.array_remove(marked, -1)


def _spelled(words: Column, lengths: list[int]):
    """From a place to the windows that may begin there."""

    def at(i: Column) -> Column:
        every = [F.struct(i.alias("at"), F.lit(m).alias("length"), F.array_join(F.slice(words, i + 1, F.lit(m)), " ").alias("span")) for m in lengths]
        return F.filter(F.array(*every), lambda c: c["at"] + c["length"] <= F.size(words))

    return at


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """doc_id, key, n_words, spots (place and length of every occurrence) and items of every distinct document."""
    spans = stored(windows(benchmark, window=window), "windows")
    lengths = sorted(r["length"] for r in spans.select("length").distinct().collect())
    words = F.col("words")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text)).alias("key"), terms(F.col(text)).alias("words"))
    candidates = F.array().cast("array<struct<at:int,length:int,span:string>>")
    for n in sorted({min(ANCHOR, length) for length in lengths}):
        own = [m for m in lengths if min(ANCHOR, m) == n]
        places = _places(words, _table(spans.filter(F.least("length", F.lit(ANCHOR)) == n), n), n, own[0])
        candidates = F.concat(candidates, F.flatten(F.transform(places, _spelled(words, own))))
    n_words = F.size(words).cast("long").alias("n_words")
    spread = rows.select("doc_id", "key", n_words, F.explode_outer(candidates).alias("c")).select("doc_id", "key", "n_words", "c.*", F.xxhash64("c.span").alias("h"))
    known = spans.select("item", F.col("span").alias("window"), F.xxhash64("span").alias("wh"))
    if known.count() <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    met = spread.join(known, (F.col("h") == F.col("wh")) & (F.col("span") == F.col("window")), "left")
    spot = F.when(F.col("item").isNotNull(), F.struct("at", "length"))
    return met.groupBy("doc_id", "key", "n_words").agg(F.collect_set(spot).alias("spots"), F.collect_set("item").alias("items"))


def _n_hit(spots: Column) -> Column:
    """Words inside any spot: spots in order, each adding what reaches beyond those before it."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(state: Column, spot: Column) -> Column:
        end = F.greatest(state["end"], spot["at"] + spot["length"])
        return F.struct(end.alias("end"), (state["n"] + end - F.greatest(state["end"], spot["at"])).alias("n"))

    return F.aggregate(F.sort_array(spots), start, add, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, key, n_words, n_hit, items, spots and contaminated of every distinct document."""
    found = hits(docs, benchmark, text, id_col).withColumn("n_hit", _n_hit(F.col("spots"))).withColumn("items", F.sort_array("items"))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))


def _attached(docs: DataFrame, found: DataFrame, text: str, id_col: str, how: str) -> DataFrame:
    """Documents, their columns renamed c0, c1, ..., with what was found."""
    narrow = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)], text_key(F.col(text)).alias("text_key"))
    own = f"c{docs.columns.index(id_col)}"
    return narrow.join(found, F.col(own).eqNullSafe(F.col("doc_id")) & (F.col("text_key") == F.col("key")), how)


def _named(docs: DataFrame, rows: DataFrame, **changed: Column) -> DataFrame:
    return rows.select(*[changed.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents, with their own columns, that are not contaminated."""
    bad = contamination(docs, benchmark, text, id_col).filter("contaminated").select("doc_id", "key")
    return _named(docs, _attached(docs, bad, text, id_col, "left_anti"))


def clean_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All documents, the words that are hit cut out of their texts."""
    found = contamination(docs, benchmark, text, id_col).filter("n_hit > 0").select("doc_id", "key", "spots")
    rows = _attached(docs, found, text, id_col, "left")
    whole = F.col(f"c{docs.columns.index(text)}")
    any_case = TERM.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    words, gaps = F.regexp_extract_all(whole, F.lit(any_case), F.lit(0)), F.split(whole, any_case, -1)
    hit = F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))))
    pairs = F.transform(gaps, lambda gap, i: F.concat(gap, F.when(F.array_contains(hit, i), "").otherwise(F.coalesce(F.get(words, i), F.lit("")))))
    cut = F.when(F.col("spots").isNull(), whole).otherwise(F.array_join(pairs, ""))
    return _named(docs, rows, **{text: cut})
