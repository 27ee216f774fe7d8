"""Quality rules: counted features and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams (one and two words) are estimated, one
from trusted documents and one from the whole corpus. A document's score is the
mean of log(trusted / raw) over its n-grams, so that length does not matter. It
is rejected below a threshold that is a fixed margin plus what sampling noise
moves a mean by: buckets / (2 * smoothed n-grams of the trusted side). Smoothing
adds SMOOTHING to a trusted bucket and as much, relative to its size, to a raw one.

Weights are whole numbers of 1/SCALE, so sums do not depend on their order.

Defined cases: a null or empty text has no words, all counts zero and a score of
0, and fails the base rules. Repeated rows are scored one by one, a repeated
label counts once, a label without a document and a null quality count nothing.
With no trusted document every weight is zero. Other columns are passed on
untouched; a column with the name of a result is replaced in ``judged``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fresh, long_table, settled, spaced_words

# A power of two.
BUCKETS = 32_768
SMOOTHING = 10.0
# Mean log ratio per n-gram below which a document is unlike the trusted ones.
MARGIN = 0.05
SCALE = 1_000_000
# Trusted documents used at most, picked by the hash of their id.
TRUSTED_LIMIT = 20_000
MIN_WORDS = 50
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")

SYMBOLS = r"[#*$%&|<>]"
WORDY = r"[^\x20\x09-\x0D]"


def grams(words: Column) -> Column:
    """The buckets of all single words and all pairs of neighbours."""
    last = F.size(words) - 1
    one = F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(BUCKETS - 1))
    two = F.transform(
        F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)).bitwiseAND(BUCKETS - 1),
    )
    return F.concat(one, two)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", quality: str = "quality", limit: int = TRUSTED_LIMIT) -> DataFrame:
    """Ids labelled good, at most ``limit`` of them, as column ``trusted``."""
    return (
        labels.filter(F.col(quality) == 1)
        .select(F.col(id_col).alias("trusted"))
        .filter(F.col("trusted").isNotNull())
        .distinct()
        .orderBy(F.xxhash64("trusted"), "trusted")
        .limit(limit)
    )


def weights(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row: ``weights``, an array by bucket, and ``threshold``, both times SCALE.

    One scan of the texts; what is shuffled are counts of at most BUCKETS buckets
    per task. The trusted side is broadcast: it has TRUSTED_LIMIT ids at most.
    """
    trusted = F.broadcast(trusted_ids(labels, id_col))
    rows = docs.select(F.col(id_col).alias("id"), spaced_words(F.col(text)).alias("words"))
    counted = (
        rows.join(trusted, F.col("id") == F.col("trusted"), "left")
        .select(F.col("trusted").isNotNull().cast("long").alias("good"), F.explode(grams(F.col("words"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    )
    spark = docs.sparkSession
    filled = spark.range(BUCKETS).select(F.col("id").alias("bucket")).join(counted, "bucket", "left").na.fill(0)
    # A bounded table: BUCKETS rows, whatever the input.
    table = filled.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "good"))).alias("t"),
        F.sum("raw").alias("n_raw"),
        F.sum("good").alias("n_good"),
    )
    n_good, n_raw = F.greatest(F.col("n_good"), F.lit(1)), F.greatest(F.col("n_raw"), F.lit(1))
    # Both sides are drawn towards the uniform distribution to the same degree.
    raw = lambda x: F.log((x["raw"] + SMOOTHING * n_raw / n_good) / n_raw)
    ratio = lambda x: F.log((x["good"] + SMOOTHING) / n_good) - raw(x)
    noise = BUCKETS / (2 * (F.col("n_good") + SMOOTHING * BUCKETS))
    return table.select(
        F.transform("t", lambda x: F.when(F.col("n_good") > 0, F.round(ratio(x) * SCALE).cast("long")).otherwise(F.lit(0).cast("long"))).alias("weights"),
        F.round(-(MARGIN + noise) * SCALE).cast("long").alias("threshold"),
    )


def place_bits(n: Column) -> Column:
    """Bits that hold the places below n; never null, so that longs are sorted as such."""
    return F.coalesce(F.ceil(F.log2(F.greatest(n, F.lit(2)))).cast("int"), F.lit(1))


def _windows(words: Column, bits: Column) -> Column:
    """All windows of three words, hash and place in one long, sorted.

    The hash keeps the bits that the places leave, 49 for a text of 32,000 words.
    """
    n = F.size(words) - 2
    return F.sort_array(
        F.transform(
            F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: F.call_function("shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits).bitwiseOR(i.cast("long")),
        )
    )


def _covered(windows: Column, bits: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""
    unlike = lambda x, y: F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits)
    later = lambda i: unlike(F.get(windows, i), F.get(windows, i - 1)) == 0
    twice = F.filter(windows, lambda x, i: F.coalesce(later(i) | later(i + 1), later(i), later(i + 1)))
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")
    each = F.transform(twice, lambda x: F.array(place(x), place(x) + 1, place(x) + 2))
    some = F.size(F.filter(windows, lambda x, i: later(i))) > 0
    return F.when(some, F.size(F.array_distinct(F.flatten(each)))).otherwise(0).cast("long")


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", model: DataFrame | None = None) -> DataFrame:
    """The documents with the columns of RESULTS; no shuffle of documents."""
    model = weights(docs, labels, text, id_col) if model is None else model
    # BUCKETS numbers, whatever the input.
    [fitted] = model.collect()
    table, limit = long_table(fitted["weights"]), F.lit(fitted["threshold"]).cast("long")
    kept_columns = [c for c in docs.columns if c.lower() not in RESULTS or c in (text, id_col)]
    w, b, r, ln, g, n = (fresh(docs, name) for name in ("words", "bits", "windows", "lines", "grams", "repeated"))
    words = F.col(w)
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: x.rlike(WORDY))
    # Each column is used at least twice later on, so that it is computed once a row and not in a lambda.
    out = docs.select(*kept_columns, spaced_words(F.col(text)).alias(w))
    out = out.select("*", place_bits(F.size(words)).alias(b))
    out = out.select("*", _windows(words, F.col(b)).alias(r), lines.alias(ln), grams(words).alias(g))
    n_grams = F.size(g).cast("long")
    total = F.aggregate(g, F.lit(0).cast("long"), lambda s, b: s + F.get(table, b.cast("int")))
    n_words, repeated = F.size(words).cast("long"), _covered(F.col(r), F.col(b))
    out = out.select("*", repeated.alias(n))
    repeated = F.col(n)
    failed = (n_words < MIN_WORDS) | (100 * repeated > 50 * n_words)
    return settled(
        out,
        kept_columns,
        n_words.alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(F.col(ln)))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.when(n_grams > 0, total / (n_grams * F.lit(SCALE))).otherwise(0.0).alias("score"),
        (~failed & (n_grams > 0) & (total >= limit * n_grams)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents, with their own columns, that pass base rules and ratio."""
    narrow = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    index = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    good = judged(docs.select(*narrow), labels.withColumnRenamed(id_col, index[id_col]), index[text], index[id_col]).filter("kept")
    return good.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
