"""Secret scans: known forms, and character Markov models for the rest.

Known forms are three patterns. Beyond them every token of CANDIDATE characters or
more is scored by two first-order Markov models over its characters, one of random
strings and one of ordinary identifiers; where the log-likelihood ratio exceeds
EVIDENCE, the token is a span of kind ``random``, unless it overlaps a known one.

The models are trained from labelled samples: column ``sample`` and ``secret``.
``labelled_samples`` draws them from a corpus, values of known forms against other
tokens, SAMPLES of each label at most: one for each hash value modulo SAMPLES. The
models are tables of fixed size.

Places count code points, the end is exclusive. Weights are whole numbers of
1/SCALE nats, so sums do not depend on their order.

Defined cases: a null text is an empty one, without spans. Repeated rows are scanned
one by one. Without samples of both labels every weight is zero and nothing is added.
Null samples or labels count nothing. An empty table gives no rows. Other columns are
passed on; one with the name of a result is replaced. Very long texts and tokens take
time in proportion to their length, but for texts that hold very many known forms and
very many random tokens both: each of the latter is held against each of the former.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import fresh, long_table, settled

# The known forms, in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 12

TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}"
CANDIDATE = 16
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(LETTERS) + 1
SMOOTHING = 0.5
SCALE = 1_000_000
# Log-likelihood ratio in nats above which a token counts as random.
EVIDENCE = 10.0
SAMPLES = 20_000
# Matches that are placed together.
STRETCH = 64
RESULTS = ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")


def _found(text: Column, pattern: str) -> Column:
    """Every match, leftmost and without overlap: at, to, match.

    Matches are placed within stretches of STRETCH of them, and stretches behind each
    other, so a text of very many matches never grows one long array match by match.
    """
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<at:int,to:int,match:string>>")
    pair = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"), matches.alias("match"))

    def step(state: Column, one: Column) -> Column:
        at = state["to"] + F.length(one["gap"])
        to = at + F.length(one["match"])
        return F.struct(to.alias("to"), F.concat(state["out"], F.array(F.struct(at.alias("at"), to.alias("to"), one["match"].alias("match")))).alias("out"))

    def placed(pairs: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(STRETCH))
        return F.transform(firsts, lambda i: F.aggregate(F.slice(pairs, i, F.lit(STRETCH)), F.struct(F.lit(0).alias("to"), empty.alias("out")), step))

    def joined(stretches: Column) -> Column:
        start = F.struct(F.lit(0).alias("to"), F.array().cast("array<int>").alias("out"))
        grown = lambda s, x: F.struct((s["to"] + x["to"]).alias("to"), F.concat(s["out"], F.array(s["to"])).alias("out"))
        moved = lambda x: F.transform(x["one"]["out"], lambda m: F.struct((m["at"] + x["by"]).alias("at"), (m["to"] + x["by"]).alias("to"), m["match"].alias("match")))
        behind = F.aggregate(stretches, start, grown, lambda s: s["out"])
        return F.flatten(F.transform(F.arrays_zip(stretches.alias("one"), behind.alias("by")), moved))

    return F.when(text.rlike(pattern), _with(_with(pair, placed), joined)).otherwise(empty)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the value, which is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _text(docs: DataFrame, text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def known_forms(text: Column) -> tuple[Column, Column, Column]:
    """Spans of the three patterns that are long enough."""
    value = lambda m: F.regexp_extract(m["match"], ASSIGN, 2)
    return F.filter(_found(text, ASSIGN), lambda m: F.length(value(m)) >= MIN_VALUE), _found(text, ACCESS), _found(text, HEX)


def _apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["at"] < span["to"]) & (span["at"] < o["to"]))


def labelled_samples(docs: DataFrame, text: str = "text", limit: int = SAMPLES) -> DataFrame:
    """sample and secret, at most ``limit`` of either label, from the corpus itself."""
    rows = docs.select(_text(docs, text).alias("text"))
    assign, access, hexes = known_forms(F.col("text"))
    rows = rows.select(F.concat(assign, access, hexes).alias("known"), assign.alias("assign"), F.concat(access, hexes).alias("bare"), _found(F.col("text"), TOKEN).alias("tokens"))
    value = lambda m: F.regexp_extract(m["match"], ASSIGN, 2)
    secret = F.transform(F.concat(F.transform("assign", value), F.transform("bare", lambda m: m["match"])), lambda s: F.struct(s.alias("sample"), F.lit(1).alias("secret")))
    plain = F.transform(F.filter("tokens", lambda t: _apart(t, F.col("known"))), lambda t: F.struct(t["match"].alias("sample"), F.lit(0).alias("secret")))
    each = rows.select(F.inline(F.concat(secret, plain)))
    slot = F.pmod(F.xxhash64("sample"), F.lit(limit))
    return each.groupBy("secret", slot.alias("slot")).agg(F.min_by("sample", F.struct(F.xxhash64(F.lit(1), "sample"), "sample")).alias("sample")).select("sample", "secret")


def _states(sample: Column) -> Column:
    """The letters as numbers from 1, 0 for other ones, and 0 in front of the first."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(sample, ""), lambda letter: F.call_function("locate", letter, F.lit(LETTERS))))


def _pairs(sample: Column) -> Column:
    """Numbers of the steps from letter to letter, the one to the first letter included."""
    states = _states(sample)
    return F.zip_with(F.slice(states, F.lit(1), F.size(states) - 1), F.slice(states, F.lit(2), F.size(states) - 1), lambda a, b: a * STATES + b)


def trained(samples: DataFrame) -> list[int]:
    """Weights by previous and next letter, STATES * STATES numbers: log random / ordinary, times SCALE."""
    usable = samples.filter("sample is not null and length(sample) > 0 and secret is not null").select("sample", (F.col("secret") == 1).cast("int").alias("secret"))
    steps = usable.select("secret", F.explode(_pairs(F.col("sample"))).alias("pair"))
    counts = steps.groupBy("pair").agg(F.sum("secret").alias("random"), F.sum(1 - F.col("secret")).alias("plain"))
    cells = samples.sparkSession.range(STATES * STATES).select(F.col("id").cast("int").alias("pair")).join(counts, "pair", "left").na.fill(0)
    row = Window.partitionBy(F.floor(F.col("pair") / STATES))
    every = Window.partitionBy()
    share = lambda c: F.log((F.col(c) + SMOOTHING) / (F.sum(c).over(row) + SMOOTHING * STATES))
    usable_models = (F.sum("random").over(every) > 0) & (F.sum("plain").over(every) > 0)
    weight = F.when(usable_models, F.round((share("random") - share("plain")) * SCALE).cast("long")).otherwise(0)
    return [r["weight"] for r in cells.select("pair", weight.alias("weight")).orderBy("pair").collect()]


def log_ratio(sample: Column, weights: Column) -> Column:
    """Log-likelihood ratio of random against ordinary, times SCALE."""
    return F.aggregate(_pairs(sample), F.lit(0).cast("bigint"), lambda s, pair: s + F.get(weights, pair))


def scanned(docs: DataFrame, weights: list[int], text: str = "text", evidence: float = EVIDENCE) -> DataFrame:
    """The documents with the columns of RESULTS and ``found``, the spans as structs."""
    kept = [c for c in docs.columns if c.lower() not in (*RESULTS, "found") or c == text]
    a, b, c, t, n = (fresh(docs, name) for name in ("assigns", "accesses", "hexes", "tokens", "randoms"))
    whole = _text(docs, text)
    assign, access, hexes = known_forms(whole)
    tokens = F.filter(_found(whole, TOKEN), lambda m: F.length(m["match"]) >= CANDIDATE)
    rows = docs.select(*kept, assign.alias(a), access.alias(b), hexes.alias(c), tokens.alias(t))
    known, table = F.concat(F.col(a), F.col(b), F.col(c)), long_table(weights)
    unlike = lambda m: (log_ratio(m["match"], table) > int(evidence * SCALE)) & _apart(m, known)
    rows = rows.select(*kept, a, b, c, F.filter(t, unlike).alias(n))
    as_kind = lambda spans, kind: F.transform(spans, lambda m: F.struct(m["at"].alias("at"), F.lit(kind).alias("kind"), m["to"].alias("to")))
    base = F.sort_array(F.concat(*[as_kind(F.col(x), k) for k, x in enumerate((a, b, c))]))
    found = F.sort_array(F.concat(*[as_kind(F.col(x), k) for k, x in enumerate((a, b, c, n))]))
    name = F.array(*map(F.lit, KINDS))
    spelled = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["at"], s["to"])), ",")
    sizes = [F.size(x).cast("long").alias(f"n_{k}") for k, x in zip(KINDS, (a, b, c, n), strict=True)]
    return settled(rows, kept, *sizes, F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"), spelled(found).alias("spans"), found.alias("found"))


def redacted(docs: DataFrame, weights: list[int], text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents, with their own columns, every span replaced by a mark."""
    names = docs.columns
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    at = f"c{names.index(text)}"
    rows = scanned(rows, weights, at)
    whole = F.col(at)
    start = F.struct(F.lit(0).alias("to"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substr(whole, state["to"] + 1, F.greatest(span["at"] - state["to"], F.lit(0)))
        cut = F.concat(state["out"], gap, F.when(span["at"] >= state["to"], mark).otherwise(""))
        return F.struct(F.greatest(state["to"], span["to"]).alias("to"), cut.alias("out"))

    text_out = F.aggregate("found", start, step, lambda s: F.concat(s["out"], F.substr(whole, s["to"] + 1, F.length(whole))))
    cleaned = F.when(F.size("found") > 0, text_out).otherwise(whole)
    return rows.select(*[(cleaned if c == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])
