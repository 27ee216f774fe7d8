"""Language-model scores by masked pseudo-likelihood.

A small network predicts a word from WINDOW words on both sides. A text's score is
the sum of the log-probabilities of all its words, each given its neighbours.

* Vocabulary: counts of all words of the corpus, a table that grows with it. The
  commonest WORDS have an id of their own, the others share HASHED ids by hash.
* A word without its own id adds the logarithm of its share of its bucket, by the table of
  counts. The COMMON words are looked up where the text is read; rarer ones, each of
  which is a small part of the corpus, are joined with the table.
* Network: embeddings of the neighbours by place, one hidden layer, and a softmax in
  two steps, class (id // CLASS) and member, so that a word costs two short rows.
* Training: in each round every task goes over all its documents, masks a share of
  the places picked by hash, and takes Adagrad steps from the round's parameters.
  The rounds' shares are disjoint, and together they are every place.
  Parameters are averaged by the number of masked words. They travel as whole
  numbers of 1/SCALE, so the average does not depend on the order of tasks. A task's
  steps depend on what it reads, so scores differ a little where files are split otherwise.

Defined cases: a null or empty text has no words and scores 0. Repeated rows are
scored each. An empty table gives an untrained model and no rows. Texts of any
length are taken in stretches of STRETCH words. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import ship, stored

WORDS = 960
HASHED = 64
CLASS = 32
WINDOW = 2
WIDTH = 16
HIDDEN = 32
ROUNDS = 2
# The rounds' places are disjoint and together all.
MASKED = 1 / ROUNDS
RATE = 0.1
STEP = 4096
STRETCH = 1 << 15
# Places that are scored together.
TOGETHER = 1 << 12
# Words that every task holds with their counts, at most.
COMMON = 1 << 17
# Different words a task counts before it gives them out, and rows of such a batch.
HELD = 1 << 18
ROWS = 1 << 14
# Parameters in a row, and groups of tasks that are added up first.
PIECE = 4096
SALTS = 256
SCALE = 1 << 24
SEED = 11


@dataclass
class Shape:
    """Sizes of the network; parameters lie in one vector, in this order."""

    words: int = WORDS
    hashed: int = HASHED
    window: int = WINDOW
    width: int = WIDTH
    hidden: int = HIDDEN
    parts: list = field(init=False)

    def __post_init__(self):
        if (self.words + self.hashed) % CLASS:
            raise ValueError(f"ids must fill classes of {CLASS}")
        if self.words + self.hashed >= 1 << 15:
            raise ValueError("ids are written in 16 bits")
        n, c = self.words + self.hashed, (self.words + self.hashed) // CLASS
        self.parts = [
            ("embed", (n + 1, self.width)), ("mix", (2 * self.window * self.width, self.hidden)), ("mix_bias", (self.hidden,)),
            ("classes", (self.hidden, c)), ("class_bias", (c,)), ("members", (c, self.hidden, CLASS)), ("member_bias", (c, CLASS)),
        ]

    @property
    def edge(self) -> int:
        """The id that stands beyond either end of a text."""
        return self.words + self.hashed

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for _, s in self.parts)

    def views(self, vector: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts:
            n = int(np.prod(shape))
            out[name] = vector[at : at + n].reshape(shape)
            at += n
        return out


@dataclass
class Vocabulary:
    """The words of a corpus: ``counts`` and ``kinds`` (different words) of every id, ``common`` words with their counts, and ``table`` (word, n) of all of them."""

    words: list[str]
    counts: np.ndarray
    kinds: np.ndarray
    common: dict[bytes, int]
    table: DataFrame


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (binary) and n of every word; a task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def given() -> Iterator[pa.RecordBatch]:
            words, n = list(held.keys()), list(held.values())
            for a in range(0, len(words), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(words[a : a + ROWS], pa.binary()), pa.array(n[a : a + ROWS], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in batches:
            for one in batch.column(0).cast(pa.binary()):
                held.update((one.as_py() or b"").lower().split())
                if len(held) > HELD:
                    yield from given()
        yield from given()

    partial = docs.select(F.col(text).alias("text")).mapInArrow(count, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str = "text", shape: Shape | None = None, common: int = COMMON) -> Vocabulary:
    """Counts of all words, stored; the commonest ones with an id of their own, most frequent first."""
    shape = shape or Shape()
    table = stored(word_counts(docs, text), "word-counts")
    # Counts in bands, so that what goes to the driver has a bound and no task sorts all words.
    band = F.floor(16 * F.log2("n")).cast("int")
    bands = sorted(((r["band"], r["count"]) for r in table.groupBy(band.alias("band")).count().collect()), reverse=True)
    running = np.cumsum([0] + [n for _, n in bands])
    enough = next((b for (b, _), n in zip(bands, running[1:], strict=True) if n >= shape.words), 0)
    first = table.filter(band >= enough).orderBy(F.desc("n"), "word").limit(shape.words).collect()
    within = [b for (b, _), n in zip(bands, running[1:], strict=True) if n <= common]
    known = {bytes(r["word"]): r["n"] for r in (table.filter(band >= within[-1]).collect() if within else [])}
    # Every word by its bucket; those with an id of their own are taken out again.
    buckets = table.groupBy(F.pmod(F.crc32("word"), F.lit(shape.hashed)).alias("bucket")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
    counts, kinds = np.zeros(shape.edge), np.zeros(shape.edge)
    for r in buckets.collect():
        counts[shape.words + r["bucket"]], kinds[shape.words + r["bucket"]] = r["n"], r["kinds"]
    for i, r in enumerate(first):
        bucket = shape.words + zlib.crc32(r["word"]) % shape.hashed
        counts[i], kinds[i] = r["n"], 1
        counts[bucket] -= r["n"]
        kinds[bucket] -= 1
    return Vocabulary([bytes(r["word"]).decode() for r in first], counts, kinds, known, table)


def share(n: Column | np.ndarray, counts: Column | np.ndarray, kinds: Column | np.ndarray) -> Column | np.ndarray:
    """A word's part of its bucket: one more than its count, out of one more for every word there and one for all unseen ones."""
    return (n + 1) / (counts + kinds + 1)


def as_ids(docs: DataFrame, known: Vocabulary, text: str = "text", id_col: str = "doc_id", shape: Shape | None = None) -> DataFrame:
    """doc_id, n_words, ids (16 bits each), shares (log, of the common words without an id), rare (the other words without one) and a number of every row, stored."""
    shape = shape or Shape()
    ship(docs.sparkSession)
    words, common, counts, kinds = known.words, known.common, known.counts, known.kinds
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("shares", T.DoubleType()), T.StructField("rare", T.ArrayType(T.BinaryType())),
    ])

    def translate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Known words by number: those with an id of their own, then the other common ones.
        every = [w.encode() for w in words]
        own = set(every)
        every += [w for w in common if w not in own]
        number = {w: i for i, w in enumerate(every)}
        id_of = np.arange(len(every))
        id_of[len(words) :] = [shape.words + zlib.crc32(w) % shape.hashed for w in every[len(words) :]]
        log_share = np.zeros(len(every))
        others = id_of[len(words) :]
        log_share[len(words) :] = np.log(share(np.array([common[w] for w in every[len(words) :]]), counts[others], kinds[others]))
        for batch in batches:
            n, ids, shares, rare, ends = [], [], [], [], [0]
            for one in batch.column(1).cast(pa.binary()):
                found = (one.as_py() or b"").lower().split()
                at = np.fromiter(map(number.get, found, repeat(-1)), np.int32, len(found))
                unknown = np.flatnonzero(at < 0).tolist()
                at[unknown] = 0
                mine = id_of[at] if every else np.zeros(len(at), int)
                shares.append(float(log_share[at].sum() - len(unknown) * log_share[0]) if every else 0.0)
                left = [found[i] for i in unknown]
                mine[unknown] = [shape.words + zlib.crc32(w) % shape.hashed for w in left]
                n.append(len(found))
                ids.append(mine.astype("<i2").tobytes())
                rare += left
                ends.append(len(rare))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rare, pa.binary()))
            columns = [pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(shares, pa.float64()), listed]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "ids", "shares", "rare"])

    # Stored, so that a row has one number, whichever task reads it.
    return stored(rows.mapInArrow(translate, schema).withColumn("row", F.monotonically_increasing_id()), "word-ids")


def initial(shape: Shape, counts: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Small random weights; biases that say how common each id is."""
    rng = np.random.default_rng(seed)
    vector = rng.normal(0, 0.1, shape.size)
    parts = shape.views(vector)
    by_class = (counts + 1).reshape(-1, CLASS)
    parts["mix_bias"][:] = 0
    parts["class_bias"][:] = np.log(by_class.sum(1) / by_class.sum())
    parts["member_bias"][:] = np.log(by_class / by_class.sum(1, keepdims=True))
    parts["classes"][:] *= 0.1
    parts["members"][:] *= 0.1
    return vector


def contexts(ids: np.ndarray, ends: np.ndarray, shape: Shape, places: np.ndarray | None = None) -> np.ndarray:
    """The neighbours of the places (all, if none are given), left to right; texts end before the places in ``ends``."""
    places = np.arange(len(ids)) if places is None else places
    lengths = np.diff(ends, prepend=0)
    first = np.repeat((ends - lengths).astype(np.int64), lengths)[places]
    last = np.repeat(ends.astype(np.int64), lengths)[places]
    out = np.empty((2 * shape.window, len(places)), np.int16)
    for k, step in enumerate([*range(-shape.window, 0), *range(1, shape.window + 1)]):
        at = places + step
        inside = at >= first if step < 0 else at < last
        out[k] = np.where(inside, ids[np.where(inside, at, places)], shape.edge)
    return out.T


def _forward(parts: dict[str, np.ndarray], near: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Hidden values by row, the values of classes and of members by column, and (class, from, to); ``near`` by slot, the classes ``of`` ascend."""
    width = parts["embed"].shape[1]
    hidden = np.repeat(parts["mix_bias"][None], near.shape[1], 0)
    for k, ids in enumerate(near):
        # A row for each id is less than one for each place.
        hidden += (parts["embed"] @ parts["mix"][k * width : (k + 1) * width]).take(ids, axis=0)
    np.tanh(hidden, out=hidden)
    classes = parts["classes"].T @ hidden.T
    classes += parts["class_bias"][:, None]
    cuts = np.searchsorted(of, np.arange(len(parts["class_bias"]) + 1)).tolist()
    runs = [(c, a, b) for c, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
    members = np.empty((CLASS, len(hidden)), hidden.dtype)
    for c, a, b in runs:
        np.matmul(parts["members"][c].T, hidden[a:b].T, out=members[:, a:b])
    members += np.repeat(parts["member_bias"].T, np.diff(cuts), axis=1)
    return hidden, classes, members, runs


def _by_class(near: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the places by class, their neighbours by slot, classes and members in that order."""
    of, member = np.divmod(target, CLASS)
    order = np.argsort(of, kind="stable")
    return order, near.T.take(order, axis=1).astype(np.intp), of.take(order).astype(np.intp), member.take(order).astype(np.intp)


def log_probabilities(parts: dict[str, np.ndarray], near: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p(target | neighbours), a number each."""
    order, near, of, member = _by_class(near, target)
    _, classes, members, _ = _forward(parts, near, of)
    values, at = np.zeros(len(target), classes.dtype), np.arange(len(target))
    for x, chosen in ((classes, of), (members, member)):
        x -= x.max(0)
        values += x[chosen, at]
        values -= np.log(np.exp(x, out=x).sum(0))
    out = np.empty_like(values)
    out[order] = values
    return out


def gradient(parts: dict[str, np.ndarray], grad: dict[str, np.ndarray], near: np.ndarray, target: np.ndarray) -> None:
    """Fill ``grad`` with the mean gradient of -log p."""
    n, width, at = len(near), parts["embed"].shape[1], np.arange(len(near))
    _, near, of, member = _by_class(near, target)
    hidden, classes, members, runs = _forward(parts, near, of)
    for x, chosen in ((classes, of), (members, member)):
        x -= x.max(0)
        np.exp(x, out=x)
        x *= 1 / (n * x.sum(0))
        x[chosen, at] -= 1 / n
    grad["classes"][:] = (classes @ hidden).T
    grad["class_bias"][:] = classes.sum(1)
    back = classes.T @ parts["classes"].T
    grad["members"][:] = 0
    grad["member_bias"][:] = 0
    grad["member_bias"][[c for c, _, _ in runs]] = np.add.reduceat(members, [a for _, a, _ in runs], axis=1).T
    more = np.empty_like(back)
    for c, a, b in runs:
        err = members[:, a:b]
        np.matmul(hidden[a:b].T, err.T, out=grad["members"][c])
        np.matmul(err.T, parts["members"][c].T, out=more[a:b])
    back += more
    back *= 1 - hidden * hidden
    grad["mix_bias"][:] = back.sum(0)
    grad["embed"][:] = 0
    for k, ids in enumerate(near):
        order = np.argsort(ids.astype(np.int16), kind="stable")
        ids = ids.take(order)
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        sums, rows = np.add.reduceat(back.take(order, axis=0), starts, axis=0), ids[starts]
        mine = slice(k * width, (k + 1) * width)
        grad["mix"][mine] = parts["embed"][rows].T @ sums
        grad["embed"][rows] += sums @ parts["mix"][mine].T


def _stretches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch number, ids, ends of texts, row of each text), whole texts together up to STRETCH words or one longer."""
    for number, batch in enumerate(batches):
        held, rows, size = [], [], 0
        for row, ids in enumerate(batch.column(column)):
            held.append(np.frombuffer(ids.as_py(), "<i2"))
            rows.append(row)
            size += len(held[-1])
            if size >= STRETCH:
                yield number, np.concatenate(held), np.cumsum([len(x) for x in held]), np.array(rows)
                held, rows, size = [], [], 0
        if held:
            yield number, np.concatenate(held), np.cumsum([len(x) for x in held]), np.array(rows)


def masked_places(ids: np.ndarray, number: int, masked: float, ends: np.ndarray | None = None) -> np.ndarray:
    """Places of a round, by a hash of id and place in the text; rounds take one share after the other, so 1 / masked of them take every place."""
    ends = np.array([len(ids)]) if ends is None else ends
    lengths = np.diff(ends, prepend=0)
    place = np.arange(len(ids)) - np.repeat(ends - lengths, lengths)
    mix = place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids.astype(np.uint64)
    mix = (mix ^ (mix >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.flatnonzero(((mix >> np.uint64(32)) / 2.0**32 + number * masked) % 1 < masked)


def added(rows: DataFrame) -> DataFrame:
    """part, value: the sums of the rows' arrays of 64-bit whole numbers (columns part, salt, value), of some rows first."""

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v.as_py(), np.int64) for v in table["value"]], axis=0)
        return pa.table({"part": table["part"][:1], "value": pa.array([total.tobytes()], pa.binary())})

    some = rows.groupBy("part", "salt").applyInArrow(add, "part int, value binary")
    return some.groupBy("part").applyInArrow(add, "part int, value binary")


def trained(rows: DataFrame, known: Vocabulary, shape: Shape | None = None, rounds: int = ROUNDS, masked: float = MASKED, rate: float = RATE) -> np.ndarray:
    """The parameters after all rounds over all rows of ``as_ids``."""
    shape = shape or Shape()
    vector = initial(shape, known.counts)
    for number in range(rounds):
        start = vector.astype(np.float32)

        def learn(batches: Iterator[pa.RecordBatch], start=start, number=number) -> Iterator[pa.RecordBatch]:
            mine, grad, past = start.copy(), np.zeros_like(start), np.full_like(start, 1e-4)
            parts, grads, seen, salt = shape.views(mine), shape.views(grad), 0, 0
            for _, ids, ends, _ in _stretches(batches, 0):
                places = masked_places(ids, number, masked, ends)
                if not len(places):
                    continue
                near = contexts(ids, ends, shape, places)
                for a in range(0, len(places), STEP):
                    gradient(parts, grads, near[a : a + STEP], ids[places[a : a + STEP]])
                    past += grad * grad
                    mine -= rate * grad / np.sqrt(past)
                seen += len(places)
                salt = (salt * 31 + zlib.crc32(ids.tobytes())) % SALTS
            if seen:
                moved = np.rint((mine.astype(np.float64) - start) * seen * SCALE).astype(np.int64)
                pieces = [p.tobytes() for p in np.split(np.append(moved, seen), range(PIECE, shape.size + 1, PIECE))]
                part = np.arange(len(pieces), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), salt, np.int32)), pa.array(pieces, pa.binary())], names=["part", "salt", "value"])

        # As many numbers as there are parameters, whatever the input.
        pieces = added(rows.select("ids").mapInArrow(learn, "part int, salt int, value binary")).collect()
        if not pieces:
            break
        sums = np.concatenate([np.frombuffer(r["value"], np.int64) for r in sorted(pieces, key=lambda r: r["part"])])
        vector = vector + sums[:-1] / (float(sums[-1]) * SCALE)
    return vector


def scored(rows: DataFrame, known: Vocabulary, vector: np.ndarray, shape: Shape | None = None) -> DataFrame:
    """doc_id, n_words, score (sum of log-probabilities) and mean_score of every row of ``as_ids``."""
    shape = shape or Shape()
    numbers = vector.astype(np.float32)
    schema = T.StructType([rows.schema["doc_id"], rows.schema["n_words"], T.StructField("own", T.DoubleType()), rows.schema["row"]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, whole = shape.views(numbers), []

        def kept() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole.append(batch)
                yield batch

        for number, ids, ends, at in _stretches(kept(), 2):
            sums = np.zeros(len(at))
            near = contexts(ids, ends, shape)
            for a in range(0, len(ids), TOGETHER):
                piece = log_probabilities(parts, near[a : a + TOGETHER], ids[a : a + TOGETHER])
                sums += np.bincount(np.searchsorted(ends, np.arange(a, a + len(piece)), "right"), piece, len(at))
            mine = whole[number].take(pa.array(at))
            whole[:number] = [None] * number
            sums += mine.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([mine.column(0), mine.column(1), pa.array(sums), mine.column(4)], names=schema.names)

    network = rows.select("doc_id", "n_words", "ids", "shares", "row").mapInArrow(score, schema)
    buckets = [F.split(F.lit(",".join(str(int(x)) for x in v[shape.words :])), ",").cast("array<bigint>") for v in (known.counts, known.kinds)]
    bucket = F.pmod(F.crc32("word"), F.lit(shape.hashed)).cast("int")
    asked = rows.select("row", F.explode("rare").alias("word")).join(known.table, "word", "left")
    asked = asked.select("row", F.log(share(F.coalesce("n", F.lit(0)), F.get(buckets[0], bucket), F.get(buckets[1], bucket))).alias("share"))
    shares = asked.groupBy("row").agg(F.sum("share").alias("share"))
    total = (F.col("own") + F.coalesce("share", F.lit(0.0))).alias("score")
    found = network.join(shares, "row", "left").select("doc_id", "n_words", total)
    return found.withColumn("mean_score", F.col("score") / F.greatest("n_words", F.lit(1)))


def pseudo_likelihood(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shape: Shape | None = None) -> DataFrame:
    """Vocabulary, training and scores over the same documents."""
    known = vocabulary(docs, text, shape)
    rows = as_ids(docs, known, text, id_col, shape)
    return scored(rows, known, trained(rows, known, shape), shape)
