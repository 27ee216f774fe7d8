"""Product codes of vectors, trained by Lloyd rounds over partition-local cover trees.

Vectors become whole numbers floor(SCALE * x) and are cut into PARTS consecutive
parts. Every task builds a cover tree for each part of up to CHUNK of its vectors and
writes it to the shared folder once: points in tree order, so that a subtree is a
stretch of them; its first point is its centre, its radius the distance of its farthest
point; children cover it with half the radius. Sums over any subtree are differences of
cumulative sums.

A round sends the codebooks (ENTRIES whole vectors) to all trees. A subtree whose
nearest entry is nearer than the second by more than twice the radius goes to it as a
whole, by the triangle inequality; the others descend, and at the end the points of
undecided leaves are compared exactly. Only sums and counts of the entries leave a
task; Spark adds them up and the driver gets one number for each entry and dimension.

Defined cases: rows go whose vector is null, empty, holds null or a number that is not
finite, or has another length than the one with the smallest id. A length that PARTS
does not divide is cut at floor(i * length / PARTS). Components beyond 2**26 after
scaling saturate there, so that all sums fit 64 bits. With fewer than ENTRIES vectors
the codebooks are that small. Equal ids keep a row each; the smallest are told apart by
their vectors, a null id comes last. Null labels add up together. An empty table gives
an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import ship, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LIMIT = 1 << 26
# Vectors in the trees of one row, and points of a node that is not divided further.
CHUNK = 1 << 15
LEAF = 32
# Rounding of distances, as a share of them.
SLACK = 1e-9


def cuts(length: int, parts: int = PARTS) -> list[int]:
    """Where the parts begin, and the length."""
    return [i * length // parts for i in range(parts + 1)]


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Between rows of the same number, in doubles."""
    gap = points.astype(np.float64) - centres
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


@dataclass
class CoverTree:
    """Points in tree order; nodes as stretches of them, the children of a node side by side."""

    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, leaf: int = LEAF) -> CoverTree:
        order = np.arange(len(points))
        start, end = [np.array([0])], [np.array([len(points)])]
        radius = [np.array([_distances(points, points[:1]).max(initial=0.0)])]
        child, children, made, first = [], [], 1, 0
        while made > first:
            s, e, r = start[-1], end[-1], radius[-1]
            divided = np.flatnonzero((e - s > leaf) & (r > 0))
            own, count = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
            if len(divided):
                sizes = (e - s)[divided]
                group = np.repeat(np.arange(len(divided)), sizes)
                at = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(s[divided], sizes)
                members = order[at]
                number = cls._covered(points[members], group, r[divided] / 2)
                moved = np.lexsort((number, group))
                order[at] = members[moved]
                group, number = group[moved], number[moved]
                heads = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (number[1:] != number[:-1])])
                ends = np.r_[heads[1:], len(group)]
                sizes = ends - heads
                centres = points[order[at[heads]]]
                far = _distances(points[order[at]], np.repeat(centres, sizes, axis=0))
                count[divided] = np.bincount(group[heads], minlength=len(divided))
                own[divided] = made + np.r_[0, np.cumsum(count[divided])[:-1]]
                start.append(at[heads])
                end.append(at[heads] + sizes)
                radius.append(np.maximum.reduceat(far, heads))
            child.append(own)
            children.append(count)
            first, made = made, made + int(count.sum())
        radius = np.concatenate(radius) * (1 + SLACK)
        return cls(points[order], order, *map(np.concatenate, (start, end)), radius, *map(np.concatenate, (child, children)))

    @staticmethod
    def _covered(points: np.ndarray, group: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """The number of the child of each point: the first uncovered point of a group covers those within reach."""
        number, left, turn = np.zeros(len(points), np.int64), np.arange(len(points)), 0
        while len(left):
            own = group[left]
            heads = np.r_[True, own[1:] != own[:-1]]
            centre = left[heads][np.cumsum(heads) - 1]
            near = _distances(points[left], points[centre]) <= reach[own]
            number[left[near]] = turn
            left, turn = left[~near], turn + 1
        return number

    def assigned(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, their entry) of subtrees that go as a whole, and the leaves left to compare."""
        whole, codes, leaves = [], [], []
        # Of equal entries the first wins every tie.
        _, different = np.unique(entries, axis=0, return_index=True)
        different.sort()
        centres = entries[different].astype(np.float64)
        nodes = np.array([0]) if len(self.points) else np.array([], np.int64)
        while len(nodes):
            gap = self.points[self.start[nodes]].astype(np.float64)[:, None, :] - centres
            apart = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
            best = apart.argmin(axis=1)
            nearest = apart[np.arange(len(nodes)), best]
            if len(different) > 1:
                second = np.partition(apart, 1, axis=1)[:, 1]
                sure = second - nearest > 2 * self.radius[nodes] + SLACK * (second + nearest)
            else:
                sure = np.ones(len(nodes), bool)
            whole.append(nodes[sure])
            codes.append(different[best[sure]])
            rest = nodes[~sure]
            inner = self.children[rest] > 0
            leaves.append(rest[~inner])
            nodes = _stretches(self.child[rest[inner]], self.children[rest[inner]])
        return tuple(np.concatenate(x) if x else np.array([], np.int64) for x in (whole, codes, leaves))

    def codes(self, entries: np.ndarray) -> np.ndarray:
        """Nearest entry of every point, in tree order; ties go to the lower index."""
        whole, codes, leaves = self.assigned(entries)
        out = np.zeros(len(self.points), np.int64)
        sizes = (self.end - self.start)[whole]
        out[_stretches(self.start[whole], sizes)] = np.repeat(codes, sizes)
        at = _stretches(self.start[leaves], (self.end - self.start)[leaves])
        out[at] = nearest_entry(self.points[at], entries)
        return out

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums and counts of the points by nearest entry; whole subtrees by cumulative sums."""
        whole, codes, leaves = self.assigned(entries)
        points = self.points.astype(np.int64)
        running = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)))
        at = _stretches(self.start[leaves], (self.end - self.start)[leaves])
        codes = np.concatenate((codes, nearest_entry(self.points[at], entries)))
        sums = np.concatenate((running[self.end[whole]] - running[self.start[whole]], points[at]))
        counts = np.concatenate(((self.end - self.start)[whole], np.ones(len(at), np.int64)))
        totals, number = np.zeros((len(entries), points.shape[1]), np.int64), np.zeros(len(entries), np.int64)
        np.add.at(totals, codes, sums)
        np.add.at(number, codes, counts)
        return totals, number

    def packed(self) -> bytes:
        small = np.int16 if len(self.points) == 0 or np.abs(self.points).max() < 1 << 15 else np.int32
        out = io.BytesIO()
        np.savez(out, points=self.points.astype(small), radius=self.radius, **{k: getattr(self, k).astype(np.int32) for k in ("order", "start", "end", "child", "children")})
        return out.getvalue()

    @classmethod
    def unpacked(cls, held: bytes) -> CoverTree:
        with np.load(io.BytesIO(held)) as arrays:
            return cls(**{k: arrays[k] for k in ("points", "order", "start", "end", "radius", "child", "children")})


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of stretches, one after the other."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def nearest_entry(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """By exact squared distance; argmin takes the first of equals."""
    most = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) + 1
    # Doubles are exact up to 2**53, and their products are faster.
    kind = np.float64 if 4 * int(most) ** 2 * max(points.shape[1], 1) < 1 << 53 else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return ((e * e).sum(axis=1) - 2 * (p @ e.T)).argmin(axis=1)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def usable(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and vector of the rows that take part."""
    kept = rows.select(F.col(id_col).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")).filter(
        F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector").alias("n")).limit(1).collect()
    return kept.filter(F.size("vector") == (first[0]["n"] if first else 0))


def trees(kept: DataFrame) -> DataFrame:
    """vec_ids, labels and packed cover trees, a row for each CHUNK of a task's vectors."""
    ship(kept.sparkSession)
    id_type, label_type = kept.schema["vec_id"].dataType, kept.schema["label"].dataType
    schema = T.StructType([T.StructField("vec_ids", T.ArrayType(id_type)), T.StructField("labels", T.ArrayType(label_type)), T.StructField("trees", T.ArrayType(T.BinaryType()))])
    arrow = _arrow(schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, n = [], [], [], 0

        def full() -> pa.RecordBatch:
            values = whole_numbers(np.concatenate(vectors))
            edges = cuts(values.shape[1])
            packed = [CoverTree.of(values[:, a:b]).packed() for a, b in zip(edges, edges[1:], strict=False)]
            row = [pa.concat_arrays(ids).to_pylist(), pa.concat_arrays(labels).to_pylist(), packed]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                if n and n + part.num_rows > CHUNK:
                    yield full()
                    ids, labels, vectors, n = [], [], [], 0
                ids.append(part.column(0))
                labels.append(part.column(1))
                vectors.append(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
                n += part.num_rows
        if n:
            yield full()

    return kept.select("vec_id", "label", "vector").mapInArrow(build, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def first_codebooks(kept: DataFrame, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids."""
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    values = whole_numbers(np.array([s["vector"] for s in seeds]))
    edges = cuts(values.shape[1])
    return [values[:, a:b] for a, b in zip(edges, edges[1:], strict=False)]


def refined(built: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every entry becomes the mean, rounded down, of the parts nearest to it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [(np.zeros(b.shape, np.int64), np.zeros(len(b), np.int64)) for b in books]
        for batch in batches:
            for row in batch.column(0):
                for i, held in enumerate(row.as_py()):
                    for total, more in zip(totals[i], CoverTree.unpacked(held).sums(books[i]), strict=True):
                        total += more
        part = np.concatenate([np.full(len(b), i) for i, b in enumerate(books)])
        entry = np.concatenate([np.arange(len(b)) for b in books])
        # The count stands before the sums.
        sums = [row for total, count in totals for row in np.column_stack((count, total)).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(sums, pa.list_(pa.int64()))], names=["part", "entry", "sums"])

    added = built.select("trees").mapInArrow(add, "part int, entry int, sums array<long>")
    spread = added.select("part", "entry", F.posexplode("sums").alias("place", "value")).filter("value <> 0")
    totals = {(r["part"], r["entry"], r["place"]): r["value"] for r in spread.groupBy("part", "entry", "place").agg(F.sum("value").alias("value")).collect()}
    out = [b.copy() for b in books]
    for i, book in enumerate(out):
        for j in range(len(book)):
            if count := totals.get((i, j, 0)):
                book[j] = [totals.get((i, j, k + 1), 0) // count for k in range(book.shape[1])]
    return out


def coded(built: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector in the trees."""
    schema = T.StructType([
        T.StructField("vec_id", built.schema["vec_ids"].dataType.elementType), T.StructField("label", built.schema["labels"].dataType.elementType),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])
    arrow = _arrow(schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
                error, codes = np.zeros(len(ids), np.int64), np.zeros((len(ids), len(books)), np.uint8)
                for k, held in enumerate(batch.column(2)[i].as_py()):
                    tree = CoverTree.unpacked(held)
                    found = tree.codes(books[k])
                    gap = tree.points.astype(np.int64) - books[k][found]
                    error[tree.order] += (gap * gap).sum(axis=1)
                    codes[tree.order, k] = found
                columns = [ids, labels, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return built.select("vec_ids", "labels", "trees").mapInArrow(encode, schema)


def digest(books: list[np.ndarray]) -> str:
    """Of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compressed(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code, error and label_error of every row that takes part, and the final codebooks."""
    kept = usable(rows, id_col, vector, label)
    built = stored(trees(kept), "cover-trees")
    books = first_codebooks(kept, entries) if built.limit(1).count() else []
    for _ in range(rounds if books else 0):
        books = refined(built, books)
    codes = stored(coded(built, books), "vector-codes")
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return codes.join(totals, codes["label"].eqNullSafe(totals["of"])).drop("of"), books
