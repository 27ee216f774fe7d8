"""Ranked lexical search by branch and bound in trees of documents.

Every document is cut down to the terms that some item holds. A task puts up to CELLS
such (document, term) cells into a tree: terms stand in the order of their document
frequency, the commonest first, so that documents that agree in their first terms share a
path; paths without a fork are one node, and a node of at most LEAF documents is not
divided further. A node keeps, for each term below it, the greatest tf of a document, and
the least length norm m. A score grows with tf and falls with m, so these bound what any
document below can reach. Each item goes depth first, best child first, and leaves out
what stays below its K best documents so far. The K best of each tree meet in a window
over the item; the task's earlier trees already set the limit for the later ones.

Items are taken in blocks of about BLOCK_BYTES of text, which tasks hold as a whole;
the documents are read once for each block.

Defined cases: a null text has no terms. Rows that agree in item_id and text are one
item; texts of one item_id are ranked each by itself. Every document row is ranked, so
repeated rows take a rank each; of equal scores a null doc_id comes last. Items without
terms, empty tables on either side and scores of 0 give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import ship, stored, text_key

BEST = 10
LEAF = 48
CELLS = 4_000_000
BLOCK_BYTES = 8 << 20

_TERM_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all bytes beyond ASCII, A-Z lowered."""
    return text.translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def share(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


class DocumentTree:
    """Restricted term vectors of documents in a trie, with bounds at every node."""

    def __init__(self, ids: list, norms: np.ndarray, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, leaf: int = LEAF):
        """Cells of document i are starts[i]:starts[i + 1], in ascending order of terms."""
        self.ids, order, lengths = ids, np.arange(len(norms)), np.diff(starts)
        low, high = [np.array([0])], [np.array([len(norms)])]
        self.child, self.children = np.zeros(1, np.int64), np.zeros(1, np.int64)
        made = 1
        nodes, depth = (np.array([0]), np.array([0])) if len(norms) > leaf else (np.array([], np.int64),) * 2
        lows, highs = low[0], high[0]
        while len(nodes):
            sizes = highs - lows
            group = np.repeat(np.arange(len(nodes)), sizes)
            at = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lows, sizes)
            members, deep = order[at], depth[group]
            # -1 for documents whose path has ended.
            inside = deep < lengths[members]
            key = np.where(inside, terms[np.where(inside, starts[members] + deep, 0)], -1)
            moved = np.lexsort((key, group))
            order[at] = members[moved]
            group, key = group[moved], key[moved]
            heads = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
            ends, owner = np.r_[heads[1:], len(group)], group[heads]
            forks = np.bincount(owner, minlength=len(nodes))
            single = forks[owner] == 1
            further = single & (key[heads] >= 0)
            stay = owner[further]
            new = np.flatnonzero(~single)
            first = made + np.arange(len(new))
            self.child = np.r_[self.child, np.zeros(len(new), np.int64)]
            self.children = np.r_[self.children, np.zeros(len(new), np.int64)]
            forked = np.flatnonzero(forks > 1)
            self.children[nodes[forked]] = forks[forked]
            self.child[nodes[forked]] = made + np.r_[0, np.cumsum(forks[forked])[:-1]] if len(forked) else 0
            new_low = at[heads[new]]
            new_high = new_low + (ends - heads)[new]
            low.append(new_low)
            high.append(new_high)
            made += len(new)
            again = (new_high - new_low > leaf) & (key[heads[new]] >= 0)
            nodes, depth, lows, highs = (
                np.concatenate(x)
                for x in (
                    (nodes[stay], first[again]), (depth[stay] + 1, depth[owner[new[again]]] + 1),
                    (lows[stay], new_low[again]), (highs[stay], new_high[again]),
                )
            )
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        # Cells in tree order, so that those of a node stand together.
        sizes = lengths[order]
        self.starts = np.r_[0, np.cumsum(sizes)]
        cells = np.arange(self.starts[-1]) - np.repeat(self.starts[:-1], sizes) + np.repeat(starts[:-1][order], sizes)
        self.order, self.norms, self.terms, self.tfs = order, norms[order], terms[cells], tfs[cells]
        self._bounds([len(x) for x in low])

    def _bounds(self, batches: list[int]) -> None:
        """Greatest tf of each term below each node, and the least norm."""
        n_terms = int(self.terms.max(initial=0)) + 1
        owners, terms, tfs, first = [np.array([], np.int64)], [np.array([], np.int64)], [np.array([], np.int64)], 0
        self.least = np.zeros(len(self.low), np.int64)
        for size in batches:
            nodes = np.arange(first, first + size)
            first += size
            a, b = self.starts[self.low[nodes]], self.starts[self.high[nodes]]
            at = np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
            key = np.repeat(nodes, b - a) * n_terms + self.terms[at]
            sort = np.argsort(key, kind="stable")
            key = key[sort]
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.array([], np.int64)
            owners.append(key[heads] // n_terms)
            terms.append(key[heads] % n_terms)
            tfs.append(np.maximum.reduceat(self.tfs[at][sort], heads) if len(heads) else np.array([], np.int64))
            for node in nodes:
                self.least[node] = self.norms[self.low[node] : self.high[node]].min(initial=1 << 62)
        owners = np.concatenate(owners)
        self.node_terms, self.node_tfs = np.concatenate(terms), np.concatenate(tfs)
        self.node_starts = np.searchsorted(owners, np.arange(len(self.low) + 1))

    def _scores(self, weights: np.ndarray, starts: np.ndarray, norms: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """Weighted shares of stretches of cells, each with its norm."""
        a, b = starts[0], starts[-1]
        own = weights[terms[a:b]]
        met = np.flatnonzero(own)
        at = np.searchsorted(starts - a, met, side="right") - 1
        parts = np.zeros(len(norms), np.int64)
        np.add.at(parts, at, own[met] * share(tfs[a:b][met], norms[at]))
        return parts

    def search(self, weights: np.ndarray, best: list, k: int = BEST) -> tuple[list, int]:
        """The k best (score, id), given the best so far, and the number of documents scored."""
        scored, stack = 0, [(None, 0)]
        while stack:
            bound, node = stack.pop()
            if bound is not None and (bound <= 0 or len(best) == k and bound < best[-1][0]):
                continue
            if n := int(self.children[node]):
                c = int(self.child[node])
                bounds = self._scores(weights, self.node_starts[c : c + n + 1], self.least[c : c + n], self.node_terms, self.node_tfs)
                stack.extend((int(bounds[i]), c + int(i)) for i in np.argsort(bounds, kind="stable"))
                continue
            a, b = self.low[node], self.high[node]
            scores = self._scores(weights, self.starts[a : b + 1], self.norms[a:b], self.terms, self.tfs)
            scored += int(b - a)
            good = np.flatnonzero(scores >= max(1, best[-1][0] if len(best) == k else 1))
            if len(good):
                best = sorted(best + [(int(scores[i]), self.ids[self.order[a + i]]) for i in good], key=_rank)[:k]
        return best, scored


def _rank(found: tuple) -> tuple:
    score, doc_id = found
    return (-score, doc_id is None, 0 if doc_id is None else doc_id)


def restricted(docs: DataFrame, known: dict[bytes, int], text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n (all terms), and terms with their tf among the known ones, of every document with a term."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, terms, tfs, ends = [], [], [], [], [0]
            for i, one in enumerate(batch.column(1).cast(pa.binary())):
                words = terms_of(one.as_py())
                if words:
                    own = Counter(map(known.__getitem__, filter(known.__contains__, words)))
                    kept.append(i)
                    sizes.append(len(words))
                    terms.extend(own.keys())
                    tfs.extend(own.values())
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    kinds = (("doc_id", rows.schema["doc_id"].dataType), ("n", T.LongType()), ("terms", T.ArrayType(T.IntegerType())), ("tfs", T.ArrayType(T.IntegerType())))
    return rows.mapInArrow(cut, T.StructType([T.StructField(*k) for k in kinds]))


def _best_of_tasks(vectors: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], rank: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """query, doc_id and score of each task's best. A query is its terms and weights; rank orders terms by frequency."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cells = [], 0
        best: list[list] = [[] for _ in queries]

        def looked_up() -> None:
            ids = pa.concat_arrays([b.column(0) for b in held]).to_pylist()
            n = np.concatenate([b.column(1).to_numpy() for b in held])
            lists = [pa.concat_arrays([b.column(c) for b in held]) for c in (2, 3)]
            lengths = np.asarray(lists[0].value_lengths(), np.int64)
            starts = np.r_[0, np.cumsum(lengths)]
            terms, tfs = (np.asarray(x.flatten(), np.int64) for x in lists)
            terms = rank[terms]
            sort = np.lexsort((terms, np.repeat(np.arange(len(n)), lengths)))
            norms = 25 + 75 * n * n_docs // n_terms
            tree = DocumentTree(ids, norms, starts, terms[sort], tfs[sort])
            weights = np.zeros(len(rank) + 1, np.int64)
            for i, (own, values) in enumerate(queries):
                weights[own] = values
                best[i], _ = tree.search(weights, best[i], k)
                weights[own] = 0

        for batch in batches:
            held.append(batch)
            cells += len(batch.column(2).flatten())
            if cells >= CELLS:
                looked_up()
                held, cells = [], 0
        if held:
            looked_up()
        found = [(i, doc_id, score) for i, own in enumerate(best) for score, doc_id in own]
        columns = zip(*found, strict=True) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = vectors.schema["doc_id"].dataType
    kinds = (pa.int32(), to_arrow_type(id_type), pa.int64())
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    return vectors.filter(F.size("terms") > 0).mapInArrow(search, schema)


def _block(docs: DataFrame, items: list[str], text: str, id_col: str, k: int) -> DataFrame | None:
    """query (place of the item) and its best documents of each task, for the texts of one block."""
    counts = [Counter(terms_of(one.encode())) for one in items]
    known = {term: i for i, term in enumerate(sorted(set().union(*counts)))}
    if not known:
        return None
    vectors = stored(restricted(docs, known, text, id_col), "document-terms")
    n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(known), np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(known))
    weights = [weight(n_docs, int(n)) for n in df]
    queries = [(rank[[known[t] for t in own]], np.array([weights[known[t]] * c for t, c in own.items()], np.int64)) for own in counts]
    return _best_of_tasks(vectors, queries, rank, n_docs, n_terms or 1, k)


def ranked(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text", k: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, item_key (tells texts of one id apart), rank, doc_id and score of the k best documents of each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), text_key(F.col(item_text)).alias("item_key"), F.coalesce(F.col(item_text), F.lit("")).alias("item_text")).distinct()
    total = asked.agg(F.sum(F.octet_length("item_text") + 64)).first()[0] or 0
    blocks = -(-total // block_bytes)
    order = Window.partitionBy("item_id", "item_key").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    schema = T.StructType([
        T.StructField("item_id", asked.schema["item_id"].dataType), T.StructField("item_key", T.LongType()), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType()),
    ])
    out = spark.createDataFrame([], schema)
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "item_key"), F.lit(blocks)) == b).orderBy("item_id", "item_key").collect()
        found = _block(docs, [r["item_text"] for r in own], text, id_col, k)
        if found is None:
            continue
        names = spark.createDataFrame([(i, r["item_id"], r["item_key"]) for i, r in enumerate(own)], T.StructType([T.StructField("query", T.IntegerType()), schema["item_id"], schema["item_key"]]))
        named = found.join(F.broadcast(names), "query").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        out = out.unionByName(named.select(*schema.names))
    return out
