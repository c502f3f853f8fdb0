"""Exact ranked lexical search of a set of items in all documents, by a dual-tree search."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sinks.staging import stage

# Items are searched in blocks of about so many bytes of text, which bounds a block's terms.
BLOCK_BYTES = 8 << 20
# Documents in a leaf of their tree, children of a node of either tree, documents and terms per tree.
LEAF_DOCS = 32
FAN_OUT = 8
TREE_DOCS = 32_768
TREE_TERMS = 4_000_000
# One in so many documents is searched beforehand, to have weakest scores to prune by from the start.
SEED_SHARE = 16

_VECTORS = "doc_id long, n long, dims array<int>, tfs array<int>"

# Letters and digits of ASCII, A-Z lower-cased, and all else that is not ASCII; the rest ends terms.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM_BYTES).split()


@dataclass
class Rows:
    """Sparse non-negative rows: row r has ``values`` in ``dims`` from bounds[r] to bounds[r + 1]."""

    bounds: np.ndarray
    dims: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def row(self, r: int) -> slice:
        return slice(self.bounds[r], self.bounds[r + 1])

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        bounds = np.append(0, np.cumsum(sizes))
        at = np.repeat(self.bounds[rows] - bounds[:-1], sizes) + np.arange(bounds[-1])
        return Rows(bounds, self.dims[at], self.values[at])

    def products(self, other: np.ndarray) -> np.ndarray:
        """Inner product of every row with a dense vector."""
        sums = np.append(0, np.cumsum(self.values * other[self.dims]))
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def maxima(self, children: int) -> Rows:
        """One row per ``children`` rows: the largest value of each coordinate."""
        parent = np.repeat(np.arange(len(self)) // children, np.diff(self.bounds))
        order = np.lexsort((self.dims, parent))
        parent, dims, values = parent[order], self.dims[order], self.values[order]
        first = np.flatnonzero(np.append(True, (parent[1:] != parent[:-1]) | (dims[1:] != dims[:-1]))[: len(dims)])
        nodes = -(-len(self) // children)
        held = np.maximum.reduceat(values, first) if len(first) else values
        return Rows(np.searchsorted(parent[first], np.arange(nodes + 1)), dims[first], held)

    def by_rarest(self, weights: np.ndarray) -> np.ndarray:
        """An order in which rows that share their heaviest coordinates lie together."""
        leads = np.zeros((3, len(self)), np.int64)
        for r in range(len(self)):
            dims = self.dims[self.row(r)]
            best = dims[np.lexsort((dims, -weights[dims]))[:3]]
            leads[: len(best), r] = best + 1
        return np.lexsort(leads[::-1])


def tree(rows: Rows, leaf: int) -> list[Rows]:
    """Levels of coordinate maxima, the rows themselves first, the root last; the first level above has ``leaf`` rows a node."""
    levels, children = [rows], leaf
    while len(levels[-1]) > 1 or len(levels) == 1:
        levels.append(levels[-1].maxima(children))
        children = FAN_OUT
    return levels


class Ranking:
    """The k best documents of each item so far: highest score first, then smallest id, null ids last."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in floors
        ]
        #: a document must reach this to be among an item's k best
        self.weakest = floors.copy()

    def add(self, item: int, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        rows = [np.concatenate(pair) for pair in zip(self.kept[item], (scores, missing, ids))]
        order = np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]
        self.kept[item] = tuple(x[order] for x in rows)
        if len(order) == self.k:
            self.weakest[item] = max(self.floors[item], self.kept[item][0][-1])


def search(items: list[Rows], docs: Rows, ids: np.ndarray, missing: np.ndarray, weights: np.ndarray, found: Ranking) -> None:
    """Add the documents to the ranking of every item they are among the best of.

    ``items`` is the items' tree. A pair of nodes is left out if the inner product of their coordinate
    maxima, which no pair of their rows exceeds, is below the weakest k-th score of the node's items. Nothing else is left out.
    """
    order = docs.by_rarest(weights)
    docs, ids, missing = docs.take(order), ids[order], missing[order]
    levels = tree(docs, LEAF_DOCS)
    dense = np.zeros(len(weights), np.int64)

    def bounds(rows: Rows, r: int, of: Rows) -> np.ndarray:
        part = rows.row(r)
        dense[rows.dims[part]] = rows.values[part]
        out = of.products(dense)
        dense[rows.dims[part]] = 0
        return out

    def weakest(depth: int, nodes: np.ndarray) -> np.ndarray:
        """Of each item node the least that any of its items asks for."""
        width = FAN_OUT**depth
        return np.array([found.weakest[n * width : (n + 1) * width].min() for n in nodes])

    def opened(depth: int, nodes: np.ndarray) -> np.ndarray:
        inner = (nodes[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
        return inner[inner < len(items[depth - 1])]

    def reach(level: int, node: int, depth: int, nodes: np.ndarray) -> np.ndarray:
        return bounds(levels[level], node, items[depth].take(nodes))

    def score(node: int, nodes: np.ndarray) -> None:
        rows = items[0].take(nodes)
        inside = range(node * LEAF_DOCS, min(len(docs), (node + 1) * LEAF_DOCS))
        scores = np.array([bounds(docs, d, rows) for d in inside]).T
        at = np.arange(inside.start, inside.stop)
        for item in np.flatnonzero((scores >= found.weakest[nodes][:, None]).any(axis=1)):
            good = scores[item] >= found.weakest[nodes[item]]
            found.add(int(nodes[item]), scores[item][good], missing[at[good]], ids[at[good]])

    def visit(level: int, node: int, depth: int, nodes: np.ndarray) -> None:
        """Documents below ``node`` against items below ``nodes``, which have passed at their depths."""
        if level == 1:
            while depth and len(nodes):
                nodes = opened(depth, nodes)
                depth -= 1
                nodes = nodes[reach(level, node, depth, nodes) >= weakest(depth, nodes)]
            if len(nodes):
                score(node, nodes)
            return
        if depth:
            nodes = opened(depth, nodes)
            depth -= 1
        below = range(node * FAN_OUT, min(len(levels[level - 1]), (node + 1) * FAN_OUT))
        # the most promising first: their scores prune the others
        reached = [(child, reach(level - 1, child, depth, nodes)) for child in below]
        for child, at_most in sorted(reached, key=lambda r: -r[1].max()):
            left = nodes[at_most >= weakest(depth, nodes)]
            if len(left):
                visit(level - 1, child, depth, left)

    visit(len(levels) - 1, 0, len(items) - 1, np.arange(len(items[-1])))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term's occurrences in a document of ``n`` terms are worth, per unit of the term's weight."""
    # The constants of the score.
    m = 100 - 75 + (75 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def term_weight(documents: int, held: int) -> int:
    # Fixed value: the scale of the weights.
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


def _vectors(docs: DataFrame, terms: Sequence[bytes]) -> DataFrame:
    """Every document that has a term: its number of terms, and how often it has each of ``terms``."""
    numbers = docs.sparkSession.sparkContext.broadcast({t: n for n, t in enumerate(terms)})
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for part in parts:
            for at in range(0, part.num_rows, 512):
                few = part.slice(at, 512)
                ids, lengths, bounds, dims, tfs = [], [], [0], [], []
                for doc_id, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
                    words = terms_of(text)
                    if not words:
                        continue
                    known = [d for d in map(number, words) if d is not None]
                    dim, tf = np.unique(np.array(known, np.int32), return_counts=True)
                    ids.append(doc_id)
                    lengths.append(len(words))
                    dims.append(dim)
                    tfs.append(tf.astype(np.int32))
                    bounds.append(bounds[-1] + len(dim))
                none = [np.zeros(0, np.int32)]
                offsets = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(none + dims))),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(none + tfs))),
                    ],
                    names=["doc_id", "n", "dims", "tfs"],
                )

    return rows.mapInArrow(count, _VECTORS)


def _trees(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """As many documents as one tree takes."""
    held: list[pa.RecordBatch] = []
    docs = terms = 0
    for part in parts:
        for at in range(0, part.num_rows, 1024):
            few = part.slice(at, 1024)
            held.append(few)
            docs += few.num_rows
            terms += len(few.column("dims").flatten())
            if docs >= TREE_DOCS or terms >= TREE_TERMS:
                yield pa.Table.from_batches(held)
                held, docs, terms = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _ranked(vectors: DataFrame, shared, k: int) -> DataFrame:
    """(item, doc_id, score): of every task's documents the k best of each item; ``shared`` is what tasks need to know."""

    def rank(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, floors, documents, length = shared.value
        found = Ranking(floors, k)
        for part in _trees(parts):
            part = part.combine_chunks()
            sizes = part.column("dims").combine_chunks().value_lengths().to_numpy()
            dims = part.column("dims").combine_chunks().flatten().to_numpy().astype(np.int64)
            tfs = part.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            n = np.repeat(part.column("n").to_numpy(), sizes)
            rows = Rows(np.append(0, np.cumsum(sizes)), dims, impacts(tfs, n, documents, length))
            ids = part.column("doc_id")
            missing = ids.is_null().to_numpy()
            search(items, rows, ids.fill_null(0).to_numpy(), missing, weights, found)
        for item, (scores, missing, ids) in enumerate(found.kept):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item)), pa.array(ids, mask=missing), pa.array(scores)],
                    names=["item", "doc_id", "score"],
                )

    return vectors.mapInArrow(rank, "item long, doc_id long, score long")


def _best(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, block: Sequence[tuple], k: int) -> DataFrame | None:
    """(item, doc_id, score, rank) for the items of one block, by their places in it."""
    spark = docs.sparkSession
    bags = [terms_of(text) for _, text in block]
    terms = sorted({t for bag in bags for t in bag})
    if not terms:
        return None
    number = {t: n for n, t in enumerate(terms)}
    vectors = stage(_vectors(docs, terms), "term_counts")
    totals = vectors.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    if not totals.documents:
        return None
    held = vectors.select(F.explode("dims").alias("dim")).groupBy("dim").agg(F.count("*").alias("held")).toPandas()
    weights = np.full(len(terms), term_weight(totals.documents, 0), np.int64)
    weights[held["dim"].to_numpy(np.int64)] = [term_weight(totals.documents, n) for n in held["held"].tolist()]

    bounds, dims, values = [0], [], []
    for bag in bags:
        dim, times = np.unique(np.array([number[t] for t in bag], np.int64), return_counts=True)
        bounds.append(bounds[-1] + len(dim))
        dims.append(dim)
        values.append(times * weights[dim])
    rows = Rows(np.array(bounds), np.concatenate(dims), np.concatenate(values))
    order = rows.by_rarest(weights)
    items = tree(rows.take(order), FAN_OUT)
    floors = np.ones(len(block), np.int64)

    def told():
        return spark.sparkContext.broadcast((items, weights, floors, totals.documents, totals.length))

    few = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_SHARE)) == 0)
    # a k-th best score among some documents is one that the k-th best of all reaches
    for row in _best(_ranked(few, told(), k), k).where(F.col("rank") == k).select("item", "score").collect():
        floors[row.item] = max(1, row.score)
    best = _best(_ranked(vectors, told(), k), k)
    places = [(n, int(at)) for n, at in enumerate(order)]
    named = spark.createDataFrame([(n, block[at][0]) for n, at in places], "item long, item_id long")
    # as many rows as the block has items
    return best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of every item: (item_id, rank from 1, doc_id, score), scores above 0 only.

    ``docs`` has doc_id (integer) and text, ``items`` item_id (integer) and text; other columns are ignored.
    A document's score for an item sums, over the item's terms with repeats, a weight that falls with the documents
    holding the term times an impact that rises with its occurrences (``term_weight``, ``impacts``).
    Equal scores rank by ascending doc_id, null ids last.

    Documents become vectors of the items' terms, written once. Every task builds hierarchies of
    coordinate maxima over its documents, TREE_DOCS at a time, and searches them with the items' hierarchy; node pairs that can't
    reach the items' weakest k-th scores are pruned, so the answer is exact. A sample is searched first, whose k-th scores
    only make pruning start early. Tasks return k rows an item at most; a window ranks these. Items are searched in blocks
    of about ``block_bytes``, so what is broadcast (terms, items, a number per item) has that bound whatever the tables' sizes.

    Null and empty texts, and those of other characters only, have no terms: such documents count nowhere, such items get no
    rows. Repeated rows of documents are documents of their own; equal rows of items count once, and rows that share an
    item_id but not the text are items of their own. Empty tables give no rows.
    """
    spark = docs.sparkSession
    distinct = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = distinct.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    if blocks > 1:
        dealt = stage(dealt, "items")
    found = None
    for n in range(blocks):
        block = [(row.item_id, row.text) for row in dealt.where(F.col("block") == n).collect()]
        block.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        part = _search_block(docs, block, k) if block else None
        if part is not None:
            found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found
