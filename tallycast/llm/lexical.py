"""Ranked lexical search of a set of items over all documents, exact, by a dual-tree search.

A document becomes a sparse vector over the terms of the items: saturated
frequencies, which depend on the length of the document. An item is a vector of
term weights times repeats; a score is the inner product of the two, in whole
numbers.

Both sides form hierarchies. A node holds, for each term, the largest coordinate
below it; coordinates are never negative, so the product of two nodes bounds
every score between a document of the one and an item of the other. From the
roots down a pair of nodes is given up when its bound is below the weakest
``top``-th score that an item of the node has so far, and all documents and items
below go with it. What is left at the leaves is scored exactly.

Every task builds the tree of its documents and raises the scores as it goes;
a first search of a small part of the documents gives all tasks scores to beat.
A task hands over at most ``top`` documents an item. Items come in blocks of
bounded size; each block meets all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, give_back, ranges, texts_of
from tallycast.llm.terms import LETTERS_DIGITS, terms_of
from tallycast.session import materialise

# Documents of a leaf, and children of a node of either tree.
LEAF, FAN = 32, 8
# Items of a block times its terms, and leaves of a tree times terms, are at most so many (or one of each).
CELLS = 4 << 20
# A first search of about so many documents gives scores to beat; the result does not depend on it.
FIRST_DOCS = 20_000
# A task cuts what it holds to the best of each item beyond so many rows.
HELD_ROWS = 200_000
# Fixed values of the score: saturation is UNIT * tf div (TF * tf + DOC * (LEAST + SLOPE * n * N div L)).
UNIT, TF, DOC, LEAST, SLOPE, WEIGHT = 10**9, 1000, 12, 75, 25, 1000
LONG = np.iinfo(np.int64).max
HIT_DDL = "slot int, doc_id bigint, score bigint"


@dataclass
class Items:
    """A block of items: ``ids`` of all, ``times[i, t]`` occurrences of term t, and the terms."""

    ids: list
    terms: pa.LargeStringArray
    times: np.ndarray


def item_blocks(items: DataFrame, key: str, text: str, cells: int) -> Iterator[Items]:
    """All items, as many at a time as keep items times terms within ``cells``."""
    ids, found, vocabulary = [], [], {}

    def block() -> Items:
        times = np.zeros((len(ids), len(vocabulary)), np.int64)
        for i, terms in enumerate(found):
            np.add.at(times[i], [vocabulary[t] for t in terms], 1)
        return Items(ids, pa.array(list(vocabulary), pa.large_string()), times)

    for row in items.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator():
        terms = terms_of(pa.array([row["text"] or ""], pa.large_string()), LETTERS_DIGITS)[0].to_pylist()
        wider = len(vocabulary.keys() | set(terms))
        if ids and (len(ids) + 1) * wider > cells:
            yield block()
            ids, found, vocabulary = [], [], {}
        ids.append(row["key"])
        found.append(terms)
        for t in terms:
            vocabulary.setdefault(t, len(vocabulary))
    if ids:
        yield block()


def vectors(docs: DataFrame, terms: pa.LargeStringArray) -> DataFrame:
    """``doc_id``, ``n`` (all its terms) and the numbers and frequencies of the wanted terms, of each document that has a term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms.to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.large_string())
        size = max(1, len(wanted))
        for block in blocks(batches, "text"):
            found, offsets = terms_of(texts_of(block, "text"), LETTERS_DIGITS)
            n = np.diff(offsets)
            coded = found.dictionary_encode()
            place = pc.fill_null(pc.index_in(coded.dictionary, wanted), -1).to_numpy().astype(np.int64)
            place = place[coded.indices.to_numpy()] if len(found) else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(n)), n)
            key = np.sort((doc * size + place)[place >= 0])
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            doc, place = np.divmod(key[starts], size)
            ends = np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in (place.astype(np.int32), np.diff(np.append(starts, len(key))))]
            rows = pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])
            yield rows.filter(pa.array(n > 0))

    return materialise(docs.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"))


def levels_of(rows: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima from the root's children down to ``rows`` themselves; a node is ``FAN`` neighbours of the next level."""
    levels = [rows]
    while len(levels[0]) > FAN:
        levels.insert(0, np.maximum.reduceat(levels[0], np.arange(0, len(levels[0]), FAN), axis=0))
    return levels


@dataclass
class Query:
    """A block of items as tasks need it: weights in tree order, corpus sizes and scores to beat."""

    weights: np.ndarray  # items times terms; whole numbers, as floats where all sums are exact in them
    slots: np.ndarray  # the place of each row of ``weights`` in the block
    docs: int
    length: int
    beat: np.ndarray  # by row of ``weights``
    top: int


def prepared(items: Items, df: dict[int, int], docs: int, length: int, top: int) -> Query:
    weight = [math.floor(WEIGHT * math.log((2 * docs + 2) / (2 * df[t] + 1))) if t in df else 0 for t in range(len(items.terms))]
    weights = items.times * np.array(weight, np.int64)[None, :]
    slots = np.argsort(weights.argmax(1), kind="stable") if weights.size else np.arange(len(weights))
    weights = weights[slots]
    most = int(weights.sum(1).max(initial=0)) * (UNIT // TF)
    return Query(weights.astype(float) if most < 1 << 53 else weights, slots, docs, length, np.ones(len(weights), np.int64), top)


class Search:
    """What one task has found: the best scores of every item, and the documents that reach them."""

    def __init__(self, query: Query) -> None:
        self.query = query
        self.tree = levels_of(query.weights)
        self.best = np.zeros((len(query.slots), query.top), np.int64)
        self.beat = query.beat.copy()
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0
        self.scored = 0  # pairs of a document and an item that no bound gave up

    def weakest(self, level: int) -> np.ndarray:
        """The weakest score to beat below each item node of a level."""
        beat = self.beat
        for _ in range(len(self.tree) - 1 - level):
            beat = np.minimum.reduceat(beat, np.arange(0, len(beat), FAN))
        return beat

    def bounds(self, docs: np.ndarray, level: int, open_: np.ndarray) -> np.ndarray:
        """Bounds of the open pairs of a document level and an item level; -1 for pairs that are given up."""
        rows, cols = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
        out = np.full(open_.shape, -1, np.int64)
        if len(rows) and len(cols):
            bound = (docs[rows] @ self.tree[level][cols].T).astype(np.int64)
            bound[~open_[np.ix_(rows, cols)] | (bound < self.weakest(level)[cols])] = -1
            out[np.ix_(rows, cols)] = bound
        return out

    def descend(self, docs: list[np.ndarray]) -> np.ndarray:
        """Bounds of all pairs of a leaf and an item that are still open."""
        level = 0
        found = self.bounds(docs[0], level, np.ones((len(docs[0]), len(self.tree[0])), bool))
        for depth in range(1, max(len(docs), len(self.tree))):
            if depth < len(docs):
                wide = np.repeat(found >= 0, FAN, axis=0)[: len(docs[depth])]
                found = self.bounds(docs[depth], level, wide)
            if depth < len(self.tree):
                level = depth
                wide = np.repeat(found >= 0, FAN, axis=1)[:, : len(self.tree[depth])]
                found = self.bounds(docs[min(depth, len(docs) - 1)], level, wide)
        return found

    def visit(self, ids: np.ndarray, null: np.ndarray, counts: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        """Search documents, given as ``counts`` entries of ``terms`` and ``values`` each, as one tree."""
        kind, wide = self.query.weights.dtype, self.query.weights.shape[1]
        leaf = np.repeat(np.arange(len(counts)) // LEAF, counts)
        order = np.argsort(leaf * wide + terms, kind="stable")
        key = (leaf * wide + terms)[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        leaves = np.zeros((-(-len(counts) // LEAF), wide), kind)
        leaves.ravel()[key[starts]] = np.maximum.reduceat(values[order], starts)
        found = self.descend(levels_of(leaves))
        ends = np.concatenate([[0], np.cumsum(counts)])
        for at in np.argsort(-found.max(1, initial=-1), kind="stable"):
            cols = np.flatnonzero((found[at] >= 0) & (found[at] >= self.beat))
            if not len(cols):
                continue
            a, b = at * LEAF, min((at + 1) * LEAF, len(counts))
            here, place = np.unique(terms[ends[a] : ends[b]], return_inverse=True)
            dense = np.zeros((b - a, len(here)), kind)
            dense[np.repeat(np.arange(b - a), counts[a:b]), place] = values[ends[a] : ends[b]]
            scores = (self.query.weights[np.ix_(cols, here)] @ dense.T).astype(np.int64)
            self.scored += scores.size
            item, doc = np.nonzero(scores >= self.beat[cols][:, None])
            if not len(item):
                continue
            self.hits.append((cols[item], ids[a:b][doc], null[a:b][doc], scores[item, doc]))
            self.held += len(item)
            both = np.concatenate([self.best[cols], scores], axis=1)
            self.best[cols] = np.partition(both, both.shape[1] - self.query.top, axis=1)[:, -self.query.top :]
            self.beat[cols] = np.maximum(self.beat[cols], self.best[cols].min(1))
            if self.held > HELD_ROWS:
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """Keep the best of every item: by score, then by document, rows without a document last."""
        if not self.hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        item, doc, null, score = (np.concatenate(c) for c in zip(*self.hits))
        order = np.lexsort([doc, null, -score, item])
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[rank < self.query.top]
        self.hits = [(item[order], doc[order], null[order], score[order])]
        self.held = len(order) if len(order) < HELD_ROWS // 2 else 0
        return self.hits[0]

    def batch(self, batch: pa.RecordBatch) -> None:
        """Search the documents of a batch of ``vectors``, strongest terms together."""
        wide = max(1, self.query.weights.shape[1])
        offsets = batch.column("terms").offsets.to_numpy()
        span = slice(offsets[0], offsets[-1])
        terms = batch.column("terms").values.to_numpy()[span].astype(np.int64)
        tf = batch.column("tfs").values.to_numpy()[span]
        counts = np.diff(offsets)
        n = batch.column("n").to_numpy()
        m = LEAST + SLOPE * n * self.query.docs // self.query.length
        values = UNIT * tf // (TF * tf + DOC * np.repeat(m, counts))
        some = np.flatnonzero(counts)
        if not len(some) or not len(self.query.slots):
            return
        # Documents next to each other share their strongest term, which keeps maxima low.
        weight = self.query.weights.max(0)[terms] * values
        starts = np.concatenate([[0], np.cumsum(counts)])
        strongest = np.maximum.reduceat(weight, starts[some])
        first = np.flatnonzero(weight == np.repeat(strongest, counts[some]))
        first = first[np.searchsorted(first, starts[some])]
        order = some[np.lexsort([-strongest, terms[first]])]
        ids = batch.column("doc_id")
        null = ids.is_null().to_numpy(zero_copy_only=False)[order]
        ids = ids.fill_null(LONG).to_numpy()[order]
        take = ranges(starts[order], counts[order])
        terms, values, counts = terms[take], values[take], counts[order]
        step = LEAF * max(1, CELLS // wide)
        ends = np.concatenate([[0], np.cumsum(counts)])
        for a in range(0, len(order), step):
            b = min(a + step, len(order))
            self.visit(ids[a:b], null[a:b], counts[a:b], terms[ends[a] : ends[b]], values[ends[a] : ends[b]])


def hits(rows: DataFrame, query: Query) -> DataFrame:
    """``slot``, ``doc_id``, ``score``: what may be among the best of each item, at most ``top`` an item and task."""
    shared = rows.sparkSession.sparkContext.broadcast(query)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value)
        for batch in batches:
            search.batch(batch)
        item, doc, null, score = search.cut()
        slot = pa.array(shared.value.slots[item].astype(np.int32))
        yield pa.RecordBatch.from_arrays([slot, pa.array(doc, mask=null), pa.array(score)], ["slot", "doc_id", "score"])
        give_back()

    return rows.mapInArrow(run, HIT_DDL)


def placed(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search_block(rows: DataFrame, items: Items, docs: int, length: int, top: int) -> DataFrame:
    """``slot``, ``doc_id``, ``score``, ``rank`` of a block of items over the ``vectors`` of its terms."""
    counted = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    query = prepared(items, {r["term"]: r["count"] for r in counted}, docs, length, top)
    if docs > FIRST_DOCS:
        some = placed(hits(rows.sample(FIRST_DOCS / docs, 12), query), top).filter(F.col("rank") == top)
        place = np.argsort(query.slots)
        for r in some.collect():
            query.beat[place[r["slot"]]] = max(1, r["score"])
    return placed(hits(rows, query), top)


def search(docs: DataFrame, items: DataFrame, top: int = 20, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``top`` documents of each item with a score above 0.

    Equal scores are ranked by ``doc_key``, which is a whole number; rows without
    one come last. Null and empty texts hold no term: such items have no rows,
    such documents are in none. Repeated rows are documents, or items, of their
    own. Other columns do not matter, and no documents or no items give no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out, sizes = None, None
    for block in item_blocks(items, item_key, text, CELLS):
        rows = vectors(plain, block.terms)
        sizes = sizes or rows.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        if not sizes["docs"]:
            break
        found = named(spark, search_block(rows, block, sizes["docs"], sizes["length"], top), block, items.schema[item_key].dataType)
        out = found if out is None else out.unionByName(found)
    if out is None:
        key = items.schema[item_key].dataType
        return spark.createDataFrame([], f"item_id {key.simpleString()}, rank int, doc_id bigint, score bigint")
    return out


def named(spark: SparkSession, found: DataFrame, block: Items, kind) -> DataFrame:
    """The rows with the ids of their items; a block is bounded, so its ids can be broadcast."""
    ids = spark.createDataFrame(list(enumerate(block.ids)), f"slot int, item_id {kind.simpleString()}")
    return found.join(F.broadcast(ids), "slot").select("item_id", "rank", "doc_id", "score")
