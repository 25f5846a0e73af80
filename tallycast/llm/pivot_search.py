"""Exact search for the highest inner products by a pivot-distance index.

Vectors are lifted onto a sphere: x becomes (x, sqrt(M - x.x)) with M the
largest x.x, a query q becomes (q, 0). The nearest lifted vectors are then those
of highest inner product, d(q, x)**2 = q.q + M - 2 q.x, and distances obey the
triangle inequality. The index keys a vector by its nearest pivot and its
distance to it, sorted and cut into blocks, each a narrow annulus [low, high]
about its pivot. A query is no nearer to anything in an annulus than
max(d - high, low - d, 0), with d its distance to the pivot.

A search first visits the few cells (pivot and range of distances) with the
best bounds, which gives every query a score to beat. Then each block is met by
those queries only whose bound may still reach that score, nearest annuli
first, and a task raises the scores as it goes. Scores are exact integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.session import materialise

# Pivots and ranges are fitted on so many rows, chosen by a hash; every row is indexed.
FIT_ROWS = 4096
# Pivots grow with the root of the rows, so that cells stay small against them.
LEAST_PIVOTS, MOST_PIVOTS, RINGS = 16, 256, 16
BLOCK_ROWS = 1024
PACK_ROWS = 256
# Cells that are visited for a first score.
FIRST_CELLS = 3
# Blocks of one cell that one task meets at most, on average.
CELL_BLOCKS = 16
# A task hands over what it has found for so many queries.
HELD_QUERIES = 20_000
# Sums of products below this are exact in doubles. Vectors with a component so large
# that they might not be stay outside the cells: every query meets them, and as
# queries they meet all, with whole-number arithmetic.
EXACT = 1 << 53
LONG = (1 << 63) - 1

BLOCK_DDL = "cell int, block bigint, low double, high double, n int, ids binary, vectors binary"
PACK_DDL = "cell int, salt int, pack bigint, bound double, ids binary, vectors binary, beat binary"


@dataclass
class Index:
    """What tasks have to know: sizes, pivots and cell bounds; bounded by the parameters."""

    dim: int
    cap: float  # the largest component of a vector inside the cells
    kind: str
    norm: float
    pivots: np.ndarray
    edges: np.ndarray
    cells: np.ndarray | None = None  # low, high, rows, blocks of each cell; the last is for what is outside
    salts: np.ndarray | None = None

    def matrix(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.kind).astype(float).reshape(-1, self.dim) if self.dim else np.zeros((0, 0))

    def outside(self, x: np.ndarray) -> np.ndarray:
        """Which vectors have a component beyond the cap."""
        return np.abs(x).max(1, initial=0.0) > self.cap

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(self.norm - (x * x).sum(1), 0))])

    def to_pivots(self, lifted: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((lifted[:, None, :] - self.pivots[None]) ** 2).sum(2), 0))

    def bounds(self, x: np.ndarray, far: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The highest score each query may have in an annulus; ``far``: its distance to the pivot."""
        # Distances carry rounding errors, so annuli are taken a little wider.
        slack = 1e-9 * (1 + np.abs(far) + high)
        gap = np.maximum(np.maximum(far - high, low - far) - slack, 0)
        return ((x * x).sum(1) + self.norm)[:, None] / 2 - gap**2 / 2 + 1e-9 * (1 + self.norm)


def usable(vector: Column, key: Column) -> Column:
    """Neither null nor holding a null or a number that isn't finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & key.isNotNull() & F.coalesce(finite, F.lit(False))


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of a batch, shorter ones filled up with zeros."""
    lists = batch.column("v")
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), dim))
    flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def _fit(vectors: DataFrame) -> Index:
    scale = vectors.agg(
        F.max(F.size("v")).alias("dim"), F.max(F.aggregate("v", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))).alias("most"), F.count(F.lit(1)).alias("rows")
    ).first()
    dim, most = scale.dim or 0, scale.most or 0.0
    cap = float(math.isqrt((EXACT - 1) // max(dim, 1)))
    inside = vectors.filter(F.forall("v", lambda x: F.abs(x) <= cap))
    norm = inside.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0
    rows = inside.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(FIT_ROWS).select("v").collect()
    sample = np.zeros((len(rows), dim))
    for k, r in enumerate(rows):
        sample[k, : len(r.v)] = r.v
    index = Index(dim, cap, "<i2" if most < 1 << 15 else "<f8", norm, np.zeros((1, dim + 1)), np.zeros((1, RINGS - 1)))
    if not len(sample):
        return index
    most_pivots = max(LEAST_PIVOTS, min(MOST_PIVOTS, math.isqrt(scale.rows) // 16))
    points = index.lifted(sample)
    centres = points[:1]
    while len(centres) < min(most_pivots, len(points)):  # farthest first, then a few rounds of means
        away = ((points[:, None, :] - centres[None]) ** 2).sum(2).min(1)
        if away.max() == 0:
            break
        centres = np.vstack([centres, points[away.argmax()]])
    for _ in range(5):
        own = ((points[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.vstack([points[own == k].mean(0) if (own == k).any() else c for k, c in enumerate(centres)])
    index.pivots = centres
    far = index.to_pivots(points)
    own = far.argmin(1)
    share = np.linspace(0, 1, RINGS + 1)[1:-1]
    near = far[np.arange(len(far)), own]
    index.edges = np.vstack([np.quantile(near[own == k] if (own == k).any() else near, share) for k in range(len(centres))])
    return index


def _placed(index: Index):
    """Cell and distance to the pivot of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, index.dim)
            outside = index.outside(x)
            far = index.to_pivots(index.lifted(np.where(outside[:, None], 0.0, x)))
            own = far.argmin(1)
            near = np.where(outside, 0.0, far[np.arange(len(x)), own])
            ring = (index.edges[own] < near[:, None]).sum(1)
            cell = np.where(outside, len(index.pivots) * RINGS, own * RINGS + ring)
            data = [row.tobytes() for row in x.astype(index.kind)]
            yield pa.RecordBatch.from_pydict(
                {"cell": pa.array(cell, pa.int32()), "far": near, "vec_id": batch.column("vec_id"), "data": pa.array(data, pa.binary())}
            )

    return run


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and distance, as blocks of one cell."""
    seq = TaskContext.get().partitionId() << 32
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            for start in range(a, b, BLOCK_ROWS):
                part = batch.slice(start, min(BLOCK_ROWS, b - start))
                far = part.column("far").to_numpy()
                seq += 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "cell": part.column("cell")[:1], "block": [seq], "low": [far[0]], "high": [far[-1]],
                        "n": pa.array([len(far)], pa.int32()),
                        "ids": [part.column("vec_id").to_numpy().astype("<i8").tobytes()],
                        "vectors": [b"".join(part.column("data").to_pylist())],
                    }
                )


def build(vectors: DataFrame) -> tuple[Index, DataFrame]:
    """The index of ``vec_id`` and ``v`` (doubles without fraction): bounds, and a table of all blocks."""
    index = _fit(vectors)
    rows = vectors.count()
    cells = len(index.pivots) * RINGS
    # A cell with any share of all rows is dealt out to so many tasks.
    parts = max(1, -(-4 * rows // (cells * BLOCK_ROWS)))
    placed = vectors.mapInArrow(_placed(index), "cell int, far double, vec_id bigint, data binary")
    spread = placed.repartition("cell", F.pmod(F.xxhash64("vec_id"), F.lit(parts))).sortWithinPartitions("cell", "far", "vec_id")
    blocks = materialise(spread.mapInArrow(_blocked, BLOCK_DDL))
    found = blocks.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks"))
    index.cells = np.zeros((cells + 1, 4))
    for r in found.collect():  # one row per cell
        index.cells[r.cell] = r.low, r.high, r.n, r.blocks
    index.salts = np.maximum(1, -(-index.cells[:, 3] // CELL_BLOCKS)).astype(int)
    return index, blocks


def _asked(index: Index, first: bool):
    """The cells each pack of queries has to visit, with the queries that have to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x = np.frombuffer(row["ids"], "<i8"), index.matrix(row["vectors"])
                beat = np.frombuffer(row["beat"], "<f8")
                if not index.dim:
                    x = np.zeros((len(ids), 0))
                low, high, n, _ = index.cells.T
                pivot = np.arange(len(index.cells) - 1) // RINGS
                outside = index.outside(x)
                plain = np.where(outside[:, None], 0.0, x)
                far = index.to_pivots(np.column_stack([plain, np.zeros(len(x))]))[:, pivot]
                bound = np.full((len(x), len(index.cells)), np.inf)
                bound[:, :-1] = index.bounds(plain, far, low[:-1], high[:-1])
                bound[outside] = np.inf
                bound[:, n == 0] = -np.inf
                best = np.argsort(-bound, axis=1, kind="stable")[:, : FIRST_CELLS + 1]
                visit = np.zeros(bound.shape, bool)
                visit[np.arange(len(x))[:, None], best] = True
                visit = visit if first else ~visit & (bound >= beat[:, None])
                visit &= n > 0
                out = []
                for cell in np.flatnonzero(visit.any(0)).tolist():
                    own = visit[:, cell]
                    top = float(bound[own, cell].max())
                    packed = ids[own].tobytes(), x[own].astype(index.kind).tobytes(), beat[own].tobytes()
                    out += [(cell, salt, row["pack"], min(top, 1e300), *packed) for salt in range(index.salts[cell])]
                if out:
                    types = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
                    names = ["cell", "salt", "pack", "bound", "ids", "vectors", "beat"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


class _Best:
    """The best k of each query so far: highest score, then smallest id."""

    def __init__(self, k: int) -> None:
        self.k, self.found = k, {}

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if query in self.found:
            scores, ids = np.concatenate([self.found[query][0], scores]), np.concatenate([self.found[query][1], ids])
        order = np.lexsort((ids, -scores))[: self.k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[: self.k]
        self.found[query] = scores[order], ids[order]

    def least(self, query: int) -> float:
        own = self.found.get(query)
        if own is None or len(own[0]) < self.k:
            return -np.inf
        least = float(own[0][-1])
        return least if least <= own[0][-1] else np.nextafter(least, -np.inf)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.found:
            sizes = [len(s) for s, _ in self.found.values()]
            scores = np.concatenate([s for s, _ in self.found.values()])
            scores = pa.array([max(-LONG, min(LONG, int(s))) for s in scores.tolist()], pa.int64())
            query = np.repeat(np.fromiter(self.found, np.int64), sizes)
            yield pa.RecordBatch.from_pydict({"query_id": query, "vec_id": np.concatenate([i for _, i in self.found.values()]), "score": scores})
            self.found = {}


def _whole_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products in whole numbers: of 64 bits where they fit, else of any size."""
    most = [int(np.abs(v).max(initial=0.0)) for v in (q, x)]
    if len(x) * most[0] * most[1] < LONG and max(most) < LONG:
        return q.astype(np.int64) @ x.astype(np.int64)
    large = [np.array([[int(c) for c in row] for row in v], object).reshape(v.shape) for v in (q, x)]
    return large[0] @ large[1]


def _kept(best: _Best, ids: np.ndarray, beat: np.ndarray, block_ids: np.ndarray, which: np.ndarray, q: np.ndarray, x: np.ndarray, products) -> None:
    """Add the scores of some queries against a block that reach what each has."""
    if not which.any():
        return
    for n, least, own in zip(ids[which].tolist(), beat[which].tolist(), products(q[which], x.T)):
        good = (own >= least) & (block_ids != n)
        if good.any():
            best.add(n, own[good], block_ids[good])


def _met(index: Index, k: int):
    """Scores of the queries of each row against its block, where the bound allows one that counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, beat = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["beat"], "<f8")
                block_ids = np.frombuffer(row["block_ids"], "<i8")
                q = index.matrix(row["vectors"]) if index.dim else np.zeros((len(ids), 0))
                x = index.matrix(row["block_vectors"]) if index.dim else np.zeros((len(block_ids), 0))
                beat = np.maximum(beat, [best.least(n) for n in ids.tolist()])
                outside = np.full(len(q), True) if row["cell"] == len(index.cells) - 1 else index.outside(q)
                if not outside.all():
                    pivot = index.pivots[[row["cell"] // RINGS]]
                    lifted = np.column_stack([q, np.zeros(len(q))])
                    far = np.sqrt(((lifted - pivot) ** 2).sum(1))[:, None]
                    may = index.bounds(q, far, np.array([row["low"]]), np.array([row["high"]]))[:, 0] >= beat
                    _kept(best, ids, beat, block_ids, ~outside & may, q, x, np.matmul)
                _kept(best, ids, beat, block_ids, outside, q, x, _whole_products)
            if len(best.found) > HELD_QUERIES:
                yield from best.rows()
        yield from best.rows()

    return run


def search(vectors: DataFrame, wanted: Column, k: int = 20, *, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """The ``k`` rows of highest inner product for each row that is ``wanted``.

    Components x count as floor(scale * x). Returns ``query_id``, ``rank`` (from
    1), ``vec_id``, ``score``; ties go to the smaller id; with fewer than ``k``
    other rows all are returned. Rows with a null key, a null vector or a
    component that is null or not finite take no part; shorter vectors are
    filled up with zeros, empty ones included. A query meets every row but those
    with its own id; rows that repeat an id are candidates each, and as queries
    they are one (the smallest vector). Scores beyond a long are cut to it. An
    empty table gives no rows; other columns play no part.
    """
    usable_rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), wanted.alias("_wanted"))
    usable_rows = usable_rows.filter(usable(F.col("v"), F.col("vec_id")))
    whole = materialise(usable_rows.withColumn("v", F.transform("v", lambda x: _floor(x * scale))))
    index, blocks = build(whole.select("vec_id", "v"))
    salts = F.array(*[F.lit(int(s)) for s in index.salts])
    blocks = blocks.select("cell", F.pmod(F.xxhash64("block"), F.get(salts, F.col("cell"))).cast("int").alias("salt"), "low", "high", F.col("ids").alias("block_ids"), F.col("vectors").alias("block_vectors"))

    queries = whole.filter("_wanted").groupBy("vec_id").agg(F.min("v").alias("v"))
    # Packs are dealt by a hash of the id, so none holds many more than the others.
    packs = max(1, -(-queries.count() // PACK_ROWS))
    queries = queries.withColumn("pack", F.pmod(F.xxhash64("vec_id"), F.lit(packs)))
    none = queries.withColumn("beat", F.lit(float("-inf")))

    def packed(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pack = batch.column("pack").to_numpy()
                for p in np.unique(pack):
                    part = batch.filter(pa.array(pack == p))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "pack": [int(p)],
                            "ids": [part.column("vec_id").to_numpy().astype("<i8").tobytes()],
                            "vectors": [_rows(part, index.dim).astype(index.kind).tobytes()],
                            "beat": [part.column("beat").to_numpy().astype("<f8").tobytes()],
                        }
                    )

        together = rows.repartition("pack").sortWithinPartitions("pack")
        return together.mapInArrow(run, "pack bigint, ids binary, vectors binary, beat binary")

    def visited(rows: DataFrame, first: bool) -> DataFrame:
        asked = packed(rows).mapInArrow(_asked(index, first), PACK_DDL)
        both = asked.join(blocks, ["cell", "salt"]).sortWithinPartitions("pack", F.desc("bound"), "low")
        return both.mapInArrow(_met(index, k), "query_id bigint, vec_id bigint, score bigint")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    start = materialise(best(visited(none, True)))
    # A double never above the score: beyond 2**53 a cast may round up.
    least = F.col("score").cast("double")
    least = F.when(F.abs(least) >= float(EXACT), least - F.abs(least) * 1e-15).otherwise(least)
    beat = start.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), least.alias("beat"))
    rest = queries.join(beat, "vec_id", "left").withColumn("beat", F.coalesce("beat", F.lit(float("-inf"))))
    found = start.drop("rank").unionByName(visited(rest, False))
    return best(found).select("query_id", "rank", "vec_id", "score")


def _floor(x: Column) -> Column:
    """The largest whole double that isn't above x; a cast to long would overflow."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)
