"""Boosted regression trees over binned rows: what Spark's booster fits, on a byte for each feature.

Spark's booster keeps each training row as Java objects, several hundred bytes
for some fifty features, and reads all of them for every level of every tree:
rows that do not fit the memory of the executors travel from disk each time.
Here the features are binned once, by the thresholds that Spark would choose,
and written as blocks of rows, feature by feature, beside label and running
forecast; features that part the rows of a block alike are written once. For a level of a tree each task adds up count, sum and sum of squares
by node, feature and bin over its blocks; the sums of a node meet in one group,
which answers with the node's best split. Only splits reach the driver. The
rules (candidates, gain, ties, leaves, pruning) are those of Spark's variance
trees, and the trees make up an ordinary Spark model.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.session import materialise, settings

BLOCK_BYTES = 2 << 20
# Spark draws its candidate thresholds from so many rows, or maxBins squared.
SAMPLE_ROWS = 10_000
EPSILON = 2.0**-52
INVALID = -np.finfo(float).max

# One block is one row: readers and Python workers hold a few of them, not a whole file.
BATCH, READ = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
IN_BLOCKS = {BATCH: "1", READ: "8"}
BLOCKS_A_FILE = 8

# place: the task that made a block, and which of its blocks it is.
# bins: those of different features; which: for each feature, the one it is. Running forecasts of zero are not written.
# All four are compressed by the Python tasks: what readers and pipes move is small.
NAMES = ["place", "n", "bins", "which", "labels", "sums"]
BLOCKS = "place bigint, n int, bins binary, which binary, labels binary, sums binary"
CODEC = "zstd"
PARTIAL = "fit int, node int, place bigint, stats binary"
SPLIT = "fit int, node int, feature int, bin int, gain double, impurity double, parent array<double>, left array<double>, right array<double>"
SPLIT_ARROW = pa.schema(
    [("fit", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()), ("impurity", pa.float64())]
    + [(c, pa.list_(pa.float64())) for c in ("parent", "left", "right")]
)


@dataclass(frozen=True)
class Node:
    """A node of a tree; without ``left`` it is a leaf. ``stats``: count, sum and sum of squares."""

    stats: tuple[float, ...]
    impurity: float
    gain: float = math.nan
    feature: int = -1
    bin: int = -1
    left: int | None = None
    right: int | None = None

    @property
    def prediction(self) -> float:
        return self.stats[1] / self.stats[0]


Tree = list[Node]
# The features once more as an array, where the table has one: it is read without making vectors.
NUMBERS = "_numbers"
NUMBER = "_number"
# With so many thresholds or fewer, comparing with each is faster than searching among them.
COMPARED = 16
# Rows, and what makes training rows of them, each by itself.
MadeFrom = tuple[DataFrame, Callable[[DataFrame], DataFrame]]


def variance(stats) -> float:
    n, total, squares = stats
    return (squares - total * total / n) / n if n else 0.0


def is_plain(booster: GBTRegressor, train: DataFrame) -> bool:
    """Whether rows weigh the same, all rows and features are used and no feature is nominal."""
    attributes = train.schema[booster.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (
        not booster.isDefined("weightCol")
        and booster.getSubsamplingRate() == 1.0
        and booster.getFeatureSubsetStrategy() in ("auto", "all")
        and booster.getLossType() == "squared"
        and booster.getMinWeightFractionPerNode() == 0.0
        and not attributes.get("nominal")
        and not attributes.get("binary")
    )


# ---------------------------------------------------------------- thresholds


def thresholds(train: DataFrame, booster: GBTRegressor, made_from: MadeFrom | None = None) -> list[np.ndarray]:
    """Candidate thresholds by feature, from the bounded sample of rows that Spark's booster draws.

    With ``made_from`` the sample is drawn from the rows that ``train`` is made of
    one by one: only what was drawn is made into vectors.
    """
    features = booster.getFeaturesCol()
    source, make = made_from or (train.select(features), lambda df: df)
    n = source.count()
    if not n:
        raise ValueError("there are no rows to learn from")
    bins = min(booster.getMaxBins(), n)
    wanted = max(bins * bins, SAMPLE_ROWS)
    fraction = wanted / n if wanted < n else 1.0
    if fraction < 1:
        spark = train.sparkSession
        seed = SparkContext.getOrCreate()._jvm.org.apache.spark.util.random.XORShiftRandom(booster.getSeed()).nextInt()
        # What is drawn depends on the numbers of rows only: it is found out by them, and the rows are not made into objects.
        numbers = source.select(F.monotonically_increasing_id().alias(NUMBER))
        drawn = DataFrame(spark._jsparkSession.createDataFrame(numbers._jdf.rdd().sample(False, fraction, seed), numbers._jdf.schema()), spark)
        drawn = spark.createDataFrame(drawn.toArrow())
        source = source.withColumn(NUMBER, F.monotonically_increasing_id()).join(F.broadcast(drawn), NUMBER, "left_semi").drop(NUMBER)
    table = make(source).select(vector_to_array(features).alias("x")).toArrow()
    values = np.array(table.column("x").combine_chunks().flatten()).reshape(table.num_rows, -1)
    return [candidates(values[:, f], fraction * n, bins - 1) for f in range(values.shape[1])]


def candidates(column: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Midpoints between neighbours among the different values: all, or about ``most`` at equal distances of rows."""
    values, counts = np.unique(column[column != 0], return_counts=True)
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if len(values) and zeros > EPSILON * counts.sum() * 100:
        place = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, place, 0.0), np.insert(counts, place, zeros)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = expected / (most + 1)
    found, seen, target = [], counts[0], stride
    for k in range(1, len(values)):
        before, seen = seen, seen + counts[k]
        if abs(before - target) < abs(seen - target):
            found.append(middle[k - 1])
            target += stride
    return np.array(found)


# -------------------------------------------------------------------- blocks


def binned(df: DataFrame, booster: GBTRegressor, cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of binned rows, feature by feature, with label and a running forecast of zero."""
    kind, block = kind_of(cuts), max(1, BLOCK_BYTES // (len(cuts) + 16))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, arrays, labels = TaskContext.get().partitionId() << 32, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                y = part.column("y").to_numpy(zero_copy_only=False).astype(float)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), len(cuts))
                if not np.isfinite(y).all() or not np.isfinite(x).all():
                    raise ValueError("labels and features must not be null, NaN or infinite")
                arrays.append(np.stack([bin_of(v, c, kind) for v, c in zip(np.ascontiguousarray(x.T), cuts)]))
                labels.append(y)
                if sum(map(len, labels)) >= block:
                    yield blocked(place, np.concatenate(arrays, axis=1), np.concatenate(labels))
                    place, arrays, labels = place + 1, [], []
        if labels:
            yield blocked(place, np.concatenate(arrays, axis=1), np.concatenate(labels))

    x = F.col(NUMBERS) if NUMBERS in df.columns else vector_to_array(booster.getFeaturesCol())
    rows = df.select(F.col(booster.getLabelCol()).cast("double").alias("y"), x.alias("x"))
    with settings(df.sparkSession, {BATCH: str(max(1, BLOCK_BYTES // (8 * len(cuts))))}):
        return materialise(rows.mapInArrow(run, BLOCKS), BLOCKS_A_FILE)


def bin_of(x: np.ndarray, cuts: np.ndarray, kind: type) -> np.ndarray:
    """How many of the thresholds lie below each value."""
    if len(cuts) > COMPARED:
        return np.searchsorted(cuts, x).astype(kind)
    out = np.zeros(len(x), kind)
    for cut in cuts:
        out += x > cut
    return out


def kind_of(cuts: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, cuts)) < 256 else np.uint16 if max(map(len, cuts)) < 1 << 16 else np.uint32


def blocked(place: int, bins: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
    """A new block of rows; features with the same bins share them."""
    found: dict[bytes, int] = {}
    which = np.array([found.setdefault(row.tobytes(), len(found)) for row in bins], np.uint32)
    return packed(place, b"".join(found), which, labels, np.empty(0))


def packed(place: int, bins: np.ndarray | bytes, which: np.ndarray, labels: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    binaries = [v if isinstance(v, bytes) else v.tobytes() for v in (bins, which, labels, sums)]
    columns = [pa.array([pa.compress(v, CODEC, asbytes=True) if v else v], pa.binary()) for v in binaries]
    return pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([len(labels)], pa.int32()), *columns], NAMES)


def opened(value: pa.BinaryScalar, n: int, kind: type) -> np.ndarray:
    """``n`` numbers."""
    return np.frombuffer(pa.decompress(value.as_buffer(), n * np.dtype(kind).itemsize, CODEC), kind)


@dataclass(frozen=True)
class Block:
    """Rows of binned features: ``bins`` of the different ones, and which of them each feature is."""

    place: int
    bins: np.ndarray
    which: np.ndarray
    labels: np.ndarray
    sums: np.ndarray

    def of(self, feature: int) -> np.ndarray:
        return self.bins[self.which[feature]]


def unpacked(batches: Iterator[pa.RecordBatch], features: int, kind: type) -> Iterator[Block]:
    for batch in batches:
        for place, n, bins, which, labels, sums in zip(*(batch.column(c) for c in NAMES)):
            n, which = n.as_py(), opened(which, features, np.uint32)
            yield Block(
                place.as_py(), opened(bins, n * (int(which.max()) + 1), kind).reshape(-1, n), which,
                opened(labels, n, float), opened(sums, n, float) if sums.as_buffer().size else np.zeros(n),
            )


def places(tree: Tree, block: Block) -> np.ndarray:
    """The node each row ends in."""
    kind = np.min_scalar_type(len(tree)).type

    def below(at: int):
        node = tree[at]
        if node.left is None:
            return kind(at)
        left, right = below(node.left), below(node.right)
        # All bits are set where a row goes left.
        low = np.negative((block.of(node.feature) <= node.bin).astype(kind))
        return right ^ ((left ^ right) & low)

    return np.broadcast_to(below(0), len(block.labels))


def forecast(trees: list[Tree], weights: list[float], block: Block) -> Iterator[np.ndarray]:
    """The running forecast after each of the trees."""
    sums = block.sums
    for tree, weight in zip(trees, weights):
        values = np.array([weight * node.prediction for node in tree])
        sums = sums + values[places(tree, block)]
        yield sums


def advanced(blocks: DataFrame, trees: list[Tree], weights: list[float], cuts: list[np.ndarray]) -> DataFrame:
    """The blocks with the trees added to the running forecasts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in unpacked(batches, len(cuts), kind_of(cuts)):
            *_, sums = forecast(trees, weights, block)
            yield packed(block.place, block.bins, block.which, block.labels, sums)

    with settings(blocks.sparkSession, IN_BLOCKS):
        return materialise(blocks.mapInArrow(run, BLOCKS), BLOCKS_A_FILE)


def mean_errors(blocks: DataFrame, trees: list[Tree], weights: list[float], cuts: list[np.ndarray]) -> list[float]:
    """The mean squared error after each of the trees, from one pass; NaN without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in unpacked(batches, len(cuts), kind_of(cuts)):
            y = block.labels
            found = [float(((y - s) ** 2).sum()) for s in forecast(trees, weights, block)]
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64())), pa.array([len(y)], pa.int64())], ["e", "n"])

    errors = blocks.mapInArrow(run, "e array<double>, n bigint")
    with settings(blocks.sparkSession, IN_BLOCKS):
        *found, n = errors.agg(*[F.sum(F.get("e", F.lit(k))) for k in range(len(trees))], F.sum("n")).first()
    return [e / n if n else math.nan for e in found]


# --------------------------------------------------------------------- trees


@dataclass
class Growing:
    """A tree on what the running forecast in the blocks and the trees ``done`` since leave open."""

    blocks: DataFrame
    done: list[Tree]
    weights: list[float]
    booster: GBTRegressor
    cuts: list[np.ndarray]
    # The first round learns the label; a later one the slope of the squared error.
    first: bool
    tree: Tree = field(default_factory=lambda: [Node((0.0, 0.0, 0.0), 0.0)])
    open_nodes: list[int] = field(default_factory=lambda: [0])

    @property
    def at_once(self) -> int:
        """So many nodes at a time keep to the booster's memory for sums."""
        n_bins = max(map(len, self.cuts)) + 1
        return max(1, (self.booster.getMaxMemoryInMB() << 20) // (n_bins * len(self.cuts) * 24))

    def grow(self, found: list, level: int) -> None:
        """Split the open nodes of a level as was found best."""
        tree, depth, self.open_nodes = self.tree, self.booster.getMaxDepth(), []
        for r in sorted(found, key=lambda r: r["node"]):
            parent = tuple(r["parent"])
            if r["gain"] <= 0 or level == depth:
                tree[r["node"]] = Node(parent, r["impurity"] if r["gain"] != INVALID else -1.0)
                continue
            left, right = len(tree), len(tree) + 1
            tree[r["node"]] = Node(parent, r["impurity"], r["gain"], r["feature"], r["bin"], left, right)
            for stats in (tuple(r["left"]), tuple(r["right"])):
                spread = variance(stats)
                if level + 1 < depth and abs(spread) >= EPSILON:
                    self.open_nodes.append(len(tree))
                tree.append(Node(stats, spread))


def node_sums(growing: Growing, fit: int, open_nodes: list[int]) -> DataFrame:
    """Count, sum and sum of squares of what is learned, by open node, feature and bin: a row for each node and run of blocks.

    A run has blocks of one task that made them, and its sums go on from block to
    block, as Spark's go on from row to row: rounding decides between features
    that part the rows alike, and so it does as in Spark's booster.
    """
    done, weights, tree, cuts, first = growing.done, growing.weights, growing.tree, growing.cuts, growing.first
    kind, n_bins = kind_of(cuts), max(map(len, cuts)) + 1
    width = len(open_nodes) * n_bins

    def told(place: int, shared: list[int], counts: np.ndarray, both: np.ndarray) -> pa.RecordBatch:
        parts = np.stack([counts, both.real, both.imag]).reshape(3, -1, len(open_nodes), n_bins)
        stats = [parts[:, shared, k].tobytes() for k in range(len(open_nodes))]
        columns = [pa.array([fit] * len(stats), pa.int32()), pa.array(open_nodes, pa.int32())]
        columns += [pa.array([place] * len(stats), pa.int64()), pa.array(stats, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["fit", "node", "place", "stats"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = None
        for block in unpacked(batches, len(cuts), kind):
            if start is None or block.place >> 32 != start >> 32:
                if start is not None:
                    yield told(start, shared, counts, both)
                # Sum and sum of squares are the two parts of one complex number. All features share them at first.
                start, shared, counts, both = block.place, [0] * len(cuts), np.zeros((1, width)), np.zeros((1, width), complex)
            y = block.labels
            *_, sums = block.sums, *forecast(done, weights, block)
            target, where, inside = y if first else 2.0 * (y - sums), 0, slice(None)
            if len(tree) > 1:
                slot = np.full(len(tree), -1, np.int64)
                slot[open_nodes] = np.arange(len(open_nodes)) * n_bins
                where = slot[places(tree, block)]
                if where.min(initial=0) < 0:
                    inside = np.flatnonzero(where >= 0)
                    where, target = where[inside], target[inside]
            learned = np.empty(len(target), complex)
            learned.real, learned.imag = target, target * target
            # Features go on sharing sums as long as they part the rows alike.
            apart: dict[tuple[int, int], int] = {}
            shared = [apart.setdefault(pair, len(apart)) for pair in zip(shared, block.which.tolist())]
            so_far = [k for k, _ in apart]
            counts, both = counts[so_far], both[so_far]
            key = np.empty(len(target), np.int64)
            for k, (_, column) in enumerate(apart):
                np.add(block.bins[column][inside], where, out=key, casting="unsafe")
                counts[k] += np.bincount(key, minlength=width)
                np.add.at(both[k], key, learned)
        if start is not None:
            yield told(start, shared, counts, both)

    return growing.blocks.mapInArrow(run, PARTIAL)


def best_split(total: np.ndarray, cuts: list[np.ndarray], least: int, min_gain: float, known: tuple[float, ...] | None):
    """Feature, bin, gain, and the sums of parent, left and right, of a node's sums (3, feature, bin)."""
    left = np.cumsum(total, axis=2)
    right = left[:, :, -1:] - left
    sizes = np.array([len(c) for c in cuts])
    usable = np.arange(total.shape[2]) < sizes[:, None]
    if known is None:
        f = int(np.argmax(sizes > 0))
        known = tuple((left[:, f, 0] + right[:, f, 0]).tolist()) if sizes.any() else tuple(left[:, 0, -1].tolist())
    impurity = variance(known)

    def spread(n, s, q):
        n = np.where(n == 0, 1, n)
        return (q - s * s / n) / n

    n = left[0] + right[0]
    with np.errstate(all="ignore"):
        gain = impurity - left[0] / n * spread(*left) - right[0] / n * spread(*right)
    allowed = usable & (left[0] >= least) & (right[0] >= least) & (gain >= min_gain)
    gain = np.where(allowed, gain, INVALID)
    f, b = divmod(int(np.argmax(gain)), total.shape[2])
    return f, b, float(gain[f, b]), impurity, known, tuple(left[:, f, b].tolist()), tuple(right[:, f, b].tolist())


def best_splits(known: dict[tuple[int, int], tuple[float, ...] | None], cuts: list[list[np.ndarray]], least: int, min_gain: float):
    """A function that adds up the sums of a node of one fit and answers with its best split."""

    def run(table: pa.Table) -> pa.Table:
        # In one order for all features, so that equal features have equal sums.
        order, stats = np.argsort(table.column("place").to_numpy()), table.column("stats")
        fit, node = table.column("fit")[0].as_py(), table.column("node")[0].as_py()
        total = np.zeros((3, len(cuts[fit]), max(map(len, cuts[fit])) + 1))
        for k in order.tolist():
            total += np.frombuffer(stats[k].as_buffer(), float).reshape(total.shape)
        f, b, gain, impurity, *sums = best_split(total, cuts[fit], least, min_gain, known[fit, node])
        row = dict(fit=fit, node=node, feature=f, bin=b, gain=gain, impurity=impurity)
        row |= dict(zip(("parent", "left", "right"), map(list, sums)))
        return pa.Table.from_pylist([row], schema=SPLIT_ARROW)

    return run


def fit_trees(growing: list[Growing]) -> list[Tree]:
    """The trees, all by boosters of the same parameters, level by level: a level of all of them is one job."""
    booster, cuts, level = growing[0].booster, [g.cuts for g in growing], 0
    while any(g.open_nodes for g in growing):
        found, waiting = [], {k: g.open_nodes for k, g in enumerate(growing) if g.open_nodes}
        while waiting:
            some = {k: nodes[: growing[k].at_once] for k, nodes in waiting.items()}
            known = {(k, n): growing[k].tree[n].stats if level else None for k, nodes in some.items() for n in nodes}
            partial = reduce(DataFrame.union, [node_sums(growing[k], k, nodes) for k, nodes in some.items()])
            best = best_splits(known, cuts, booster.getMinInstancesPerNode(), booster.getMinInfoGain())
            with settings(partial.sparkSession, IN_BLOCKS):
                found += partial.groupBy("fit", "node").applyInArrow(best, SPLIT).collect()
            waiting = {k: rest for k, nodes in waiting.items() if (rest := nodes[growing[k].at_once :])}
        for k, g in enumerate(growing):
            g.grow([r for r in found if r["fit"] == k], level)
        level += 1
    return [pruned(g.tree) for g in growing]


def pruned(tree: Tree) -> Tree:
    """Two leaves that predict the same become one; children stand after their parents."""
    tree = list(tree)
    for at in reversed(range(len(tree))):
        node = tree[at]
        if node.left is not None:
            left, right = tree[node.left], tree[node.right]
            if left.left is None and right.left is None and left.prediction == right.prediction:
                tree[at] = replace(node, gain=math.nan, feature=-1, bin=-1, left=None, right=None)
    return tree


def spark_tree(tree: Tree, cuts: list[np.ndarray], uid: str) -> DecisionTreeRegressionModel:
    """The tree as a model of Spark's."""
    context = SparkContext.getOrCreate()
    made, gateway = context._jvm.org.apache.spark, context._gateway

    def sums(node: Node):
        values = gateway.new_array(context._jvm.double, 3)
        for k, v in enumerate(node.stats):
            values[k] = v
        return made.mllib.tree.impurity.VarianceCalculator(values, int(node.stats[0]))

    built: dict[int, object] = {}
    for at in reversed(range(len(tree))):
        node = tree[at]
        if node.left is None:
            built[at] = made.ml.tree.LeafNode(node.prediction, node.impurity, sums(node))
        else:
            split = made.ml.tree.ContinuousSplit(node.feature, float(cuts[node.feature][node.bin]))
            children = built[node.left], built[node.right]
            built[at] = made.ml.tree.InternalNode(node.prediction, node.impurity, node.gain, *children, split, sums(node))
    return DecisionTreeRegressionModel(made.ml.regression.DecisionTreeRegressionModel(uid, built[0], len(cuts)))
