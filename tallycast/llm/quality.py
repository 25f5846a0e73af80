"""A generalised additive quality model with pairwise interactions.

Features of the text are cut into bins. Training goes round the features in a
cycle; each visit fits a shallow tree of two splits on one feature's bins to
the current gradient and adds a small part of it to that feature's look-up
table. Pairs of features that explain what is left then get tables of two
dimensions in the same way, by trees with one split along each. The score of a
text is the logistic of a sum of table entries: one bin look-up a feature.

Learning uses a bounded sample of labelled rows (``fit_rows``, by a hash of the
id), and every text is scored from all of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, text_bytes, texts_of
from tallycast.llm.words import words_of

FIT_ROWS = 40_000
BINS = 64
PAIR_BINS = 12
PAIRS = 6
ROUNDS = 250
RATE = 0.08
# Smallest number of rows on either side of a split.
LEAF_ROWS = 20
BLOCK = 2 << 20

FEATURES = (
    "log_bytes", "log_words", "upper", "digit", "mark", "exclamation", "bar", "high", "blank", "stop", "comma",
    "word_size", "longest_word", "distinct_words", "most_frequent_word", "words_a_line", "lines", "repeated_lines",
    "marked_words", "short_words",
)


def _class(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in spans:
        out[a : b + 1] = True
    return out


CLASSES = {
    "upper": _class((65, 90)),
    "digit": _class((48, 57)),
    "mark": _class((35, 43), (47, 47), (58, 64), (91, 96), (123, 123), (125, 126)),
    "exclamation": _class((33, 33)),
    "bar": _class((124, 124)),
    "high": _class((128, 255)),
    "blank": _class((32, 32), (9, 13)),
    "stop": _class((46, 46)),
    "comma": _class((44, 44)),
}


def _by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over each text, empty ones included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _highest(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.maximum.reduceat(values, offsets[:-1][full])
    return out


def _repeats(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of each text, and how often its most frequent one occurs."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    starts = np.flatnonzero(new)
    runs = np.diff(np.append(starts, len(k)))
    different = np.bincount(t[starts], minlength=len(offsets) - 1)
    return different, _highest(runs, np.concatenate([[0], np.cumsum(different)]))


def features(texts: pa.LargeStringArray) -> np.ndarray:
    """One row of features for each whole text; an empty text has zeros."""
    data, offsets = text_bytes(texts)
    words = words_of(texts)
    size = np.maximum(np.diff(offsets), 1)
    n = words.counts
    some = np.maximum(n, 1)
    out = {name: _by_text(of[data], offsets) / size for name, of in CLASSES.items()}
    out["log_bytes"] = np.log1p(np.diff(offsets))
    out["log_words"] = np.log1p(n)
    out["word_size"] = _by_text(words.sizes, words.offsets) / some
    out["longest_word"] = np.log1p(_highest(words.sizes, words.offsets))
    different, most = _repeats(words.hashes, words.offsets)
    out["distinct_words"] = different / some
    out["most_frequent_word"] = most / some
    lines = _by_text(data == 10, offsets) + (np.diff(offsets) > 0)
    out["lines"] = np.log1p(lines)
    out["words_a_line"] = np.log1p(n / np.maximum(lines, 1))
    # A line's key: its words' hashes, added up with their places in the line.
    before = np.concatenate([[0], np.cumsum(data == 10)])
    line = before[words.starts]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (words.text[1:] != words.text[:-1])
    heads = np.flatnonzero(new)
    if len(heads):
        place = (np.arange(len(line)) - np.repeat(heads, np.diff(np.append(heads, len(line))))).astype(np.uint64)
        keys = np.add.reduceat(words.hashes * (place * np.uint64(2) + np.uint64(1)), heads)
    else:
        keys = words.hashes[:0]
    line_offsets = np.searchsorted(heads, words.offsets)
    out["repeated_lines"] = 1 - _repeats(keys, line_offsets)[0] / np.maximum(np.diff(line_offsets), 1)
    out["repeated_lines"][np.diff(line_offsets) == 0] = 0
    final = data[words.starts + words.sizes - 1]
    marked = CLASSES["mark"][final] | CLASSES["exclamation"][final] | CLASSES["bar"][final]
    out["marked_words"] = _by_text(marked, words.offsets) / some
    out["short_words"] = _by_text(words.sizes <= 3, words.offsets) / some
    return np.column_stack([out[name] for name in FEATURES])


@dataclass
class Model:
    """Bin edges and look-up tables; ``pairs``: (feature, feature, table)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)


def _split(grad: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[int, float]:
    """The best cut of a run of bins, and what it gains."""
    g, w, n = np.cumsum(grad), np.cumsum(weight), np.cumsum(rows)
    left_g, left_w = g[:-1], w[:-1]
    right_g, right_w = g[-1] - left_g, w[-1] - left_w
    gain = left_g**2 / (left_w + 1) + right_g**2 / (right_w + 1) - g[-1] ** 2 / (w[-1] + 1)
    gain = np.where((n[:-1] >= LEAF_ROWS) & (n[-1] - n[:-1] >= LEAF_ROWS), gain, -np.inf)
    if not len(gain):
        return 0, -np.inf
    best = int(gain.argmax())
    return best + 1, float(gain[best])


def _tree(grad: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Values of a tree of at most two splits on the bins."""
    parts = [(0, len(grad))]
    for _ in range(2):
        cuts = [(_split(grad[a:b], weight[a:b], rows[a:b]), a, b) for a, b in parts]
        (cut, gain), a, b = max(cuts, key=lambda c: c[0][1])
        if not gain > 0:
            break
        parts.remove((a, b))
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = grad[a:b].sum() / (weight[a:b].sum() + 1)
    return out


def _pair_tree(grad: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of four leaves from one split along each side, and what they gain."""
    cum = [np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (grad, weight, rows)]

    def quarters(x: np.ndarray) -> list[np.ndarray]:
        a, total = x[1:-1, 1:-1], x[-1, -1]
        top, left = x[1:-1, -1:], x[-1:, 1:-1]
        return [a, top - a, left - a, total - top - left + a]

    g, w, n = map(quarters, cum)
    if not g[0].size:
        return np.zeros_like(grad), 0.0
    # A quarter of few rows has the value 0 and gains nothing.
    gain = sum(np.where(m >= LEAF_ROWS, x**2 / (y + 1), 0.0) for x, y, m in zip(g, w, n)) - grad.sum() ** 2 / (weight.sum() + 1)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    leaf = [x[i, j] / (y[i, j] + 1) if m[i, j] >= LEAF_ROWS else 0.0 for x, y, m in zip(g, w, n)]
    out = np.empty_like(grad)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf
    return out, float(gain[i, j])


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
    return [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    share = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, k], share, method="higher")) for k in range(x.shape[1])]


def learn(x: np.ndarray, y: np.ndarray, *, rounds: int = ROUNDS, pairs: int = PAIRS) -> Model:
    """Boost the tables on features ``x`` and labels ``y`` (0 or 1)."""
    if not len(y):
        return Model()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(base=float(np.log(rate / (1 - rate))), edges=_edges(x, BINS), coarse=_edges(x, PAIR_BINS))
    fine, coarse = _bins(x, model.edges), _bins(x, model.coarse)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in sizes]
    counts = [np.bincount(b, minlength=n) for b, n in zip(fine, sizes)]
    score = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, bins in enumerate(fine):
            grad, weight = slopes()
            step = RATE * _tree(
                np.bincount(bins, grad, sizes[k]), np.bincount(bins, weight, sizes[k]), counts[k]
            )
            model.tables[k] += step
            score += step[bins]

    def grid(a: int, b: int, values: np.ndarray | None = None) -> np.ndarray:
        shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        return np.bincount(coarse[a] * shape[1] + coarse[b], values, shape[0] * shape[1]).reshape(shape)

    grad, weight = slopes()
    gains = {
        (a, b): _pair_tree(grid(a, b, grad), grid(a, b, weight), grid(a, b))[1]
        for a, b in combinations(range(x.shape[1]), 2)
    }
    chosen = sorted((p for p in gains if gains[p] > 0), key=lambda p: (-gains[p], p))[:pairs]
    tables = {p: np.zeros(grid(*p).shape) for p in chosen}
    for _ in range(rounds // 2 if chosen else 0):
        for a, b in chosen:
            grad, weight = slopes()
            step = RATE * _pair_tree(grid(a, b, grad), grid(a, b, weight), grid(a, b))[0]
            tables[a, b] += step
            score += step[coarse[a], coarse[b]]
    model.pairs = [(a, b, t) for (a, b), t in tables.items()]
    return model


def probabilities(model: Model, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model.base)
    if model.edges:
        for table, bins in zip(model.tables, _bins(x, model.edges)):
            total += table[bins]
        coarse = _bins(x, model.coarse)
        for a, b, table in model.pairs:
            total += table[coarse[a], coarse[b]]
    return 1 / (1 + np.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", *, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the texts of labelled ``doc_id``s.

    At most about ``fit_rows`` labels are drawn, by a hash of the id. A null
    label, a null id and an id without a document play no part; of several
    labels of one id the highest counts; a null text is empty. Without any
    usable row every score is one half.
    """
    marked = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy(F.col("doc_id").alias("doc_id")).agg(F.max(F.col(label).cast("double")).alias("_label"))
    n = marked.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(1 << 30))
    drawn = marked.filter(draw < min(1.0, fit_rows / max(n, 1)) * (1 << 30))
    # The drawn labels are bounded by fit_rows; no text is moved to find theirs.
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(drawn), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK):
            x = features(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("_label"), *x.T.copy()], ["_label", *FEATURES])

    schema = ", ".join(f"{c} double" for c in ("_label", *FEATURES))
    sample = rows.select("_label", "text").mapInArrow(run, schema).toPandas()
    sample = sample.sort_values(list(sample.columns)).to_numpy()
    return learn(sample[:, 1:], (sample[:, 0] > 0.5).astype(float))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Add ``score`` and ``predicted`` from ``text`` alone; other columns stay, those of the same names are replaced."""
    rows = docs.drop("score", "predicted").withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK):
            p = probabilities(shared.value, features(texts_of(batch, "text")))
            new = [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "score", "predicted"])

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
