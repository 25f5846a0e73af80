import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.llm import pivot_search

SCHEMA = "vec_id bigint, embedding array<float>, score int, rank string, cell int, v int"


def best(vectors, k, scale=64.0):
    ok = [(i, [int(np.floor(scale * np.float64(np.float32(x)))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in ok:
        if q % 20:
            continue
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def searched(spark, vectors, k=20):
    rows = spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in vectors], SCHEMA)
    got = pivot_search.search(rows, F.col("vec_id") % 20 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_many_vectors_with_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(0, 0.3, 8).round(3).tolist()) for i in range(700)]
    hot = vectors[5][1]
    vectors += [(1000 + i, hot) for i in range(400)]  # ties
    assert searched(spark, vectors) == best(vectors, 20)


@pytest.mark.parametrize(
    "vectors",
    [
        [],
        [(0, [1.0, 2.0])],
        [(0, [1.0]), (20, [2.0]), (1, [-3.0])],
        [(0, []), (1, []), (20, [])],
        [(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [0.0, 0.0])],
        [(0, [1.0, 2.0]), (None, [9.0, 9.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.5, 0.25])],
        [(0, [1.0, 2.0]), (7, [1.0]), (8, [1.0, 2.0, 5.0])],
    ],
)
def test_odd_tables(spark, vectors):
    longest = max([len(v) for _, v in vectors if v] or [0])
    filled = [(i, None if v is None else v + [0.0] * (longest - len(v))) for i, v in vectors]
    assert searched(spark, vectors, 3) == best(filled, 3)


def test_repeated_rows_are_candidates_each(spark):
    got = searched(spark, [(0, [1.0]), (0, [1.0]), (3, [2.0]), (3, [2.0])], 5)
    assert got == [(0, 1, 3, 64 * 128), (0, 2, 3, 64 * 128)]


def test_scores_beyond_doubles(spark):
    got = searched(spark, [(0, [3.0e7, 1.0]), (1, [3.0e7, 1.0]), (2, [3.0e7, 0.0])], 2)
    big = int(64 * 3.0e7) ** 2
    assert got == [(0, 1, 1, big + 64 * 64), (0, 2, 2, big)]


def test_large_components_do_not_stop_the_index(spark, monkeypatch):
    """A few vectors beyond doubles are met by all; pairs of the others go by the index."""
    monkeypatch.setattr(pivot_search, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(0, 0.3, 8).round(3).tolist()) for i in range(300)]
    for i, large in ((20, 3e6), (33, -1e6), (40, 1e12), (55, 1e15), (60, 2e6)):
        vectors[i][1][i % 8] = large
    clipped = [(q, r, v, max(-pivot_search.LONG, min(pivot_search.LONG, s))) for q, r, v, s in best(vectors, 20)]
    got = searched(spark, vectors)
    assert [x for x in got if x[0] != 40] == [x for x in clipped if x[0] != 40]
    assert [x[:3] for x in got] == [x[:3] for x in clipped]


def test_one_large_vector_changes_the_work_little(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 0.3, (4000, 16))
    x[77, 3] = 1e6
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, v array<double>").selectExpr("vec_id", "transform(v, x -> floor(64 * x) + 0D) AS v")
    index, blocks = pivot_search.build(rows)
    assert index.cells[-1].tolist()[2:] == [1.0, 1.0] and index.cells[:-1, 2].sum() == 3999
    assert (index.cells[:-1, 2] > 0).sum() > 100
