import math

import numpy as np
import pyarrow as pa
from helpers import tricky_docs, tricky_texts

from tallycast.llm import quality as Q
from tallycast.llm.language import remainder


def auc(y, s):
    order = np.argsort(np.argsort(s))
    n1, n0 = y.sum(), (1 - y).sum()
    return (order[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


def plain_learn(x, y, rounds, pairs):
    """The same boosting row by row and cut by cut; returns the score of each row of ``x``."""
    n, columns = len(y), range(len(x[0]))

    def edges(k, bins):
        values = sorted(row[k] for row in x)
        return sorted({values[math.ceil(share * (n - 1) - 1e-12)] for share in (i / bins for i in range(1, bins))})

    def binned(cuts):
        return [[sum(row[k] >= e for e in cuts[k]) for row in x] for k in columns]

    fine, coarse = binned([edges(k, Q.BINS) for k in columns]), binned([edges(k, Q.PAIR_BINS) for k in columns])
    rate = (sum(y) + 0.5) / (n + 1)
    score = [math.log(rate / (1 - rate))] * n

    def slopes():
        p = [1 / (1 + math.exp(-s)) for s in score]
        return [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p]

    def worth(rows, g, w):
        return sum(g[i] for i in rows) ** 2 / (sum(w[i] for i in rows) + 1)

    def value(rows, g, w):
        return sum(g[i] for i in rows) / (sum(w[i] for i in rows) + 1)

    for _ in range(rounds):
        for k in columns:
            g, w = slopes()
            parts = [list(range(n))]
            for _ in range(2):
                best = None
                for part in parts:
                    for cut in range(1, max(fine[k]) + 1):
                        left, right = [i for i in part if fine[k][i] < cut], [i for i in part if fine[k][i] >= cut]
                        gain = worth(left, g, w) + worth(right, g, w) - worth(part, g, w)
                        if min(len(left), len(right)) >= Q.LEAF_ROWS and gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                            best = gain, part, left, right
                if best:
                    parts = [q for q in parts if q is not best[1]] + [best[2], best[3]]
            for part in parts:
                step = Q.RATE * value(part, g, w)
                for i in part:
                    score[i] += step

    def quartered(a, b):
        g, w = slopes()
        best = None
        for i in range(1, max(coarse[a]) + 1):
            for j in range(1, max(coarse[b]) + 1):
                parts = [[r for r in range(n) if (coarse[a][r] >= i, coarse[b][r] >= j) == q] for q in ((False, False), (False, True), (True, False), (True, True))]
                full = [q for q in parts if len(q) >= Q.LEAF_ROWS]
                gain = sum(worth(q, g, w) for q in full) - worth(range(n), g, w)
                if best is None or gain > best[0] + 1e-12:
                    best = gain, [(q, value(q, g, w)) for q in full]
        return best

    gains = {(a, b): quartered(a, b)[0] for a in columns for b in columns if a < b}
    chosen = sorted((p for p in gains if gains[p] > 0), key=lambda p: (-gains[p], p))[:pairs]
    for _ in range(rounds // 2 if chosen else 0):
        for a, b in chosen:
            for part, v in quartered(a, b)[1]:
                for i in part:
                    score[i] += Q.RATE * v
    return [1 / (1 + math.exp(-s)) for s in score]


def test_the_plain_version(monkeypatch):
    for name, value in (("BINS", 6), ("PAIR_BINS", 4), ("LEAF_ROWS", 7)):
        monkeypatch.setattr(Q, name, value)
    rng = np.random.default_rng(4)
    x = rng.random((150, 3)).round(2)
    y = (rng.random(150) < np.where((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4), 0.85, 0.2)).astype(float)
    model = Q.learn(x, y, rounds=6, pairs=2)
    assert len(model.pairs) == 2
    assert np.allclose(Q.probabilities(model, x), plain_learn(x.tolist(), y.tolist(), 6, 2), atol=1e-9)


def test_main_effects_and_an_interaction_are_learned():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 3))
    odds = 3 * (x[:, 0] - 0.5) + 5 * ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)) - 2.5
    y = (rng.random(6000) < 1 / (1 + np.exp(-odds))).astype(float)
    model = Q.learn(x[:4000], y[:4000], rounds=120, pairs=1)
    assert [(a, b) for a, b, _ in model.pairs] == [(1, 2)]
    assert auc(y[4000:], Q.probabilities(model, x[4000:])) > 0.85
    assert auc(y[4000:], Q.probabilities(Q.learn(x[:4000], y[:4000], rounds=120, pairs=0), x[4000:])) < 0.8
    # A score is a sum of look-ups.
    one = x[4000:4001]
    total = model.base + sum(t[np.searchsorted(e, one[0, k], side="right")] for k, (t, e) in enumerate(zip(model.tables, model.edges)))
    a, b, table = model.pairs[0]
    total += table[np.searchsorted(model.coarse[a], one[0, a], side="right"), np.searchsorted(model.coarse[b], one[0, b], side="right")]
    assert abs(Q.probabilities(model, one)[0] - 1 / (1 + np.exp(-total))) < 1e-12


def test_features_do_not_depend_on_the_batch():
    texts = [t or "" for _, t in tricky_texts()] + ["same line\nsame line\nother", "A!! B##"]
    whole = Q.features(pa.array(texts, pa.large_string()))
    assert whole.shape == (len(texts), len(Q.FEATURES)) and np.isfinite(whole).all()
    for row, t in zip(whole, texts):
        assert np.allclose(row, Q.features(pa.array([t], pa.large_string()))[0])
    assert not whole[3].any()
    assert np.isclose(whole[-2][Q.FEATURES.index("repeated_lines")], 1 / 3)


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = remainder(docs["doc_id"], 4) == 2
    scored = Q.score(docs.filter(held), Q.fit(docs.filter(~held), labels)).join(labels, "doc_id").toPandas()
    assert auc(scored["quality"].to_numpy(), scored["score"].to_numpy()) > 0.9


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, "a"), (1, 0, "b"), (4, 0, "c"), (5, None, "d"), (None, 1, "e"), (99, 1, "f")], "doc_id bigint, quality int, text string")
    docs = tricky_docs(spark)
    got = Q.score(docs, Q.fit(docs, labels))
    assert got.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(tricky_texts()) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    nothing = Q.fit(docs, labels.limit(0))
    assert {r.score for r in Q.score(docs, nothing).collect()} == {0.5}
    assert Q.score(tricky_docs(spark, []), nothing).collect() == []
