"""Lexical search against plain scores of all pairs."""

import math
import random
import re
from collections import Counter

import pytest

from helpers import LOWER, tricky_docs, tricky_texts
from tallycast.llm import lexical

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def by_hand(docs, items, top):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    held = [h for h in held if h[2]]
    n_docs, length = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for d, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item_id, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def prose(rng, words, n):
    return " ".join(rng.choices(words, k=n))


def corpus(rng):
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(3000)] + ["Été", "日本", "o'clock", "A-b_c"]
    docs = tricky_texts() + [(100 + i, prose(rng, words, rng.randint(1, 60))) for i in range(900)]
    docs += [(2000 + i, docs[30][1]) for i in range(100)]  # a large group of copies
    items = [(i, prose(rng, words, rng.randint(1, 30))) for i in range(70)]
    items += [(70, docs[30][1]), (71, None), (72, ""), (73, "nowhere else"), (None, "w1 w2 w2"), (5, "w3 w4"), (5, "w3 w4")]
    return docs, items


@pytest.mark.parametrize("cells, first, top, held", [(4 << 20, 20_000, 20, 200_000), (2000, 100, 5, 50), (1, 10, 1, 1)])
def test_by_hand(spark, monkeypatch, cells, first, top, held):
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "FIRST_DOCS", first)
    docs, items = corpus(random.Random(12))
    items = items[-12:] if cells == 1 else items
    frame = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id bigint, text string, n int, rank int, score int").repartition(3)
    got = lexical.search(frame, spark.createDataFrame(items, "item_id bigint, text string"), top).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(docs, items, top)


@pytest.mark.parametrize("exact_floats", [True, False])
def test_pairs_are_given_up(exact_floats):
    """Most pairs of a document and an item are never scored, and what is found stays whole."""
    import numpy as np
    import pyarrow as pa

    times = np.eye(16, 64, dtype=np.int64) + np.eye(16, 64, 1, dtype=np.int64)
    items = lexical.Items(list(range(16)), pa.array([f"t{i}" for i in range(64)], pa.large_string()), times)
    query = lexical.prepared(items, {t: 10 + t for t in range(64)}, 4096, 4096 * 4, 3)
    if not exact_floats:
        query.weights = query.weights.astype(np.int64)
    rng = np.random.default_rng(5)
    lists = [sorted(set(rng.integers(0, 64, 3)) | {i % 64}) for i in range(4096)]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(4096), pa.int64()), "n": pa.array([4] * 4096, pa.int64()),
        "terms": pa.array(lists, pa.list_(pa.int32())), "tfs": pa.array([[1 + int(t) % 3 for t in x] for x in lists], pa.list_(pa.int64())),
    })
    search = lexical.Search(query)
    search.batch(batch)
    item, doc, _, score = search.cut()
    assert search.scored < 16 * 4096 / 4
    weights = query.weights.astype(np.int64)
    values = np.zeros((4096, 64), np.int64)
    for i, x in enumerate(lists):
        for t in x:
            tf = 1 + int(t) % 3
            values[i, t] = 10**9 * tf // (1000 * tf + 12 * 100)
    want = [sorted((-int(s), d) for d, s in enumerate(values @ weights[i]) if s)[:3] for i in range(16)]
    got = [sorted((-int(s), int(d)) for k, d, s in zip(item, doc, score) if k == i) for i in range(16)]
    assert got == want


def test_no_rows(spark):
    docs = tricky_docs(spark)
    items = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    for a, b in ((docs.filter("doc_id < 0"), items), (docs, items.filter("item_id < 0"))):
        out = lexical.search(a, b)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]
