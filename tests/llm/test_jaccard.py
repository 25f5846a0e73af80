import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import linked_groups, shingle_sets, tricky_docs, tricky_texts, words

from tallycast.llm import jaccard as J
from tallycast.llm.components import components
from tallycast.llm.words import shingles_of, words_of


def test_word_hashes_tell_words_apart():
    texts = [t or "" for _, t in tricky_texts()] + ["ÀB àb", "a\x0bb\x0cc"]
    found = words_of(pa.array(texts, pa.large_string()))
    want = [w for t in texts for w in words(t)]
    assert found.counts.tolist() == [len(words(t)) for t in texts]
    assert len(set(zip(want, found.hashes.tolist()))) == len(set(want)) == len(set(found.hashes.tolist()))
    hashes, offsets = shingles_of(found, 3)
    sets = shingle_sets(texts, 3)
    assert [len(set(hashes[a:b].tolist())) for a, b in zip(offsets[:-1], offsets[1:])] == [len(s) for s in sets]
    assert len(set(hashes.tolist())) == len(set().union(*sets))


def expected(texts, spec):
    sets = shingle_sets([t for _, t in texts], spec.words)
    groups = linked_groups(sets, spec.part, spec.whole)
    out = []
    for i, (d, _) in enumerate(texts):
        ids = [e for (e, _), g in zip(texts, groups) if g == groups[i] and e is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return Counter(out)


@pytest.mark.parametrize("spec", [J.Spec(3, 90, 100), J.Spec(5, 80, 100), J.Spec(2, 50, 100)])
def test_odd_documents(spark, spec):
    got = Counter(map(tuple, J.groups(tricky_docs(spark), spec).collect()))
    assert got == expected(tricky_texts(), spec)


def test_chains_and_common_passages(spark, monkeypatch):
    monkeypatch.setattr(J, "COMMON", 4)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = rng.choices(vocabulary, k=60)
    texts = []
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice([8, 40, 120]))
        if group % 2:
            base = shared + base  # a long passage that half of the groups share
        for _ in range(12):  # each copy is made from the last: the ends of the chain differ a lot
            texts.append((len(texts), " ".join(base)))
            base = base[:]
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
    for spec in (J.Spec(3, 90, 100), J.Spec(3, 70, 100)):
        assert Counter(map(tuple, J.groups(tricky_docs(spark, texts), spec).collect())) == expected(texts, spec)


def test_sketches_never_lose_a_link():
    rng = np.random.default_rng(0)
    for n in (1, 5, 300, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(0.95 * len(a)) + 1], rng.integers(0, 2**63, n // 20).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        batch = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "_sketch_a": [J._sketch(a)], "_sketch_b": [J._sketch(b)]})
        (out,) = J._possible(J.Spec(3, 90, 100))([batch])
        if 100 * shared >= 90 * (len(a) + len(b) - shared):
            assert out.column("may")[0].as_py()


def test_longer_prefix_only_where_it_pays():
    assert J.extension(np.zeros(20, np.int64), 5, 20) == 1
    assert J.extension(np.full(20, 1000), 5, 20) > 1


def test_one_of_each(spark):
    docs = tricky_docs(spark)
    got = J.one_of_each(docs, J.Spec(5, 80, 100))
    assert got.columns == docs.columns
    # 1, 2, 3, 11 (twice) and one without id are alike; 8 and 12 have the same words.
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted([1, 4, 5, 6, 7, 8, 9, 10, None, 13], key=str)


def test_empty_table(spark):
    assert J.groups(tricky_docs(spark, [])).collect() == []
    assert J.one_of_each(tricky_docs(spark, [])).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 200), (300, 301), (None, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 0, 100: 100, 300: 300, 301: 300}
