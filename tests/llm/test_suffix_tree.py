import math
from collections import Counter, defaultdict

import pytest
from helpers import tricky_docs, tricky_texts, words

from pyspark.sql import functions as F

from tallycast.llm import language, queries
from tallycast.llm import suffix_tree as S


def plain_scores(docs, learn):
    """The same model from plain dictionaries."""
    train = [w for w, known in zip(docs, learn) if known]
    counts = [None] + [Counter() for _ in range(S.DEPTH + 1)]
    for w in train:
        for k in range(1, S.DEPTH + 2):
            for i in range(len(w) - k + 1):
                counts[k][tuple(w[i : i + k])] += 1
    total, distinct = sum(counts[1].values()), len(counts[1])
    kept = defaultdict(dict)
    for k in range(2, S.DEPTH + 2):
        for run, n in counts[k].items():
            share = n / counts[k - 1][run[:-1]]
            ratio = share / (counts[k - 1][run[1:]] / (counts[k - 2][run[1:-1]] if k > 2 else total))
            if n >= S.least(total) and ratio >= S.RATIO and n * math.log(ratio) >= S.DIVERGENCE:
                kept[run[:-1]][run[-1]] = (n - S.DISCOUNT) / counts[k - 1][run[:-1]]
    out = []
    for w in docs:
        base = score = 0.0
        for i, word in enumerate(w):
            p = (counts[1][word,] + 1) / (total + distinct + 1)
            base += math.log10(p)
            for k in range(1, min(S.DEPTH, i) + 1):
                own = kept.get(tuple(w[i - k : i]))
                if own:
                    p = own.get(word, 0) + (1 - sum(own.values())) * p
            score += math.log10(p)
        out.append((len(w), sum(counts[1][x,] > 0 for x in w), total, base, score))
    return out, kept


@pytest.mark.parametrize("chunk", [400, 5 << 20])
def test_scores(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    texts = [t for _, t in tricky_texts()] * 3 + ["a b c d"] * 30 + ["x b c e"] * 12
    docs = spark.createDataFrame([(i, t, i % 5 != 0) for i, t in enumerate(texts)], "doc_id bigint, text string, learn boolean")
    # Function arguments travel by value: the chunk size is set on the driver.
    got = {r.doc_id: r for r in S.score(docs).collect()}
    want, kept = plain_scores([words(t) + ["\0"] for t in texts], [i % 5 != 0 for i in range(len(texts))])
    assert {len(c) for c in kept} == {1, 2}
    for i, (n, known, total, base, score) in enumerate(want):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, i % 5 == 0)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-6, abs_tol=1e-6)


def test_odd_rows(spark):
    docs = tricky_docs(spark).withColumn("learn", F.when(F.col("doc_id") > 1, True))
    got = S.score(docs).collect()
    assert len(got) == len(tricky_texts())
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (4, 5, 6))
    assert all(r.held_out for r in got if r.doc_id in (None, 1))


def test_nothing_to_learn_from_and_no_rows(spark):
    got = S.score(tricky_docs(spark).withColumn("learn", F.lit(False))).collect()
    assert {(r.base_score, r.score, r.train_tokens, r.n_known) for r in got} == {(0.0, 0.0, 0, 0)}
    assert S.score(tricky_docs(spark, []).withColumn("learn", F.lit(True))).collect() == []


def test_the_size_of_the_corpus_drops_no_run(spark):
    assert S.least(10**3) == S.least(10**11) == S.LEAST
    filler = spark.range(12).select((F.col("id") + 1000).alias("doc_id"), F.expr("repeat('z ', 1000000)").alias("text"), F.lit(True).alias("learn"))
    few = spark.range(S.LEAST + 1).select(F.col("id").alias("doc_id"), F.lit("p q").alias("text"), (F.col("id") > 0).alias("learn"))
    got = S.score(few.unionByName(filler).coalesce(2)).filter("doc_id = 0").collect()[0]
    n, total = S.LEAST, 12 * 1_000_001 + 3 * S.LEAST
    alone = lambda count: (count + 1) / (total + 4 + 1)
    after = lambda count: (n - S.DISCOUNT) / n + S.DISCOUNT / n * alone(count)
    assert got.train_tokens == total
    assert math.isclose(got.score, math.log10(alone(n) * after(n) * after(n + 12)), rel_tol=1e-6)


def test_the_query_has_the_whole_model(spark, monkeypatch, tmp_path):
    texts = [t for _, t in tricky_texts()] * 3 + ["a b c d"] * 30 + ["x b c e"] * 12 + ["rare pair"] * 5 + ["m n n " * 5000] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    learn = [r.learn for r in docs.select((language.remainder(F.col("doc_id"), 7) != 2).alias("learn")).collect()]
    got = {r.doc_id: r.score for r in queries.QUERIES["op3_suffix_tree"](spark, str(tmp_path)).collect()}
    monkeypatch.setattr(S, "DEPTH", 3)
    tokens = [words(t) + ["\0"] for t in texts]
    want, kept = plain_scores(tokens, learn)
    train = [w for w, known in zip(tokens, learn) if known]
    single = Counter(x for w in train for x in w)
    shares = {(a, b): s / (single[b] / sum(single.values())) for (a, *more), own in kept.items() if not more for b, s in own.items()}
    # All that a smaller model leaves out: long contexts, few occurrences, shares a little higher.
    assert {len(c) for c in kept} == {1, 2, 3} and S.LEAST == 4
    assert 4 <= single["rare"] < 8 and "pair" in kept["rare",]
    assert any(1 < ratio < 2 for ratio in shares.values())
    for i, row in enumerate(want):
        assert math.isclose(got[i], row[-1], rel_tol=1e-6, abs_tol=1e-6)
