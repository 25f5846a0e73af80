import math
import unicodedata
from collections import Counter

import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plans import count, mentions
from tallycast.config import EncoderSpec
from tallycast.functions.text import TOKEN_PATTERN, fold_accents, ngram_range, ngrams, tokens
from tallycast.operators import text_encoding
from tallycast.operators.text_encoding import (
    HashEncoding,
    english_stop_words,
    fit_tfidf,
    frequent_stats,
    term_counts,
    term_stats,
    vocabulary,
)

TEXTS = ["Red apple pie", "red APPLE tart", "the red pear", "", None, "pear pear pie_2 é", "Crème brûlée of the day"]
OPEN = EncoderSpec(tfidf_min_df=1, tfidf_max_df=1.0)


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def terms_by_hand(text, stop=()):
    plain = "".join(
        c for c in unicodedata.normalize("NFKD", (text or "").lower()) if not unicodedata.combining(c)
    )
    words = [w for w in regex.findall(TOKEN_PATTERN, plain) if w not in stop]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    assert [r[0] for r in df.select(ngrams(F.col("w"), 2)).collect()] == [["a b", "b c"], [], []]
    assert [r[0] for r in df.select(ngrams(F.col("w"), 3)).collect()] == [["a b c"], [], []]
    assert df.select(ngram_range(F.col("w"), 1, 2)).first()[0] == ["a", "b", "c", "a b", "b c"]


def test_tokens_and_accents(spark):
    got = docs(spark).select(tokens(F.col("t"), english_stop_words())).collect()
    assert got[6][0] == ["creme", "brulee", "day"]
    assert got[5][0] == ["pear", "pear", "pie_2"]
    assert got[3][0] == [] and got[4][0] == []
    df = docs(spark, ["Škoda ét ½ ﾊ"])
    assert df.select(fold_accents(F.col("t"))).first()[0] == "Skoda et ½ ハ"


def test_generators_repeat_nothing(spark):
    """No chain of expressions is copied into a filter ahead of a generator."""
    learned = fit_tfidf(docs(spark), "t", OPEN)
    assert mentions(learned.long(docs(spark)), "regexp_extract_all") == 1
    assert mentions(term_counts(docs(spark), "t"), "regexp_extract_all") == 1


def test_term_counts(spark):
    rows = term_counts(docs(spark), "t").collect()
    for i, text in enumerate(TEXTS):
        want = Counter(terms_by_hand(text, english_stop_words()))
        assert {r["term"]: r["tf"] for r in rows if r["i"] == i} == want


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab éE_1.\n", max_size=30), min_size=1, max_size=5))
def test_term_counts_of_anything(spark, texts):
    rows = term_counts(docs(spark, texts), "t", EncoderSpec(stop_words=())).collect()
    got = [Counter({r["term"]: r["tf"] for r in rows if r["i"] == i}) for i in range(len(texts))]
    assert got == [Counter(terms_by_hand(t)) for t in texts]


def test_term_stats_shuffle_by_term_only(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").repartition(8)
    assert count(term_stats(texts, "text"), "Exchange hashpartitioning") == 1


def test_vocabulary_bounds_and_ties(spark):
    stats = spark.createDataFrame(
        [("b", 5, 2), ("a", 5, 2), ("rare", 9, 1), ("common", 99, 10), ("c", 4, 3)], "term string, tf long, df long"
    )
    spec = EncoderSpec(tfidf_terms=2, tfidf_min_df=2, tfidf_max_df=0.95)
    got = vocabulary(stats, 10, spec).orderBy("term_index").collect()
    assert [r["term"] for r in got] == ["a", "b"]
    assert math.isclose(got[0]["idf"], math.log(11 / 3) + 1)
    share = EncoderSpec(tfidf_terms=5, tfidf_min_df=0.25, tfidf_max_df=3)
    assert [r["term"] for r in vocabulary(stats, 10, share).collect()] == ["c"]


@pytest.mark.parametrize("k, tracked, most", [(500, 100_000, 1_000_000), (30, 2000, 1_000_000), (30, 100, 800)])
def test_candidates_give_the_same_vocabulary(spark, sf_dir, monkeypatch, k, tracked, most):
    """Whether the first summary is enough, or a larger one, or none."""
    monkeypatch.setattr(text_encoding, "MOST_TRACKED", most)
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = texts.count()
    for bounds in ((5, 0.95), (2, 0.3), (0.05, 60)):
        spec = EncoderSpec(tfidf_terms=k, tfidf_min_df=bounds[0], tfidf_max_df=bounds[1])
        want = vocabulary(term_stats(texts, "text", spec), n, spec).orderBy("term").collect()
        stats, docs = frequent_stats(texts, "text", spec, tracked=tracked)
        assert docs == {0: n}
        got = vocabulary(stats.drop("fold"), n, spec).orderBy("term").collect()
        assert got == want and len(got) > 0


def test_candidates_with_trigrams(spark):
    df = docs(spark, ["red apple pie"] * 4 + ["apple pie red", "pear"])
    spec = EncoderSpec(tfidf_ngrams=(1, 3), tfidf_min_df=2, tfidf_max_df=1.0)
    want = vocabulary(term_stats(df, "t", spec), 6, spec).orderBy("term").collect()
    got = vocabulary(frequent_stats(df, "t", spec)[0].drop("fold"), 6, spec).orderBy("term").collect()
    assert got == want and "red apple pie" in {r["term"] for r in got}


def test_summaries_of_folds_add_up(spark, sf_dir):
    """One pass for all folds gives what a fit of each fold gives."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    first = F.when(F.col("doc_id") % 5 < 4, (F.col("doc_id") % 5).cast("int"))
    texts = texts.withColumn("first_train_fold", first)
    spec = EncoderSpec(tfidf_terms=40)
    for fold, learned in enumerate(text_encoding.fit_tfidf_folds(texts, "text", 4, spec)):
        alone = fit_tfidf(texts.filter(F.col("first_train_fold") <= fold), "text", spec)
        assert learned == alone and len(learned.terms) == 40


def test_tfidf_by_hand(spark):
    df = docs(spark)
    learned = fit_tfidf(df, "t", OPEN)
    per_doc = [Counter(terms_by_hand(t, english_stop_words())) for t in TEXTS]
    df_of = Counter(t for d in per_doc for t in d)
    idf = {t: math.log((1 + len(TEXTS)) / (1 + n)) + 1 for t, n in df_of.items()}
    assert learned.terms == sorted(df_of)
    rows = learned.long(df).collect()
    for i, d in enumerate(per_doc):
        weights = {t: n * idf[t] for t, n in d.items()}
        norm = math.sqrt(sum(w * w for w in weights.values())) or 1.0
        want = {t: w / norm for t, w in weights.items()}
        assert {r["term"]: r["tfidf"] for r in rows if r["i"] == i} == pytest.approx(want)
    assert learned.apply(df).count() == len(TEXTS)
    assert learned.names[0].startswith("t_tfidf_")


def test_tfidf_applies_without_a_shuffle(spark):
    df = docs(spark)
    assert count(fit_tfidf(df, "t", OPEN).apply(df), "Exchange") == 0


def test_empty_vocabulary(spark):
    df = docs(spark, ["", None])
    learned = fit_tfidf(df, "t")
    assert learned.terms == [] and learned.long(df).count() == 0
    assert learned.apply(df).columns == ["i"]


def test_hash_vector(spark):
    encoding = HashEncoding("t", EncoderSpec(hash_buckets=50))
    long = {r["i"]: (r["bucket"], r["sign"]) for r in encoding.long(docs(spark)).collect()}
    assert long[3] == long[4]
    for r in encoding.apply(docs(spark)).select("i", vector_to_array("t_hash").alias("v")).collect():
        bucket, sign = long[r["i"]]
        assert r["v"][bucket] == sign and sum(map(abs, r["v"])) == 1
    unsigned = HashEncoding("t", EncoderSpec(hash_signed=False))
    assert {r["sign"] for r in unsigned.long(docs(spark)).collect()} == {1}


def test_stop_words_are_sparks_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(english_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_sql_twins_need_no_session():
    """Every twin can be built where neither Spark's jars nor a JVM are in reach."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; n = len(e.oracle_sql()); from pyspark import SparkContext as c; assert c._gateway is None; print(n)"
    root = Path(__file__).resolve().parent.parent
    said = subprocess.run([sys.executable, "-c", code], cwd=root, env={"SPARK_HOME": "/nowhere", "PATH": "/nowhere"}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout) >= 50


def test_texts_are_cut_once(spark, monkeypatch):
    """However many passes a fit makes; and tokens may stand for their texts."""
    calls = []
    monkeypatch.setattr(text_encoding, "tokens", lambda *a: calls.append(a) or tokens(*a))
    df = docs(spark)
    learned = fit_tfidf(df, "t", OPEN)
    assert len(calls) == 1
    cut = text_encoding.tokenised(df, "t", OPEN)
    assert fit_tfidf(cut, "t", OPEN) == learned
    assert sorted(learned.long(cut).collect()) == sorted(learned.long(df).collect())
    assert len(calls) == 3


@pytest.mark.parametrize("most", [0, 20_000])
def test_counts_in_rows_and_by_join(spark, monkeypatch, most):
    monkeypatch.setattr(text_encoding, "MOST_IN_ROW", most)
    got = {r["term"]: (r["tf"], r["df"]) for r in frequent_stats(docs(spark), "t", OPEN)[0].collect()}
    want = [terms_by_hand(t, english_stop_words()) for t in TEXTS]
    assert got == {t: (sum(w.count(t) for w in want), sum(t in w for w in want)) for t in set(sum(want, []))}


@pytest.mark.parametrize("k, low, high", [(3, 1, 1.0), (10, 2, 0.7), (100, 1, 1.0), (2, 9, 1.0)])
def test_terms_by_their_words(spark, k, low, high):
    """Terms of frequent words, with ties, full and unfilled vocabularies, in every fold; no summary is made."""
    texts = ["b a b a", "a b c a b", "c c c", None, "aa bb aa bb aa", "aa bb cc aa bb", "cc dd", "dd ee ff", "bb aa", "aa"] * 2
    spec = EncoderSpec(tfidf_terms=k, tfidf_min_df=low, tfidf_max_df=high, stop_words=())
    df = spark.createDataFrame([(i, t, i % 3 if i % 4 else None) for i, t in enumerate(texts)], "i int, t string, first_train_fold int")
    learned = text_encoding.fit_tfidf_folds(df, "t", 3, spec)
    for fold, got in enumerate(learned):
        rows = df.filter(F.col("first_train_fold") <= fold)
        want = vocabulary(term_stats(rows, "t", spec), rows.count(), spec).orderBy("term_index").collect()
        assert got.terms == [r["term"] for r in want]
        assert got.idf == pytest.approx([r["idf"] for r in want])


def test_words_that_fill_the_vocabulary_need_no_summary(spark, monkeypatch):
    monkeypatch.setattr(text_encoding, "term_states", None)
    df = docs(spark, ["red apple pie"] * 4 + ["apple pie red", "pear"])
    assert fit_tfidf(df, "t", EncoderSpec(tfidf_terms=3, tfidf_min_df=2, tfidf_max_df=1.0)).terms == ["apple", "apple pie", "pie"]
