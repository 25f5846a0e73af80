import random
from collections import Counter

import pytest
from helpers import tricky_docs, tricky_texts

from tallycast.llm import line_dedup as L

WHITE = " \t\n\x0b\f\r"


def gone_by_hand(texts, least):
    """Lines of every run with enough words that occurs earlier; (id or LAST, text, line) each."""
    docs = {((L.LAST if d is None else d), t) for d, t in texts}
    numbered = {}
    for d, t in docs:
        lines = [(i, x.strip(WHITE)) for i, x in enumerate((t or "").split("\n"))]
        numbered[d, t] = [(i, x) for i, x in lines if x]
    return numbered


def deleted(order, numbered, least):
    first, gone = {}, set()
    for key in order:
        lines = numbered[key]
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += len(lines[b][1].split())
                if n >= least:
                    run = tuple(x for _, x in lines[a : b + 1])
                    if first.setdefault(run, (key, a)) != (key, a):
                        gone |= {(key, lines[k][0]) for k in range(a, b + 1)}
    return gone


def check(spark, texts, least):
    docs = tricky_docs(spark, texts)
    keys = docs.selectExpr("doc_id", "text", "unhex(md5(coalesce(text, ''))) AS k").distinct().collect()
    keyed = {((L.LAST if r.doc_id is None else r.doc_id), r.text): bytes(r.k) for r in keys}
    order = sorted(keyed, key=lambda key: (key[0], keyed[key]))
    want = {(d, keyed[d, t], line) for (d, t), line in deleted(order, gone_by_hand(texts, least), least)}
    got = {(r.doc, bytes(r.text_key), r.line) for r in L.repeated_lines(docs, least).collect()}
    assert got == want
    return docs, want, keyed


@pytest.mark.parametrize("least", [1, 4, 9])
def test_random_lines(spark, least):
    rng = random.Random(least)
    lines = ["a", "b c", "d e f", "", "g", "h i j k l"]
    texts = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for i in range(25)]
    check(spark, texts, least)


def test_odd_documents(spark):
    check(spark, tricky_texts(), 50)
    check(spark, tricky_texts(), 2)


def test_long_copies_and_a_periodic_text(spark):
    block = "\n".join(f"line {i} of the block" for i in range(70))
    texts = [(1, block), (2, "own\n" + block + "\nend"), (3, "x\n" * 90), (4, "fresh line\n" + block.replace("line 40 ", "line forty "))]
    docs, want, keyed = check(spark, texts, 20)
    kept = {r.doc_id: r.text for r in L.without_repeats(docs, 20).collect()}
    assert kept[1] == block and kept[2] == "own\nend" and kept[4] == "fresh line\nline forty of the block"
    assert kept[3].count("x") == 1
    runs = {(r.doc_id, r.first_line, r.last_line, r.n_lines, r.first_doc_id) for r in L.deleted_runs(docs, 20).collect()}
    assert (2, 1, 70, 70, 1) in runs and (4, 1, 40, 40, 1) in runs


def test_what_stays(spark):
    docs = tricky_docs(spark)
    got = L.without_repeats(docs, 50)
    assert got.columns == docs.columns
    left = Counter(r.doc_id for r in got.collect())
    # Copies lose all their lines and go; the empty ones are left alone.
    assert left == Counter([1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11, None, 12, 13])
    assert L.without_repeats(tricky_docs(spark, []), 50).collect() == []
    assert L.deleted_runs(tricky_docs(spark, []), 50).collect() == []
    assert all(r.n_chars == len(r.text or "") for r in got.collect())


@pytest.mark.parametrize("most", [L.BROADCAST_BYTES, 0])
def test_texts_are_not_moved_for_few_lines(spark, monkeypatch, most):
    """The lists of lines that go come to the texts if they are small; else both meet by key, with the same rows."""
    monkeypatch.setattr(L, "BROADCAST_BYTES", most)
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = L.without_repeats(tricky_docs(spark), 50)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (most > 0) == ("SortMergeJoin" not in plan)
        assert Counter(r.doc_id for r in got.collect()) == Counter([1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11, None, 12, 13])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
