"""The source audit against plain arithmetic over all terms."""

import re
from collections import Counter, defaultdict

import pytest

from helpers import LOWER, tricky_docs, tricky_texts
from tallycast.llm import divergence

TERM = "[^\x00-\x40\x5b-\x60\x7b-\x7f]+"


def by_hand(docs, least, top):
    """``docs``: (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = re.findall(TERM, text.translate(LOWER))
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        names = {s for g, s in counts if g == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in names}
        q = shares(sum((counts[lang, s] for s in names), Counter()))
        for s in names:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names - {s}]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", pair), ("term", term)):
                rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[: top if part == "term" else None]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(rows, 1)]
    return sorted(out)


def corpus():
    rows = [(f"l{i % 3}" if i % 11 else None, f"s{i % 4}" if i % 7 else None, t) for i, (_, t) in enumerate(tricky_texts() * 4)]
    rows += [("fr", f"s{i % 5}", f"État état naïve {'préfixe' + 'abcdef'[i % 6]} préfixe{i} préfixelong{i % 2} Ünï{'x' * (i % 9)}") for i in range(40)]
    rows += [("zz", "alone", "unique words only here"), ("yy", "a", None), ("yy", "b", "nothing is repeated"), ("fr", "s0", "a b C " * 3000)]
    return rows


@pytest.mark.parametrize("levels, least, top", [((2, 4, 6, 8), 3, 200), ((1, 3), 2, 5), ((), 3, 200), ((30,), 1, 2)])
def test_by_hand(spark, monkeypatch, levels, least, top):
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", 200 if top == 5 else 16 << 20)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "lang string, source string, text string, n int, c int, term string").repartition(3)
    got = divergence.audit(docs, spec=divergence.Spec(levels, least, top)).collect()
    assert sorted(tuple(r) for r in got) == by_hand(rows, least, top)


def test_prefixes_are_given_up(spark):
    """What is left at a level is what has enough documents under the prefix, not under the terms."""
    texts = ["abc1 abd", "abe", "abf", "xyz", "xyz", "xyz xyw"]
    docs = spark.createDataFrame([("l", "s", t) for t in texts], "lang string, source string, text string").coalesce(2)
    spec = divergence.Spec(levels=(2,), least=3)
    left = divergence.refined(divergence.block_counts(docs, spec), spec)
    assert {r["term"] for r in left.collect()} == {"abc", "abd", "abe", "abf", "xyz", "xyw"}
    spec = divergence.Spec(levels=(2, 3), least=3)
    left = divergence.refined(divergence.block_counts(docs, spec), spec)
    assert {r["term"] for r in left.collect()} == {"xyz"}
    assert [(r["term"], r["docs"], r["c"]) for r in divergence.kept_terms(docs, spec).collect()] == [("xyz", 3, 3)]


def test_large_counts(spark):
    df = spark.sql("select 9000000000 as a, 12345678901234 as b, 98765432109876 as n, 1000000 as v")
    row = df.select(*[divergence.share(df[c], df["n"], df["v"]).alias(c) for c in "ab"]).first()
    assert [row["a"], row["b"]] == [1 + 10**9 * (x + 1) // (98765432109876 + 1000000) for x in (9000000000, 12345678901234)]


def test_no_rows(spark):
    docs = tricky_docs(spark)
    out = divergence.audit(docs.filter("doc_id < 0"))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0
