import math

import pyarrow as pa
from helpers import tricky_docs, tricky_texts

from tallycast.llm import language as L

TEXTS = {"aa": ["the cat sat on the mat and the hat", "that is the end of the cat"], "bb": ["der hund und die katze", "und das ist der hund"]}


def labelled(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang, own in TEXTS.items() for t in own * 10)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def plain_bits(text, own, kept, size):
    """Bits of a text by walking from the longest kept context to the shortest."""
    symbols = [own["number"][L.SYMBOL[b]] for b in text.encode()]
    total = 0.0
    for i, s in enumerate(symbols):
        context = tuple(([0] * L.ORDER + symbols)[i : i + L.ORDER])
        bits = math.log2(size)
        for k in range(L.ORDER + 1):
            c = context[L.ORDER - k :]
            if c not in kept:
                break
            counts = own["counts"].get(c, {})
            n, kinds = sum(counts.values()), len(counts)
            if n:
                bits = -math.log2(counts[s] / (n + kinds)) if s in counts else -math.log2(kinds / (n + kinds)) + bits
        total += bits
    return total


def test_code_lengths_are_those_of_the_trees(spark):
    model = L.fit(labelled(spark))
    assert model.languages == ["aa", "bb"]
    used = sorted({0} | {int(L.SYMBOL[b]) for own in TEXTS.values() for t in own for b in t.encode()})
    size = len(used) + 1
    number = {s: used.index(s) if s in used else size - 1 for s in range(L.SYMBOLS)}
    counts, every = {}, {}
    for lang, own in TEXTS.items():
        counts[lang] = {}
        for t in own * 10:
            symbols = [0] * L.ORDER + [number[L.SYMBOL[b]] for b in t.encode()]
            for i in range(L.ORDER, len(symbols)):
                for k in range(L.ORDER + 1):
                    c = tuple(symbols[i - k : i])
                    counts[lang].setdefault(c, {}).setdefault(symbols[i], 0)
                    counts[lang][c][symbols[i]] += 1
                    every[c] = every.get(c, 0) + 1
    kept = {c for c, n in every.items() if n >= L.MIN_CONTEXT or not c}
    texts = ["the hund", "x", "", "katze und cat", "ÄÖ 12!", "zzz" * 50]
    got = L.code_lengths(model, pa.array(texts, pa.large_string()))
    for row, t in zip(got, texts):
        for bits, lang in zip(row, model.languages):
            assert math.isclose(bits, plain_bits(t, {"number": number, "counts": counts[lang]}, kept, size), rel_tol=1e-4, abs_tol=1e-3)


def test_predictions(spark):
    model = L.fit(labelled(spark))
    docs = tricky_docs(spark, [*tricky_texts(), (50, "the cat and the hat"), (51, "der hund")])
    got = L.predict(docs, model)
    assert got.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(tricky_texts()) + 2
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == L.UNKNOWN) == (not letters) and 0 <= r.score <= 1
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (50, 51)} == {50: "aa", 51: "bb"}


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = L.remainder(docs["doc_id"], 5) == 0
    rows = L.predict(docs.filter(held), L.fit(docs.filter(~held))).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_nothing_learned_and_no_rows(spark):
    model = L.fit(labelled(spark).limit(0))
    assert {(r.lang_pred, r.score) for r in L.predict(tricky_docs(spark), model).collect()} == {(L.UNKNOWN, 0.0)}
    assert L.predict(tricky_docs(spark, []), L.fit(labelled(spark))).collect() == []


def test_a_rare_language_keeps_its_contexts(spark):
    """Many frequent contexts of one language take nothing from another."""
    import random

    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèêçñåøæıłşžčřů"
    noise = ["".join(rng.choices(letters, k=9000)) for _ in range(400)]
    rows = [(i, t, "noise") for i, t in enumerate(noise)] + [(1000 + i, "qu'est-ce que c'est", "rare") for i in range(9)]
    model = L.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    alone = L.fit(spark.createDataFrame(rows[-9:], "doc_id bigint, text string, lang string"))
    assert len(model.row[0]) > 20_000 and len(model.bits[1]) == len(alone.bits[0])
    texts = pa.array(["qu'est-ce que c'est"], pa.large_string())
    # Only the alphabet is larger, which costs the same text nothing.
    assert math.isclose(L.code_lengths(model, texts)[0, 1], L.code_lengths(alone, texts)[0, 0], rel_tol=1e-6)
