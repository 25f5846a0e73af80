from collections import Counter

from helpers import tricky_docs, tricky_texts

from tallycast.llm import decontaminate as D

ITEMS = [
    (1, " ".join(f"item{i} holds the {i % 3} answer" for i in range(12))),
    (2, "tiny item"),
    (3, None),
    (4, ""),
    (5, " ".join(["again"] * 30)),
    (5, " ".join(f"second{i}" for i in range(30))),
]


def words(t):
    return (t or "").lower().split()


def bag(w):
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def by_hand(texts, items):
    best = {}
    for d, t in texts:
        w = words(t)
        for item, text in items:
            own = words(text)
            if not own or not w:
                continue
            size = min(len(own), len(w))
            a = bag(own)
            for s in range(len(w) - size + 1):
                b = bag(w[s : s + size])
                shared = sum((a & b).values())
                score = shared / (sum(a.values()) + sum(b.values()) - shared)
                if score >= D.SIMILARITY and score > best.get((d, item), 0):
                    best[d, item] = score
    return best


def documents():
    long = ITEMS[0][1]
    return [
        *[(d, t) for d, t in tricky_texts() if d is not None and d != 11],
        (20, "before " * 40 + long + " after" * 40),
        (21, "before " * 40 + long.upper() + " after" * 40),
        (22, long.replace("item5 ", "item five ") + " and more of it" * 5),
        (23, long[: len(long) // 2]),
        (24, "Tiny\nITEM"),
        (25, "a tiny item here"),
        (26, "again " * 200),
        (27, ("x y z " * 9 + long + " ") * 3),
        (28, long + " tail"),
    ]


def benchmark(spark):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id bigint, text string, start int, text_key string")


def test_same_pairs_as_all_windows(spark):
    got = D.contaminated(tricky_docs(spark, documents()), benchmark(spark)).collect()
    want = by_hand(documents(), ITEMS)
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    assert {20, 21, 27, 28} <= {d for d, i in want if i == 1} and 23 not in {d for d, _ in want}
    for r in got:
        assert abs(r.similarity - want[r.doc_id, r.item_id]) < 1e-9


def test_clean_documents_stay(spark):
    docs = tricky_docs(spark, documents())
    got = D.clean(docs, benchmark(spark))
    assert got.columns == docs.columns
    dirty = {d for d, _ in by_hand(documents(), ITEMS)}
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, _ in documents() if d not in dirty)


def test_repeated_rows_and_null_ids(spark):
    texts = [(None, ITEMS[0][1]), (1, ITEMS[0][1]), (1, ITEMS[0][1])]
    assert len(D.contaminated(tricky_docs(spark, texts), benchmark(spark)).collect()) == 3
    assert D.clean(tricky_docs(spark, texts), benchmark(spark)).count() == 0


def test_empty_tables(spark):
    assert D.contaminated(tricky_docs(spark, []), benchmark(spark)).collect() == []
    assert D.contaminated(tricky_docs(spark), benchmark(spark).limit(0)).collect() == []
    assert D.clean(tricky_docs(spark), benchmark(spark).limit(0)).count() == len(tricky_texts())


def test_blocks_meet_within_the_radius():
    masks = {m for m in range(256) if m.bit_count() <= D.BLOCK_RADIUS}
    import random

    rng = random.Random(0)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), D.RADIUS):
            b ^= 1 << bit
        assert any(((a >> 8 * k & 255) ^ (b >> 8 * k & 255)) in masks for k in range(8))


def test_no_python_runs_on_executors(spark, capsys):
    D.contaminated(tricky_docs(spark), benchmark(spark)).explain()
    assert "Python" not in capsys.readouterr().out


def test_reordered_items(spark):
    item = [f"w{i}" for i in range(60)]
    moved = [(30 + k, " ".join(["before"] * 90 + item[k:] + item[:k] + ["after"] * 90)) for k in (8, 10, 20, 30)]
    apart = [(50, " ".join(["before"] * 20 + item[:30] + ["between"] * 9 + item[30:] + ["after"] * 20))]
    items = [(1, " ".join(item)), (2, " ".join(item[::-1]))]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    docs = tricky_docs(spark, moved + apart)
    want = by_hand(moved + apart, items)
    assert set(want) == {(d, 1) for d, _ in moved}
    got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(docs, table).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {r.doc_id for r in D.clean(docs, table).collect()} == {50}


def test_starts_are_all_that_hold_enough(spark):
    import random

    rng = random.Random(1)
    rows = []
    for _ in range(300):
        n, length = rng.randint(1, 60), rng.randint(1, 40)
        places = range(max(1, n - 4))
        rows.append((sorted(p for p in places if rng.random() < rng.choice([0.5, 0.9, 1])) or [0], n, length))
    found = spark.createDataFrame(rows, "shared array<int>, n int, length int")
    for r in found.withColumn("starts", D.starts(found.shared, found.n, found.length)).collect():
        own, window = max(1, r.length - 4), max(1, min(r.length, r.n) - 4)
        counts = [sum(s <= p < s + window for p in r.shared) for s in range(max(r.n - r.length, 0) + 1)]
        want = [s for s, c in enumerate(counts) if c / (own + window - c) >= D.SIMILARITY - 1e-9]
        assert r.starts == want


def test_recall_of_fingerprints_near_the_bound(spark):
    """Items with as many changed words as the bound allows, and a few more: exact finds all, fingerprints nearly all."""
    import random

    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(40, 60)))) for i in range(6)]
    texts = []
    for d in range(120):
        own = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):  # a changed word costs up to five shingles on either side
            at = rng.randrange(len(own))
            own = rng.choice([own[:at] + [rng.choice(vocabulary)] + own[at + 1 :], own[:at] + own[at + 1 :], own[at:] + own[:at]])
        texts.append((d, " ".join(rng.choices(vocabulary, k=15) + own + rng.choices(vocabulary, k=15))))
    want = set(by_hand(texts, items))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    docs = tricky_docs(spark, texts)
    exact = {(r.doc_id, r.item_id) for r in D.contaminated(docs, table, exact=True).collect()}
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs, table).collect()}
    assert exact == want and 30 < len(want) < 110
    print(f"recall {len(found) / len(want):.3f} of {len(want)}")
    assert found <= want and len(found) >= 0.9 * len(want)
