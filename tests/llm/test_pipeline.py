"""Each stage of the pipeline against a plain version, on its predecessor's output."""

import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import linked_groups, shingle_sets, tricky_docs
from test_decontaminate import by_hand
from test_line_dedup import deleted, gone_by_hand
from tokenizers import Tokenizer

import corpus_pipeline as P
from tallycast.session import materialise


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        out.append(materialise(stage(spark, out[-1], sf_dir)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "packing"]
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_language_keeps_prose(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(after) == {d for d, t in before.items() if any(c.isalpha() for c in t or "")}
    assert all(after[d] == before[d] for d in after)


def test_lines(stages):
    before, after = texts(stages[1]), texts(stages[2])
    rows = sorted(before.items())
    gone = deleted(rows, gone_by_hand(rows, 50), 50)
    for d, t in rows:
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if ((d, t), i) not in gone)
        assert after.get(d) == (kept if kept.strip() or kept == t else None)
    assert {r.doc_id: r.n_chars for r in stages[2].collect()} == {d: len(t) for d, t in after.items()}


def test_near_duplicates(stages):
    before, after = texts(stages[2]), texts(stages[3])
    rows = sorted(before.items())
    groups = linked_groups(shingle_sets([t for _, t in rows], 5), 80, 100)
    assert sorted(after.items()) == [row for i, row in enumerate(rows) if groups[i] == i]


def test_decontamination(spark, sf_dir, stages):
    before, after = texts(stages[3]), texts(stages[4])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = {d for d, _ in by_hand(before.items(), items)}
    assert after == {d: t for d, t in before.items() if d not in dirty}


def test_packing(stages):
    tokenizer = Tokenizer.from_file(P.TOKENIZER)
    want = Counter()
    for d, t in texts(stages[4]).items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [P.END_ID]
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[d, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    rows = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    room = Counter()
    for r in rows:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 2048 and len(room) <= -(-sum(room.values()) // 2048) + 1


def test_odd_documents_pass_all_stages(spark, sf_dir):
    docs = tricky_docs(spark)
    for _, stage in P.STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    assert {r.doc_id for r in docs.collect()} == {1, 7, 8, 9, 10, 11, None}
    docs = tricky_docs(spark, [])
    for _, stage in P.STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    assert docs.count() == 0


def test_run_is_the_chain_of_stages(spark, sf_dir, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(P.run(spark, sf_dir).select(key).collect()) == Counter(stages[5].select(key).collect())


def test_documents_in_many_languages_stay(spark, sf_dir):
    first = "bad cafe head deaf cab bag face "
    learned = {k: "".join(chr(ord(c) + 8 * i) if c != " " else c for c in first) for i, k in enumerate(["aa", "bb", "cc"])}
    rows = [(i, learned[k] * 5, k) for i, k in enumerate(["aa", "bb", "cc"] * 20)]
    mixed = [(100, (learned["aa"] + learned["bb"]) * 40, None), (101, "".join(t * 40 for t in learned.values()), None)]
    docs = spark.createDataFrame([*rows, *mixed, (102, "12 34 !?", None)], "doc_id bigint, text string, lang string")
    scores = {r.doc_id: r.score for r in P.language.predict(docs, P.language.fit(docs)).collect()}
    assert scores[101] < 0.5  # no language is likelier than the others together
    assert {r.doc_id for r in P.identify_language(spark, docs, sf_dir).collect()} == {*range(60), 100, 101}
