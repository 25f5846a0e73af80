import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from helpers import tricky_docs, tricky_texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallycast.llm import token_codes
from tallycast.llm.tokens import Encoder
from tallycast.session import scratch_path

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))

ENCODERS = {p: Encoder(p) for p in (BYTE, WORD)}


def plain(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_round_trip_and_random_access(ids):
    codes = token_codes.pack(np.array(ids, np.uint32))
    assert token_codes.unpack(codes).tolist() == ids
    places = np.arange(len(ids))[::-1]
    assert token_codes.ids_at(codes, places).tolist() == ids[::-1]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_strings_of_added_tokens(path):
    """They have ids of their own, wherever they stand and however they are written."""
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|"]
    texts = [f"hi {m} x" for m in marks] + [f"a{m}{m}b. {m}" for m in marks] + ["plain text.", "", "plain, text"]
    ids, sizes = Encoder(path).encode(pa.array(texts, pa.large_string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == plain(path, texts)
    assert plain(path, ["<|endoftext|>"])[0] in ([50256], [49407])


def test_common_words_are_kept():
    texts = pa.array([f"one two three w{i} v{i}" for i in range(3000)], pa.large_string())
    encoder = Encoder(BYTE)
    want = encoder.encode(texts)
    encoder.forget(50)
    assert len(encoder._places) == 50 and encoder._places.keys() >= {"one", " two", " three"}
    again = encoder.encode(texts)
    assert all((a == b).all() for a, b in zip(want, again))


@pytest.mark.parametrize("path", [BYTE, WORD])
@given(texts=st.lists(st.text(alphabet="aBé .,!\n\t~\x01 'sΣ日1", max_size=40), min_size=1, max_size=8))
@settings(max_examples=80, deadline=None)
def test_pieces_are_encoded_like_whole_texts(path, texts):
    ids, sizes = ENCODERS[path].encode(pa.array(texts, pa.large_string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == plain(path, texts)


def test_documents_come_back(spark):
    path = scratch_path(spark, "codes-test")
    token_codes.write_codes(tricky_docs(spark), path, BYTE, 2, segment_tokens=500)
    got = token_codes.read_documents(spark, path).orderBy("start").collect()
    ids = {t: x + [2] for (_, t), x in zip(tricky_texts(), plain(BYTE, [t for _, t in tricky_texts()]))}
    assert [r.doc_id for r in got] == sorted((d for d, _ in tricky_texts()), key=lambda d: (d is not None, d))
    start, every = 0, []
    for r in got:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert own in [ids[t] for d, t in tricky_texts() if d == r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(r.ids))
        start, every = start + len(own), every + own
    wanted = spark.createDataFrame([(p,) for p in (0, 1, 7, len(every) // 2, len(every) - 1, len(every), -1, None)], "position bigint")
    at = {r.position: r.id for r in token_codes.read_at(spark, path, wanted, together=3).collect()}
    assert at == {p: every[p] for p in (0, 1, 7, len(every) // 2, len(every) - 1)}


def test_empty_table(spark):
    path = scratch_path(spark, "codes-test")
    token_codes.write_codes(tricky_docs(spark, []), path, BYTE, 2)
    assert token_codes.read_documents(spark, path).collect() == []
