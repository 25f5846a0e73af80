import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import tricky_docs, tricky_texts
from tokenizers import Tokenizer

from tallycast.llm import packing

WORD = public_tokenizers.path("word_bpe_49k.json")


def fewest(lengths, capacity):
    """The optimum, by trying all ways to fill sequences."""
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[k]:
                i = rooms.index(room)
                place(k + 1, rooms[:i] + [room - lengths[k]] + rooms[i + 1 :])
        place(k + 1, rooms + [capacity - lengths[k]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


def sequences_of(plan):
    out, ranks = {}, Counter()
    for length, first, many, sequence, offset in plan.runs:
        for k in range(many):
            out.setdefault(sequence + k, []).append((offset, length))
            ranks[length, first + k] += 1
    assert all(n == 1 for n in ranks.values())
    return out


@pytest.mark.parametrize("seed", range(120))
def test_plan_is_valid_and_reduction_costs_nothing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 12, 20])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
    plan = packing.make_plan(Counter(lengths), capacity)
    found = sequences_of(plan)
    assert sorted(found) == list(range(plan.sequences))
    assert sorted(n for s in found.values() for _, n in s) == sorted(lengths)
    for own in found.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= capacity
    # What the reduction fixed is part of some best packing: the rest, packed best, reaches the optimum.
    reduced, stock = packing.Plan(capacity), packing._Stock(Counter(lengths))
    packing.reduce(stock, reduced)
    rest = list(itertools.chain(*[[n] * c for n, c in stock.left.items()]))
    assert reduced.sequences + fewest(rest, capacity) == fewest(lengths, capacity)


def test_lengths_out_of_range_are_refused():
    with pytest.raises(ValueError):
        packing.make_plan({9: 1}, 8)


def test_documents(spark):
    got = packing.pack(tricky_docs(spark), WORD, 0, 64, ids=True)
    rows = got.collect()
    tokenizer = Tokenizer.from_file(WORD)
    want = Counter()
    for d, t in tricky_texts():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 64)):
            own = ids[start : start + 64]
            want[d, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= 64
    assert len(by) <= -(-sum(r.length for r in rows) // 64) + 2
    joined = {r.sequence_id: r.ids for r in packing.sequences(got).collect()}
    assert joined == {s: b"".join(bytes(r.ids) for r in own) for s, own in by.items()}


def test_empty_table(spark):
    assert packing.pack(tricky_docs(spark, []), WORD, 0).collect() == []
