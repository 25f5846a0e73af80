"""Personal data: base spans against plain patterns, added spans on examples."""

import hashlib
import random
import re

import pytest

from helpers import tricky_docs, tricky_texts
from tallycast.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, found):
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_by_hand(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if valid(kind, m.group())]
    return [f"{list(PLAIN)[k]}:{s}:{e}" for s, k, e in sorted(found)]


def base_of(text):
    return [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e, base in pii.spans_of(text or "") if base]


EXAMPLES = [
    "a@b.c@d.e x@y x@y.z. .@.a @a.b a@-.-", "1.2.3.4.5.6.7.8 01.002.0003.255 1.2.3.256 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+1 (319) 555-5132 +12 +1234567890123456 ++1 2 3 4 5 6 7 8 9.", "日本 a.b+c@x-y.example.com, 10.0.0.1:80", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "0" * 4000 + ".1.1.1",
]


@pytest.mark.parametrize("text", EXAMPLES + [t for _, t in tricky_texts()])
def test_base_of_examples(text):
    assert base_of(text) == base_by_hand(text)


def test_base_of_random_texts():
    random.seed(11)
    for alphabet in ("1234 -.", "0125.", "+12 ().-a", "ab@.-é ", "a1@.+- 4(at)日"):
        for _ in range(3000):
            text = "".join(random.choices(alphabet, k=random.randint(0, 40)))
            assert base_of(text) == base_by_hand(text), text


@pytest.mark.parametrize(
    "text, added",
    [
        ("write to josé.ruiz@correo.es now", ["email:9:28"]),
        ("ana (at) example (dot) org or bob[at]host.net", ["email:0:26", "email:30:45"]),
        ("see http://user:pw@host.example.com/a?b. and http://host.example.com/", ["address:4:39"]),
        ("MAILTO:x@example.com tel:+1-319-555-5132 hotel:12345678", ["address:0:20", "address:21:40"]),
        ("IBAN: DE89 3704 0044 0532 0130 00 then", ["account:6:33"]),
        ("Account no. 12-345678, accountant 12345678, account 12", ["account:12:21"]),
        ("look at example.com and meet at (at) once", []),
    ],
)
def test_added(text, added):
    assert [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e, base in pii.spans_of(text) if not base] == added


def test_rows(spark):
    """Every row keeps its columns; null and empty texts, repeated rows and clashing names are fine."""
    texts = [*tricky_texts(), (20, EXAMPLES[3]), (20, EXAMPLES[3]), (21, EXAMPLES[4])]
    docs = tricky_docs(spark, texts).withColumnsRenamed({"class": "kind", "n": "base", "seq": "start"})
    found = pii.find(docs)
    assert found.columns == [*docs.columns, "spans"] and found.count() == len(texts)
    got = sorted(map(tuple, pii.digest(found, "doc_id").collect()), key=str)
    want = []
    for doc_id, text in texts:
        base = base_by_hand(text)
        counts = [sum(b.startswith(k) for b in base) for k in PLAIN]
        want.append((doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(base)))
    assert got == sorted(want, key=str)
    again = pii.find(found.withColumn("spans", found["doc_id"]))
    assert again.columns == found.columns
    empty = pii.find(docs.filter("doc_id < 0"))
    assert empty.columns == found.columns and empty.count() == 0


def test_redact(spark):
    docs = tricky_docs(spark, [(1, "call +1 (319) 555-5132 or a@b.cé, josé@correo.es"), (2, None), (3, "")])
    assert [r["text"] for r in pii.redact(docs).orderBy("doc_id").collect()] == ["call <PHONE> or <EMAIL>, <EMAIL>", None, ""]
