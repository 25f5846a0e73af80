"""Personal data in whole texts, found by expanding anchors.

One Aho-Corasick automaton passes over a text and reports anchors: at-signs,
plus signs, digits, schemes and identifier cues. From each anchor a local
parser walks to the boundaries and validates what it has found, so no pattern
is tried at places that hold no anchor. Four kinds are *base*: exactly the
matches, leftmost first and not overlapping within a kind, of

- ``email``: local part, at-sign, host of two labels or more (all ASCII)
- ``ip``: four groups of digits, each at most 255
- ``card``: 12 to 19 digits, single blanks or hyphens between them, with a right check digit
- ``phone``: a plus sign and 9 to 15 digits, with blanks, brackets, dots and hyphens

The parsers add: ``email`` with letters beyond ASCII or with ``(at)`` for the
sign, ``address`` (``mailto:``, ``tel:`` and ``sip:`` addresses, and web
addresses with a user part), and ``account`` (an identifier after a cue: an
IBAN with right check digits, or a token with six digits or more).

Places are code points, the end is exclusive. A null text is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tallycast.llm.batches import blocks, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"

SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "mailto:", "tel:", "sip:")
AT_SIGNS = ("(at)", "[at]", "{at}")
# Words that announce an identifier, in lower case.
CUES = (
    "iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte", "ssn", "social security",
    "passport", "customer id", "member id", "user id", "national id", "tax id",
)
# An identifier holds so many digits, and a host so many characters, at least or at most.
ID_DIGITS, LOCAL_LENGTH, HOST_LENGTH = 6, 64, 253

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9]++(?:\.[0-9]++){0,3}+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WIDE_LOCAL = re.compile(r"[\w.%+-]")
WIDE_HOST = re.compile(r"[\w-]++(?:\.[\w-]++)++")
SPELT_HOST = re.compile(r"[\w-]++(?:(?:\.|\s?[(\[{]dot[)\]}]\s?)[\w-]++)++", re.IGNORECASE)
LABEL = re.compile(r"(?!-)[\w-]{1,63}(?<!-)")
WEB = re.compile(r"([^\s/@:<>\"']++(?::[^\s/@<>\"']*+)?)@([\w.-]++)(?::[0-9]{1,5})?(?:[/?#][^\s<>\"']*+)?")
REST_OF_CUE = re.compile(r"(?:\s?(?:number|no|nr|num|code|id)\b\.?)?\s?[:#=]?\s?", re.IGNORECASE)
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}")
TOKEN = re.compile(r"[A-Za-z0-9]++(?:-[A-Za-z0-9]++)*+")

Span = tuple[int, int, int, bool]  # start, kind, end, base


@dataclass(frozen=True)
class Spec:
    """What counts as an anchor besides signs and digits, all in lower case."""

    schemes: tuple[str, ...] = SCHEMES
    at_signs: tuple[str, ...] = AT_SIGNS
    cues: tuple[str, ...] = CUES


@lru_cache(maxsize=4)
def automaton(spec: Spec):
    import ahocorasick

    found = ahocorasick.Automaton()
    anchors = {"@": "sign", "+": "plus"} | {str(d): "digit" for d in range(10)}
    for kind, words in (("scheme", spec.schemes), ("spelt", spec.at_signs), ("cue", spec.cues)):
        anchors |= dict.fromkeys(words, kind)
    for anchor, kind in anchors.items():
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """A-Z as a-z and nothing else, so that places stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def back(text: str, at: int, kind: re.Pattern, stop: int) -> int:
    """The start of the run of characters of a kind that ends before ``at``."""
    while at > stop and kind.match(text, at - 1):
        at -= 1
    return at


def passes_luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def passes_iban(value: str) -> bool:
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def is_host(labels: list[str]) -> bool:
    last = labels[-1]
    return len(labels) > 1 and len(".".join(labels)) <= HOST_LENGTH and all(map(LABEL.fullmatch, labels)) and len(last) > 1 and not any(map(str.isdigit, last))


def is_local(local: str) -> bool:
    return 0 < len(local) <= LOCAL_LENGTH and local[0] != "." and local[-1] != "." and ".." not in local


def wide_email(text: str, at: int, stop: int) -> tuple[int, int] | None:
    """An address around the sign at ``at`` that has letters beyond ASCII."""
    start = back(text, at, WIDE_LOCAL, stop)
    host = WIDE_HOST.match(text, at + 1)
    if host and is_local(text[start:at]) and is_host(host.group().split(".")) and not text[start : host.end()].isascii():
        return start, host.end()
    return None


def spelt_email(text: str, start: int, end: int) -> tuple[int, int] | None:
    """An address around a spelt-out sign at ``start`` to ``end``, with at most one blank on each side."""
    at = start - (text[start - 1 : start] == " ")
    first = back(text, at, WIDE_LOCAL, 0)
    host = SPELT_HOST.match(text, end + (text[end : end + 1] == " "))
    if host and is_local(text[first:at]) and is_host(re.split(r"\s?[(\[{]dot[)\]}]\s?|\.", host.group(), flags=re.IGNORECASE)):
        return first, host.end()
    return None


def address(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The address after the scheme at ``start`` to ``end``, if it names a person."""
    if start and (text[start - 1].isalnum() or text[start - 1] in "+-."):
        return None
    if text[end - 1] == "/" or text[start:end].lower() in ("mailto:", "sip:"):
        web = WEB.match(text, end)
        if web and is_host(web.group(2).rstrip(".").split(".")):
            return start, end + len(web.group().rstrip(".,;:!?)"))
        return None
    number = re.compile(r"\+?[0-9][0-9().-]*[0-9]").match(text, end)
    if number and 7 <= sum(map(str.isdigit, number.group())) <= 15:
        return start, number.end()
    return None


def account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The identifier after the cue at ``start`` to ``end``: an IBAN, or a token with enough digits."""
    if (start and text[start - 1].isalnum()) or text[end : end + 1].isalnum():
        return None
    first = REST_OF_CUE.match(text, end).end()
    iban = IBAN.match(text, first)
    if iban:
        # The longest start of the match that is an IBAN.
        for stop in range(iban.end(), first + 14, -1):
            if text[stop : stop + 1].isalnum() or text[stop - 1] == " ":
                continue
            if passes_iban(text[first:stop].replace(" ", "")):
                return first, stop
    token = TOKEN.match(text, first)
    if token and sum(c.isdigit() for c in token.group()) >= ID_DIGITS:
        return first, token.end()
    return None


def spans_of(text: str, spec: Spec = Spec()) -> list[Span]:
    """All spans of a text by start, kind and end; each once."""
    out: set[Span] = set()
    free = [0, 0, 0]  # up to where email, ip and card have been decided

    def add(kind: str, place: tuple[int, int] | None, base: bool = False) -> None:
        if place is not None:
            out.add((place[0], KINDS.index(kind), place[1], base))

    for last, (anchor, size) in automaton(spec).iter(lowered(text)):
        at, end = last + 1 - size, last + 1
        if anchor == "digit":
            if at >= free[1]:
                found = IP.match(text, at)
                free[1] = found.end()
                parts = found.group().split(".")
                if len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in parts)):
                    add("ip", found.span(), True)
            if at >= free[2] and (found := CARD.match(text, at)):
                free[2] = found.end()
                digits = found.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and passes_luhn(digits):
                    add("card", found.span(), True)
        elif anchor == "plus":
            found = PHONE.match(text, at)
            if found and 9 <= sum(c.isdigit() for c in found.group()) <= 15:
                add("phone", found.span(), True)
        elif anchor == "sign":
            stop = free[0]
            start, host = back(text, at, LOCAL, stop), HOST.match(text, at + 1)
            if host and start < at:
                free[0] = host.end()
                add("email", (start, host.end()), True)
            add("email", wide_email(text, at, stop))
        elif anchor == "spelt":
            add("email", spelt_email(text, at, end))
        elif anchor == "scheme":
            add("address", address(text, at, end))
        else:
            add("account", account(text, at, end))
    based = {s[:3] for s in out if s[3]}
    return sorted(s for s in out if s[3] or s[:3] not in based)


def spans_array(texts: Iterable[str], spec: Spec) -> pa.ListArray:
    """The spans of each text as an array of Spark's ``SPAN`` type."""
    found = [spans_of(t, spec) for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
    flat = [s for f in found for s in f]
    columns = [
        pa.array([KINDS[s[1]] for s in flat], pa.string()), pa.array([s[0] for s in flat], pa.int32()),
        pa.array([s[2] for s in flat], pa.int32()), pa.array([s[3] for s in flat], pa.bool_()),
    ]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["kind", "start", "end", "base"]))


def hidden(text: str, spec: Spec) -> str:
    """The text with every span as ``<KIND>``; of spans that overlap the first names them all."""
    out, done = [], 0
    for start, kind, end, _ in spans_of(text, spec):
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find(docs: DataFrame, text: str = "text", out: str = "spans", spec: Spec = Spec()) -> DataFrame:
    """``docs`` with all spans of each text in the column ``out``; rows and all other columns stay.

    Null and empty texts have no spans; repeated rows have each their own; a
    column that is called ``out`` already is replaced. Nothing is shuffled.
    """
    kept = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            spans = spans_array(texts_of(block, text).to_pylist(), spec)
            yield pa.RecordBatch.from_arrays([*block.columns, spans], [*block.schema.names, out])

    span = StructType.fromDDL("kind string, start int, end int, base boolean")
    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(out, ArrayType(span))]))


def redact(docs: DataFrame, text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind, as ``<EMAIL>``; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            place, field = block.schema.get_field_index(text), block.schema.field(text)
            clean = [None if t is None else hidden(t, spec) for t in block.column(text).to_pylist()]
            yield block.set_column(place, field, pa.array(clean, field.type))

    if not isinstance(docs.schema[text].dataType, StringType):
        raise TypeError(f"{text} is no column of texts")
    return docs.mapInArrow(run, docs.schema)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, key: str, spans: str = "spans") -> DataFrame:
    """Counts of the base kinds, a checksum of the base spans and a list of all spans."""
    base = F.filter(spans, lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    counts = [number(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(key, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col(spans)).alias("spans"))
