"""Language identification by prediction by partial matching.

For every language a tree of byte contexts of up to ``ORDER`` bytes counts what
followed each. The code length of a byte is that of the longest context of the
language that was seen: -log2 of its share, or the escape and then the next
shorter context (escape method C, statistics frozen after learning). A text
belongs to the language whose statistics code the whole text in fewest bits.

Because the statistics are frozen, the code length depends only on the longest
kept context and the byte: it is tabulated once, and a text is scored by two
table look-ups a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, text_bytes, texts_of

ORDER = 3
UNKNOWN = "und"
# Learning takes about so many documents of each language, chosen by a hash of the id.
FIT_DOCS = 20_000
# A context is kept from so many occurrences.
MIN_CONTEXT = 8
# More bytes than this don't raise the confidence.
CONFIDENCE_BYTES = 32
BLOCK = 2 << 20

# Letters and bytes of longer characters stand for themselves; blanks, digits and marks are one symbol each.
SYMBOL = np.full(256, 2, np.int64)
SYMBOL[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
SYMBOL[48:58] = 1
SYMBOL[65:91] = SYMBOL[97:123] = np.arange(3, 29)
SYMBOL[128:] = np.arange(29, 157)
SYMBOLS = 157


@dataclass
class Model:
    """``symbol``: byte to symbol; ``state``: three symbols to the longest kept context of any language.

    ``row[language][context]``: the longest end of the context that occurs in
    the language; ``bits[language][row, symbol]``: its code lengths.
    """

    languages: list[str]
    symbol: np.ndarray
    state: np.ndarray
    row: list[np.ndarray]
    bits: list[np.ndarray]


def _contexts(symbols: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The symbols 1 .. ORDER places before each; before a text stand blanks (symbol 0)."""
    out = []
    sizes = np.diff(starts)
    for back in range(1, ORDER + 1):
        prior = np.zeros_like(symbols)
        prior[back:] = symbols[:-back]
        for k in range(back):
            prior[starts[:-1][sizes > k] + k] = 0
        out.append(prior)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each run of ORDER + 1 symbols by language, added up within the task."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in blocks(batches, "text", BLOCK):
        languages = batch.column("lang").to_numpy(zero_copy_only=False)
        for language in np.unique(languages.astype(str)):
            part = batch.filter(pa.array(languages == language))
            data, starts = text_bytes(texts_of(part, "text"))
            if not len(data):
                continue
            code = SYMBOL[data]
            symbols = code.copy()
            for back, prior in enumerate(_contexts(symbols, starts), 1):
                code = code + prior * SYMBOLS**back
            keys, counts = np.unique(code, return_counts=True)
            if language in sums:
                keys, place = np.unique(np.concatenate([sums[language][0], keys]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([sums[language][1], counts])).astype(np.int64)
            sums[language] = keys, counts
    for language, (keys, counts) in sums.items():
        yield pa.RecordBatch.from_pydict({"lang": [language] * len(keys), "code": keys, "n": counts})


def _costs(keys: list[np.ndarray], counts: list[np.ndarray], kept: list[np.ndarray], size: int) -> np.ndarray:
    """Bits of each symbol after each kept context, shortest contexts first.

    ``keys[k]``, ``counts[k]``: (k symbols of context, symbol) as one number, and
    occurrences in one language; ``kept[k]``: the kept contexts of k symbols.
    """
    shorter = np.full((1, size), np.log2(size))
    out = []
    for k, contexts in enumerate(kept):
        table = np.zeros((len(contexts), size))
        place = np.searchsorted(contexts, keys[k] // size)
        place = np.minimum(place, len(contexts) - 1)
        known = contexts[place] == keys[k] // size
        table[place[known], keys[k][known] % size] = counts[k][known]
        total, kinds = table.sum(1, keepdims=True), (table > 0).sum(1, keepdims=True)
        below = shorter if k == 0 else shorter[np.searchsorted(kept[k - 1], contexts % size ** (k - 1))]
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = -np.log2(table / (total + kinds))
            escaped = -np.log2(kinds / (total + kinds)) + below
        shorter = np.where(total == 0, below, np.where(table > 0, seen, escaped))
        out.append(shorter)
    return np.concatenate(out)


def fit(docs: DataFrame, *, fit_docs: int = FIT_DOCS) -> Model:
    """Learn from ``text`` and non-null ``lang``; without a usable row no language is learned.

    Learning takes about ``fit_docs`` rows of each language, by a hash of ``doc_id``.
    What reaches the driver is one count for each run of four symbols they hold.
    Every context that occurs ``MIN_CONTEXT`` times is kept, in each language it occurs in.
    """
    known = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.col("lang").cast("string"))
    known = known.filter("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], SYMBOL, np.zeros(0, np.int32), [], [])
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(""))), F.lit(1 << 30))
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(fit_docs / n))])
    drawn = known.filter(draw < share[F.col("lang")] * (1 << 30))
    counted = drawn.select("text", "lang").mapInArrow(_count, "lang string, code bigint, n bigint")
    rows = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    if not languages:
        return fit(docs.limit(0))

    # Renumber the symbols that occur; symbol 0 (blank) stays. Others share the last number.
    code = rows["code"].to_numpy()
    digits = [code // SYMBOLS**k % SYMBOLS for k in range(ORDER + 1)]  # symbol, then what stands before it
    used = np.union1d([0], np.unique(np.concatenate(digits)))
    size = len(used) + 1
    number = np.full(SYMBOLS, size - 1)
    number[used] = np.arange(len(used))
    digits = [number[d] for d in digits]
    weight = rows["n"].to_numpy()

    def joined(k: int) -> np.ndarray:
        return digits[0] + sum((digits[b] * size**b for b in range(1, k + 1)), np.int64(0))

    kept = [np.zeros(1, np.int64)]
    for k in range(1, ORDER + 1):
        contexts, place = np.unique(joined(k) // size, return_inverse=True)
        total = np.bincount(place, weight)
        enough = (total >= MIN_CONTEXT) & np.isin(contexts % size ** (k - 1), kept[k - 1])
        kept.append(contexts[enough])
    kept = [c for c in kept if len(c)]
    row, bits = [], []
    for language in languages:
        own = (rows["lang"] == language).to_numpy()
        keys, counts, occur, places = [], [], [], []
        for k in range(len(kept)):
            key, place = np.unique(joined(k)[own], return_inverse=True)
            keys.append(key)
            counts.append(np.bincount(place, weight[own]))
            here = np.isin(kept[k], key // size)
            before = sum(map(len, occur))
            occur.append(kept[k][here])
            ends = places[-1][np.searchsorted(kept[k - 1], kept[k] % size ** (k - 1))] if k else np.zeros(1, np.int32)
            places.append(np.where(here, before + np.cumsum(here) - 1, ends).astype(np.int32))
        row.append(np.concatenate(places))
        bits.append(_costs(keys, counts, [c for c in occur if len(c)], size).astype(np.float32))

    # Three symbols to the longest kept context that ends them.
    three = np.arange(size**ORDER)
    state = np.zeros(size**ORDER, np.int32)
    base = 1
    for k in range(1, len(kept)):
        context = three % size**k
        place = np.minimum(np.searchsorted(kept[k], context), len(kept[k]) - 1)
        state = np.where(kept[k][place] == context, base + place, state).astype(np.int32)
        base += len(kept[k])
    return Model(languages, number[SYMBOL], state, row, bits)


def code_lengths(model: Model, texts: pa.LargeStringArray) -> np.ndarray:
    """Bits of each whole text (rows) in each language (columns)."""
    data, starts = text_bytes(texts)
    out = np.zeros((len(texts), len(model.languages)))
    full = np.flatnonzero(np.diff(starts))
    if not len(full):
        return out
    size = model.bits[0].shape[1]
    symbols = model.symbol[data]
    code = np.zeros_like(symbols)
    for back, prior in enumerate(_contexts(symbols, starts)):
        code += prior * size**back
    context = model.state[code]
    for k in range(len(model.languages)):
        bits = model.bits[k].ravel()[model.row[k][context].astype(np.int64) * size + symbols]
        out[full, k] = np.add.reduceat(bits, starts[:-1][full], dtype=np.float64)
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1), from ``text`` alone; other columns stay.

    A null text and a text without letters are ``und`` with score 0, as is all
    if no language was learned. Ties go to the first language by name. Columns
    named like the new ones are replaced.
    """
    rows = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FIT_DOCS a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in blocks(batches, "text", BLOCK):
            texts = texts_of(batch, "text")
            letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
            names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if m.languages:
                bits = code_lengths(m, texts)
                more = bits - bits.min(1, keepdims=True)
                sizes = np.maximum(np.diff(text_bytes(texts)[1]), 1)[:, None]
                odds = np.exp2(-more * np.minimum(1, CONFIDENCE_BYTES / sizes))
                names[letters] = np.array(m.languages, object)[bits.argmin(1)][letters]
                score[letters] = (1 / odds.sum(1))[letters]
            columns = [pa.array(names, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")


def remainder(key: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(by))
