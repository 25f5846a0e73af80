"""Tokens, n-grams and in-row term counts as built-in expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a run of two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


@lru_cache(maxsize=None)
def accent_table(limit: int = sys.maxunicode + 1) -> tuple[str, str]:
    """``translate`` arguments that strip accents, derived from Unicode data.

    Characters whose compatibility form without combining marks is a single
    character are mapped to it; the combining marks themselves are deleted.
    """
    source, target, deleted = [], [], []
    for code in range(0x80, limit):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if plain == char:
            continue
        if len(plain) == 1:
            source.append(char)
            target.append(plain)
        elif not plain:
            deleted.append(char)
    return "".join(source + deleted), "".join(target)


def fold_accents(text: Column) -> Column:
    return F.translate(text, *accent_table())


def normalise(text: Column, accents: bool = True) -> Column:
    raw = text.cast("string")
    lowered = F.lower(F.coalesce(raw, F.lit("")))
    if not accents:
        return lowered
    # Plain ASCII has no accents, and to look up each of its characters costs more than to find that out.
    return F.when(F.octet_length(raw) == F.char_length(raw), lowered).otherwise(fold_accents(lowered))


def tokens(text: Column, stop_words: tuple[str, ...] = (), accents: bool = True) -> Column:
    """Tokens of the whole text in order, stop words removed."""
    found = F.regexp_extract_all(normalise(text, accents), F.lit(TOKEN_PATTERN), F.lit(0))
    if not stop_words:
        return found
    return F.filter(found, lambda token: ~token.isin(*stop_words))


def ngrams(words: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens, joined by a blank."""
    if n == 1:
        return words
    length = F.greatest(F.size(words) - (n - 1), F.lit(0))
    joined = F.slice(words, 1, length)
    for k in range(1, n):
        joined = F.zip_with(joined, F.slice(words, k + 1, length), lambda a, b: F.concat(a, F.lit(" "), b))
    return joined


def ngram_range(words: Column, low: int, high: int) -> Column:
    parts = [ngrams(words, n) for n in range(low, high + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def run_starts(ordered: Column) -> Column:
    """Positions (from 0) where a new value starts in a sorted array.

    ``ordered`` must be a plain column: an expression would be evaluated once
    for every element.
    """
    positions = F.transform(ordered, lambda value, i: i)
    return F.filter(
        positions,
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def run_lengths(ordered: Column, starts: Column) -> Column:
    """``[(term, tf)]`` of a sorted array, given the starts of its runs."""
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(ordered)))
    return F.zip_with(
        starts,
        F.slice(ends, 1, F.size(starts)),
        lambda start, end: F.struct(F.get(ordered, start).alias("term"), (end - start).alias("tf")),
    )
