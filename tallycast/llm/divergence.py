"""How far each source of a language is from the others, by the frequent terms of the language.

Terms are letters in a row, A-Z lowered. Those in at least ``least`` documents
of a language are found by prefix refinement: the distinct documents of every
byte prefix are counted level by level, prefixes below the bound are given up
with all that starts with them, and only what is left is extended, until the
terms are complete.

Counts of distinct documents do not add up over terms: a document may hold two
terms with one prefix. So a task lets every document count, for each level,
only at the first of its terms with a prefix; these counts do add up, over
terms, blocks and tasks. A block of documents becomes one row for each language
and term, so a word that is everywhere is one row a block, and every sum is
combined before it is shuffled: no task holds all rows of a key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, texts_of
from tallycast.llm.terms import LETTERS, terms_of
from tallycast.operators.lookup import table_bytes
from tallycast.session import materialise

# Texts of so many bytes are counted together.
BLOCK_BYTES = 16 << 20
# Prefixes that are left are broadcast up to this size, and joined by a shuffle beyond.
BROADCAST_BYTES = 16 << 20
BILLION = 10**9
# The largest count for which all arithmetic on shares fits 64 bits.
SMALL = 9 * 10**9


@dataclass(frozen=True)
class Spec:
    """``levels``: lengths of prefixes in bytes, rising; ``least``: documents of a kept term; ``top``: ranks of part ``term``."""

    levels: tuple[int, ...] = (3, 6)
    least: int = 3
    top: int = 200


def count_block(block: pa.RecordBatch, levels: tuple[int, ...]) -> pa.RecordBatch:
    """A row for each language and term of a block: documents by level, and occurrences by source."""
    terms, offsets = terms_of(texts_of(block, "text"), LETTERS)
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    words = coded.dictionary.take(order)
    size = max(1, len(words))
    rank = np.empty(size, np.int64)
    rank[order.to_numpy()] = np.arange(len(words))
    docs = np.repeat(np.arange(block.num_rows), np.diff(offsets))
    key = np.sort(docs * size + rank[coded.indices.to_numpy()] if len(words) else docs)
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    doc, word = np.divmod(key[starts], size)
    times = np.diff(np.append(starts, len(key)))

    lang, source = (block.column(c).dictionary_encode() for c in ("lang", "source"))
    langs, sources = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (lang, source))
    many = max(1, len(source.dictionary))
    by_source = (langs[doc] * size + word) * many + sources[doc]
    order = np.argsort(by_source, kind="stable")
    by_source = by_source[order]
    source_starts = np.flatnonzero(np.diff(by_source, prepend=-1))
    held = by_source[source_starts] // many  # language and word of each source's count
    row_starts = np.flatnonzero(np.diff(held, prepend=-1))
    rows = held[row_starts]
    first_pairs = source_starts[row_starts]

    def summed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, at) if len(at) else np.zeros(0, np.int64)

    new_doc = np.diff(doc, prepend=-1) != 0
    columns = {"lang": lang.dictionary.take(pa.array(rows // size)), "term": words.cast(pa.string()).take(pa.array(rows % size))}
    for level in levels:
        prefix = pc.binary_slice(words.cast(pa.large_binary()), 0, level).dictionary_encode().indices.to_numpy()
        first = new_doc.copy()
        if len(doc):
            first[1:] |= prefix[word[1:]] != prefix[word[:-1]]
        columns[f"docs_{level}"] = pa.array(summed(first[order].astype(np.int64), first_pairs))
    columns["docs"] = pa.array(summed(np.ones(len(order), np.int64), first_pairs))
    ends = pa.array(np.append(row_starts, len(held)).astype(np.int32))
    names = source.dictionary.take(pa.array(by_source[source_starts] % many))
    columns["sources"] = pa.ListArray.from_arrays(ends, names)
    columns["counts"] = pa.ListArray.from_arrays(ends, pa.array(summed(times[order], source_starts)))
    return pa.RecordBatch.from_pydict(columns)


def block_counts(docs: DataFrame, spec: Spec) -> DataFrame:
    """The rows of ``count_block`` of all blocks, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            yield count_block(block, spec.levels)

    by_level = "".join(f"docs_{level} bigint, " for level in spec.levels)
    return materialise(docs.mapInArrow(run, f"lang string, term string, {by_level}docs bigint, sources array<string>, counts array<bigint>"))


def prefix_of(level: int) -> Column:
    return F.substring(F.col("term").cast("binary"), 1, level).alias("prefix")


def refined(rows: DataFrame, spec: Spec) -> DataFrame:
    """The rows whose prefixes of every level are in enough documents of the language."""
    alive = rows
    for level in spec.levels:
        counted = alive.groupBy("lang", prefix_of(level)).agg(F.sum(f"docs_{level}").alias("docs"))
        kept = materialise(counted.filter(F.col("docs") >= spec.least).select("lang", "prefix"))
        small = table_bytes(kept) <= BROADCAST_BYTES
        # A prefix that is left has only prefixes that are left: the newest level stands for all.
        wanted = F.broadcast(kept) if small else kept
        alive = rows.withColumn("prefix", prefix_of(level)).join(wanted, ["lang", "prefix"], "left_semi").drop("prefix")
    return alive


def kept_terms(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """``lang``, ``term``, its ``docs`` and occurrences ``c``, and ``members`` (source, c), of every frequent term.

    ``docs`` has ``text``, ``lang`` and ``source`` without nulls. The list of a
    term has an entry for each source of the language that holds it, no more.
    """
    alive = refined(block_counts(docs, spec), spec)
    pairs = F.arrays_zip("sources", "counts")
    # The documents of a row count once, with its first source.
    first = F.when(F.col("at") == 0, F.col("docs")).otherwise(0)
    each = alive.select("lang", "term", "docs", F.posexplode(pairs).alias("at", "pair"))
    by_source = each.groupBy("lang", "term", F.col("pair.sources").alias("source")).agg(F.sum("pair.counts").alias("c"), F.sum(first).alias("docs"))
    whole = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("c").alias("c"), F.collect_list(F.struct("source", "c")).alias("members")
    )
    return whole.filter(F.col("docs") >= spec.least)


def div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, size: Column) -> Column:
    """``1 + floor(10**9 * (count + 1) / (total + size))``, exactly."""
    wide = div(F.lit(BILLION).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)"), (total + size).cast("decimal(19,0)"))
    return 1 + F.when(count < SMALL, div(F.lit(BILLION) * F.least(count + 1, F.lit(SMALL)), total + size)).otherwise(wide)


def gap(p: Column, q: Column) -> Column:
    return div((p - q) * (p - q), q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", spec: Spec = Spec()) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: the gaps between sources, and the terms behind them.

    Part ``pair`` has every other source of the language, part ``term`` the
    ``top`` terms that the source uses more than its language. A null text,
    language or source is an empty one; a source without terms has its pairs.
    Repeated rows are documents of their own, equal values are ranked by the
    bytes of the item, other columns of ``docs`` do not matter, and no rows give
    no rows. Values are exact for up to a billion kept terms a language.
    """
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))]
    docs = docs.select(*plain)
    kept = materialise(kept_terms(docs, spec))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("lang_n"))
    each = kept.select("lang", "term", F.col("c").alias("lang_c"), F.inline("members"))
    # How often a source has terms of each count: all that the pairs need.
    counted = materialise(each.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("terms")))
    totals = counted.groupBy("lang", "source").agg(F.sum(F.col("c") * F.col("terms")).alias("n"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
    # The share of a term that the source does not have.
    none = F.when(F.col("v") > 0, share(F.lit(0).cast("bigint"), F.col("n"), F.col("v")))
    groups = materialise(groups.withColumn("p0", none))
    return pairs(kept, counted, groups).unionByName(top_terms(each, groups, spec.top))


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    placed = rows.withColumn("rank", F.row_number().over(order))
    return placed.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("bigint").alias("value"), "rank")


def top_terms(each: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms that a source uses more than its language, up to rank ``top``."""
    p, q = share(F.col("c"), F.col("n"), F.col("v")), share(F.col("lang_c"), F.col("lang_n"), F.col("v"))
    shares = each.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    valued = shares.filter("p > q").withColumn("value", gap(F.col("p"), F.col("q")))
    return ranked(valued, "term").filter(F.col("rank") <= top)


def pairs(kept: DataFrame, counted: DataFrame, groups: DataFrame) -> DataFrame:
    """The summed gaps of every two sources of a language, over all kept terms.

    A term that neither source has adds the gap of two fixed shares. So the sum
    over all terms is that gap for each, corrected by terms that one of the two
    has, and again by terms that both have. Terms are gathered by their counts
    first: shares are worked out once for each count, not for each term.
    """
    mine = groups.select("lang", "source", "n", "v", "p0")
    other = groups.select("lang", F.col("source").alias("item"), F.col("n").alias("item_n"), F.col("p0").alias("item_p0"))
    two = mine.join(other, "lang").filter("source <> item")
    base = gap(F.col("p0"), F.col("item_p0"))
    key = ["lang", "source", "item"]

    def corrected(rows: DataFrame, by: Column) -> DataFrame:
        return rows.groupBy(*key).agg(F.sum(by * F.col("terms")).alias("value"))

    p, item_p = share(F.col("c"), F.col("n"), F.col("v")), share(F.col("item_c"), F.col("item_n"), F.col("v"))
    has = two.join(counted, ["lang", "source"]).withColumn("p", p)
    item_has = two.join(counted.withColumnsRenamed({"source": "item", "c": "item_c"}), ["lang", "item"]).withColumn("item_p", item_p)
    # Two sources are counted together once, and serve both ways.
    each = kept.select("lang", F.sort_array("members").alias("members")).select("lang", "members", F.posexplode("members").alias("at", "one"))
    both = each.select("lang", "one", F.explode(F.slice("members", F.col("at") + 2, F.size("members"))).alias("other"))
    both = both.groupBy(
        "lang", F.col("one.source").alias("source"), F.col("other.source").alias("item"), F.col("one.c").alias("c"), F.col("other.c").alias("item_c")
    ).agg(F.count(F.lit(1)).alias("terms"))
    turned = F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("item_c").alias("c"), F.col("c").alias("item_c"))
    both = both.select("lang", "terms", F.inline(F.array(F.struct("source", "item", "c", "item_c"), turned)))
    both = two.join(both, key).withColumns({"p": p, "item_p": item_p})
    twice = gap(F.col("p"), F.col("item_p")) - gap(F.col("p"), F.col("item_p0")) - gap(F.col("p0"), F.col("item_p")) + base

    start = two.select(*key, F.coalesce(base * F.col("v"), F.lit(0)).alias("value"))
    parts = start.unionByName(corrected(has, gap(F.col("p"), F.col("item_p0")) - base))
    parts = parts.unionByName(corrected(item_has, gap(F.col("p0"), F.col("item_p")) - base)).unionByName(corrected(both, twice))
    return ranked(parts.groupBy(*key).agg(F.sum("value").alias("value")), "pair")
