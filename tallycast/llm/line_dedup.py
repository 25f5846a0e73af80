"""Repeated runs of lines, by prefix doubling over line ids.

A text is the sequence of its lines that hold a word. Two neighbouring lines
that occur more than once form the start of a suffix that may occur again; all
other suffixes are settled at once. Prefix doubling ranks them: the rank of 2k
lines is that of the pair (rank of the first k, rank of the next k) in sorted
order. Ranks of 1, 2, 4, ... lines describe the suffix array down to the depth
that matters, and suffixes that share their first m lines, an interval of the
array with common prefixes of m lines or more, are those that agree in the rank
of the first and of the last 2**k of these m lines.

A run of lines repeats if it has at least ``min_words`` words and occurs
earlier, in order of document id and line. Every line in such a run goes, the
first copy stays. It is enough to look at the shortest runs with that many
words from each line on and up to each line: they cover every longer run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, text_bytes, texts_of
from tallycast.llm.keys import text_key, unused
from tallycast.llm.words import words_of
from tallycast.operators.lookup import BROADCAST_BYTES, table_bytes
from tallycast.session import materialise

MIN_WORDS = 50
BLOCK = 2 << 20
KEY = ["doc", "text_key"]
LINE = "doc bigint, text_key binary, i int, line int, h1 bigint, h2 bigint, words int, ahead int, back int"
# Stands for a null id in the order of documents: last.
LAST = (1 << 63) - 1


def _shortest(words: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines in the shortest run with enough words from each line on, and up to each line (0: there is none)."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(n)
    first = np.searchsorted(text, text, side="left")
    end = np.searchsorted(text, text, side="right")
    ahead = np.searchsorted(total, total[:-1] + least, side="left")
    back = np.searchsorted(total, total[1:] - least, side="right") - 1
    return np.where(ahead <= end, ahead - at, 0), np.where(back >= first, at + 1 - back, 0)


def _lines(min_words: int):
    """One row for each line with a word: its document, number, hash of its content and shortest runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK):
            texts = texts_of(batch, "text")
            data, offsets = text_bytes(texts)
            found = words_of(texts)
            if not len(found.starts):
                continue
            feeds = np.concatenate([[0], np.cumsum(data == 10)])
            text, feed = found.text, feeds[found.starts]
            head = np.append(True, (feed[1:] != feed[:-1]) | (text[1:] != text[:-1]))
            heads = np.flatnonzero(head)
            tails = np.append(heads[1:], len(head)) - 1
            starts, ends = found.starts[heads], found.starts[tails] + found.sizes[tails]
            text, words = text[heads], tails - heads + 1
            whole = memoryview(data)
            digests = b"".join(hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist()))
            halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
            ahead, back = _shortest(words, text, min_words)
            columns = {
                "doc": batch.column("doc").take(pa.array(text)),
                "text_key": batch.column("text_key").take(pa.array(text)),
                "i": np.arange(len(text)) - np.searchsorted(text, text, side="left"),
                "line": feed[heads] - feeds[offsets[text]],
                "h1": halves[:, 0].copy(), "h2": halves[:, 1].copy(), "words": words, "ahead": ahead, "back": back,
            }
            small = {c: pa.array(columns[c], pa.int32()) for c in ("i", "line", "words", "ahead", "back")}
            yield pa.RecordBatch.from_pydict(columns | small)

    return run


def _ranked(table: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` that occur more than once, with ``rank``: numbers in their sorted order."""
    twice = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    ordered = twice.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialise(ordered.withColumn("rank", F.monotonically_increasing_id()))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc``, ``text_key``, ``line``, ``i``, ``words``, ``first_doc``: every line that goes.

    ``line`` counts all lines of the text from 0, ``i`` those with a word;
    ``first_doc`` is the document of the first copy of a run it belongs to.
    """
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        text_key("text").alias("text_key"),
        F.col("text").cast("string"),
    )
    # Rows alike in id and text are one document.
    lines = source.mapInArrow(_lines(min_words), LINE)
    lines = materialise(lines)
    content = lines.select(*KEY, "i", "h1", "h2").distinct()
    level = content.join(_ranked(content, ["h1", "h2"]), ["h1", "h2"]).select(*KEY, "i", "rank")
    level = materialise(level)

    forward = lines.filter("ahead > 0").select(*KEY, F.col("i").alias("start"), F.col("ahead").alias("size"))
    backward = lines.filter("back > 0").select(*KEY, (F.col("i") - F.col("back") + 1).alias("start"), F.col("back").alias("size"))
    # A run of repeated lines only: its first and last line are.
    ends = level.select(*KEY, F.col("i").alias("start")), level.select(*KEY, F.col("i").alias("_last"))
    runs = forward.unionByName(backward).distinct().withColumn("_last", F.col("start") + F.col("size") - 1)
    runs = runs.join(ends[0], [*KEY, "start"]).join(ends[1], [*KEY, "_last"]).drop("_last")
    runs = materialise(runs.withColumn("k", F.floor(F.log2("size")).cast("int")))
    depth = runs.agg(F.max("k")).first()[0]

    copies = None
    for k in range(0 if depth is None else depth + 1):
        if k:
            half = 1 << (k - 1)
            after = level.select(*KEY, (F.col("i") - half).alias("i"), F.col("rank").alias("next"))
            pairs = materialise(level.withColumnRenamed("rank", "prior").join(after, [*KEY, "i"]))
            level = materialise(pairs.join(_ranked(pairs, ["prior", "next"]), ["prior", "next"]).select(*KEY, "i", "rank"))
        first = level.withColumnsRenamed({"i": "start", "rank": "head"})
        last = level.withColumnsRenamed({"i": "_i", "rank": "tail"})
        own = runs.filter(F.col("k") == k).withColumn("_i", F.col("start") + F.col("size") - (1 << k))
        own = own.join(first, [*KEY, "start"]).join(last, [*KEY, "_i"])
        copies = own if copies is None else copies.unionByName(own)
    if copies is None:
        return lines.limit(0).select(*KEY, "line", "i", "words", F.col("doc").alias("first_doc"))

    copies = materialise(copies.select(*KEY, "start", "size", "head", "tail"))
    interval = ["size", "head", "tail"]
    leader = copies.groupBy(*interval).agg(F.min(F.struct(*KEY, "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = copies.join(leader, interval).filter(F.struct(*KEY, "start") != F.col("first"))
    covered = later.select(*KEY, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("i"), F.col("first.doc").alias("first_doc"))
    covered = covered.groupBy(*KEY, "i").agg(F.min("first_doc").alias("first_doc"))
    return lines.select(*KEY, "line", "i", "words").distinct().join(covered, [*KEY, "i"])


def deleted_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The runs of lines that go: ``doc_id``, ``first_line``, ``last_line``, ``n_lines``, ``n_words``, ``first_doc_id``.

    Lines count from 0; ``n_lines`` those with a word; ``first_doc_id`` is the
    smallest id that holds a first copy. Rows that agree in id and text are one
    document and appear once; rows that share only the id are documents each,
    ordered by a hash of the text. A null id comes last in the order of
    documents. Null, empty and blank texts have no lines; lines are compared
    without the white space around them. Other columns play no part.
    """
    gone = repeated_lines(docs, min_words)
    # Neighbouring lines belong to one run: no more than the lines of one document meet.
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy("i"))
    runs = gone.withColumn("_run", F.col("i") - place).groupBy(*KEY, "_run")
    out = runs.agg(
        F.min("line").alias("first_line"),
        F.max("line").alias("last_line"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("words").alias("n_words"),
        F.min("first_doc").alias("first_doc_id"),
    )
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return out.select(known("doc").alias("doc_id"), "first_line", "last_line", "n_lines", "n_words", known("first_doc_id").alias("first_doc_id"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the lines that go; a document that has no line with a word left goes too.

    All columns stay, and ``n_chars`` follows the text where there is one.
    Documents that lose nothing are unchanged, empty ones included.
    """
    gone_, doc, key, own_doc, own_key = unused(docs, "_gone", "_doc", "_text_key", "_own_doc", "_own_key")
    gone = repeated_lines(docs, min_words).groupBy(*KEY).agg(F.collect_set("line").alias(gone_))
    gone = materialise(gone.withColumnsRenamed({"doc": doc, "text_key": key}))
    # Texts stay where they are while the lists of lines that go are small.
    if table_bytes(gone) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    keyed = docs.withColumns({own_doc: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)), own_key: text_key("text")})
    both = keyed.join(gone, (F.col(own_doc) == F.col(doc)) & (F.col(own_key) == F.col(key)), "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(gone_, i))
    whole = F.col(gone_).isNull()
    text = F.when(whole, F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = both.withColumn("text", text).filter(whole | F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")))
    return out.select(*docs.columns)
