"""Benchmark passages in documents, by fingerprints of item-sized windows.

All steps are DataFrame operations. A window of a text is as many words as a
benchmark item has; it is looked at if so many of its five-word shingles, at
any place and in any order, are those of items of its length as a window that
is similar enough to one of them must share with it. The
SimHash of its shingles (weighted by how often each occurs) is compared with
those of all items: fingerprints are cut into blocks, and the items are listed
under all block values within a few bits of theirs, so that by the pigeonhole
principle every pair within ``RADIUS`` bits meets. The pairs that do are
compared exactly by weighted Jaccard similarity of their shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.keys import text_key, unused
from tallycast.operators.lookup import BROADCAST_BYTES, row_bytes
from tallycast.session import materialise

WORDS = 5
SIMILARITY = 0.8
# 64 bits in eight blocks; items are listed under all values within two bits in a block.
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
# Eight blocks with three bits wrong each would be 24: up to 23, some block is within two.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
WHITE = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Lower-case words between white space; an empty array if there are none."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))


def shingle(tokens: Column, place: Column, size: int = WORDS) -> Column:
    """Hash of the shingle at a place; past the end, of the words there are."""
    return F.xxhash64(*[F.get(tokens, place + k) for k in range(size)])


def places(tokens: Column) -> Column:
    """Places of shingles: at least one, if there is a word."""
    return F.sequence(F.lit(0), F.greatest(F.size(tokens) - WORDS, F.lit(0)))


def simhash(shingles: Column) -> Column:
    """64 bits: bit b is set if more of the shingles have it than not."""
    bits = F.sequence(F.lit(0), F.lit(63))
    vote = lambda b: F.aggregate(shingles, F.lit(0), lambda s, x: s + F.getbit(x, b).cast("int") * 2 - 1)
    set_bit = lambda s, b: s.bitwiseOR(F.when(vote(b) > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), set_bit)


def block(fingerprint: Column, k: Column) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays: shared occurrences over all occurrences."""
    times = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    shared = F.aggregate(F.array_distinct(F.array_intersect(a, b)), F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))
    return shared / (F.size(a) + F.size(b) - shared)


def starts(shared: Column, n: Column, length: Column) -> Column:
    """All starts, each once, of windows that may be similar to an item of ``length`` words, in a text of ``n`` words.

    ``shared``: the sorted places of the text's shingles that any such item has.
    Similarity needs shared / (item + window - shared) >= SIMILARITY; the windows
    that hold ``need`` places, the first of them ``shared[j]``, start after ``shared[j - 1]``.
    """
    shingles = lambda size: F.greatest(size - WORDS + 1, F.lit(1))
    window = shingles(F.least(length, n))
    need = F.ceil(SIMILARITY / (1 + SIMILARITY) * (shingles(length) + window) - 1e-6).cast("int")
    last = F.greatest(n - length, F.lit(0))

    def first_is(j: Column) -> Column:
        low = F.greatest(F.get(shared, j + need - 1) - window + 1, F.coalesce(F.get(shared, j - 1), F.lit(-1)) + 1)
        high = F.least(F.get(shared, j), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    each = F.transform(F.sequence(F.lit(0), F.size(shared) - need), first_is)
    return F.when(F.size(shared) >= need, F.flatten(each)).otherwise(F.array().cast("array<int>"))


def _sized(table: DataFrame) -> DataFrame:
    """Marked for broadcast if its measured size is small; otherwise it is shuffled. ``table`` is read from disk or cheap."""
    lists = [F.size(F.coalesce(c, F.array().cast(t))) * 8 for c, t in table.dtypes if t.startswith("array")]
    size = table.agg(F.coalesce(F.sum(sum(lists, row_bytes(table))), F.lit(0))).first()[0]
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def matches(docs: DataFrame, benchmark: DataFrame, exact: bool = False) -> DataFrame:
    """``text_key``, ``item_id``, ``start``, ``n_words``, ``similarity``: the best window of each different text for each item.

    ``text_key`` is a 128-bit hash of the text; copies of a text are looked at once.
    ``start`` counts words from 0, the first of the best windows is named. A
    text shorter than an item is one window. Null and empty texts and items
    match nothing. Rows that share an ``item_id`` count as one item each, and
    the best of them is named. Other columns play no part.

    Fingerprints further apart than ``RADIUS`` bits are not compared, however
    similar their shingles are. With ``exact`` every window is compared with all
    items of its length instead, so that no match is lost.
    """
    items = benchmark.select(F.col("item_id").cast("bigint"), words(F.col("text").cast("string")).alias("w")).filter(F.size("w") > 0)
    items = items.withColumn("length", F.size("w")).withColumn("item_set", F.transform(places(F.col("w")), lambda i: shingle(F.col("w"), i)))
    items = items.withColumn("item_print", simhash(F.col("item_set"))).drop("w").distinct()
    items = materialise(items)
    known = materialise(items.select("length", F.explode("item_set").alias("shingle")).distinct())

    texts = docs.select(text_key("text").alias("text_key"), words(F.col("text").cast("string")).alias("w"))
    each = texts.filter(F.size("w") > 0).select("text_key", "w", F.size("w").alias("n"), F.explode(places(F.col("w"))).alias("place"))
    hits = each.select("text_key", "n", "place", shingle(F.col("w"), F.col("place")).alias("shingle")).join(_sized(known), "shingle")
    shared = hits.groupBy("text_key", "n", "length").agg(F.sort_array(F.collect_set("place")).alias("shared"))
    windows = shared.select("text_key", F.explode(starts(F.col("shared"), F.col("n"), F.col("length"))).alias("start"), F.least("length", "n").alias("n_words"), "length")
    windows = materialise(windows)
    lengths = windows
    windows = windows.select("text_key", "start", "n_words").distinct()

    found = windows.groupBy("text_key").agg(F.collect_list(F.struct("start", "n_words")).alias("windows"))
    found = materialise(found)
    whole = docs.select(text_key("text").alias("text_key"), F.col("text").cast("string"))
    whole = whole.join(_sized(found.select("text_key")), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    whole = whole.join(found, "text_key").select("text_key", "windows", words(F.col("text")).alias("w"))
    whole = whole.select("text_key", "windows", F.transform(places(F.col("w")), lambda i: shingle(F.col("w"), i)).alias("all"))
    cut = lambda v: F.struct(v["start"].alias("start"), v["n_words"].alias("n_words"), F.slice("all", v["start"] + 1, F.greatest(v["n_words"] - WORDS + 1, F.lit(1))).alias("window"))
    prints = whole.select("text_key", F.explode(F.transform("windows", cut)).alias("v")).select("text_key", "v.*")
    prints = materialise(prints.withColumn("print", simhash(F.col("window"))))

    masks = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= BLOCK_RADIUS]
    ks = F.explode(F.array(*map(F.lit, range(BLOCKS)))).alias("k")
    listed = items.select("item_id", "item_set", "item_print", ks)
    listed = listed.withColumn("mask", F.explode(F.array(*map(F.lit, masks))))
    listed = listed.select("item_id", "item_print", "k", block(F.col("item_print"), F.col("k")).bitwiseXOR(F.col("mask")).alias("value"))
    probes = prints.select("text_key", "start", "n_words", "print", ks).withColumn("value", block(F.col("print"), F.col("k")))
    met = probes.join(_sized(listed.distinct()), ["k", "value"])
    met = met.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    met = met.select("text_key", "start", "n_words", "item_id", "item_print").distinct()
    if exact:
        met = lengths.join(_sized(items.select("item_id", "item_print", "length")), "length").drop("length").distinct()
    pairs = met.join(prints.drop("print"), ["text_key", "start", "n_words"]).join(_sized(items.drop("length")), ["item_id", "item_print"])
    scored = pairs.withColumn("similarity", similarity(F.col("window"), F.col("item_set"))).filter(F.col("similarity") >= SIMILARITY)
    scored = scored.select("text_key", "item_id", "start", "n_words", "similarity")
    for size in sorted(r.length for r in items.select("length").filter(F.col("length") < WORDS).distinct().collect()):
        scored = scored.unionByName(_short(texts, items.filter(F.col("length") == size), size))
    best = F.max_by(F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start"), -F.col("n_words")))
    return scored.groupBy("text_key", "item_id").agg(best.alias("b")).select("text_key", "item_id", "b.*")


def _short(texts: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Matches of items of fewer words than a shingle: windows of the same words, which have one fingerprint."""
    wanted = items.select("item_id", F.get("item_set", F.lit(0)).alias("shingle")).distinct()
    each = texts.filter(F.size("w") >= size).select("text_key", "w", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("start"))
    met = each.select("text_key", "start", shingle(F.col("w"), F.col("start"), size).alias("shingle")).join(_sized(wanted), "shingle")
    return met.select("text_key", "item_id", "start", F.lit(size).alias("n_words"), F.lit(1.0).alias("similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame, exact: bool = False) -> DataFrame:
    """``doc_id``, ``item_id``, ``start``, ``n_words``, ``similarity`` for each document row and item that it holds.

    See :func:`matches`; every copy of a text has rows of its own, also under a null id.
    """
    found = materialise(matches(docs, benchmark, exact))
    keyed = docs.select(F.col("doc_id").cast("bigint"), text_key("text").alias("text_key"))
    return keyed.join(found, "text_key").drop("text_key")


def clean(docs: DataFrame, benchmark: DataFrame, exact: bool = False) -> DataFrame:
    """The documents that hold no item; all columns stay. Null and empty texts stay, and so does every row of a repeated one."""
    found = materialise(matches(docs, benchmark, exact).select("text_key").distinct())
    own, key = unused(docs, "_own_key", "_text_key")
    keyed = docs.withColumn(own, text_key("text"))
    return keyed.join(found.withColumnRenamed("text_key", key), F.col(own) == F.col(key), "left_anti").select(*docs.columns)
