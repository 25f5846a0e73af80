"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Shingles have one order for all documents: those seen often last, before them
by how often their words let expect them, then by hash. A prefix thus holds the
rarest shingles, which few documents share by chance.
Two sets that are similar enough share at least one of their first p shingles,
and at least L of their first p + L - 1. Each document chooses its own L: the
cost of a longer prefix is weighed against the candidates it saves, estimated
from how often the common shingles occur. A pair has to share as many as the
smaller of its two L asks for; then its whole sets are compared.

Documents with equal sets are one class from the start. Classes that share a
prefix shingle are compared with one class of that list first, so that a group
of near copies is joined by a number of comparisons that grows with its size,
not the square. Only pairs that are not connected yet, and that the distances
to that class (Jaccard distance is a metric) do not rule out, are then listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, ranges, texts_of
from tallycast.llm.components import components
from tallycast.llm.keys import text_key, unused
from tallycast.llm.words import shingles_of, words_of
from tallycast.operators.lookup import BROADCAST_BYTES, table_bytes
from tallycast.session import materialise

BLOCK = 2 << 20
# A task reports shingles that it sees so often; they are common from COMMON in all.
REPORTED, COMMON = 4, 16
# So many of the most common shingles and words decide the order. It changes the cost only.
MOST_COMMON = 200_000
LONGEST_EXTENSION = 8
# What comparing two sets costs, in units of reading one entry of a list.
COMPARISON = 16
SALTS = 64
# A sketch counts the shingles of a set by so many ranges of their hashes.
SKETCH = 256


@dataclass(frozen=True)
class Spec:
    """Sets link from ``part / whole`` on: whole * intersection >= part * union."""

    words: int = 3
    part: int = 90
    whole: int = 100

    def overlap(self, n: int) -> int:
        """What a set of n shingles shares with any set it links with."""
        return -(-self.part * n // self.whole)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, int | None]]:
    """Row, sorted distinct shingles and class of each text; the class of an empty set is None."""
    hashes, offsets = shingles_of(words_of(texts_of(batch, "text")), size)
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        s = np.sort(hashes[a:b])
        if len(s) > 1:
            s = s[np.append(True, s[1:] != s[:-1])]
        yield row, s, _class(s) if len(s) else None


class _Tally:
    """Counts of 64-bit values that are seen more than once in a block."""

    def __init__(self) -> None:
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        v, c = np.unique(values, return_counts=True)
        v, place = np.unique(np.concatenate([self.values, v[c > 1]]), return_inverse=True)
        self.values, self.counts = v, np.bincount(place, np.concatenate([self.counts, c[c > 1]])).astype(np.int64)

    def rows(self, kind: str) -> pa.RecordBatch:
        often = self.counts >= REPORTED
        none = pa.nulls(int(often.sum()), pa.int64())
        found = [pa.array(self.values[often].view(np.int64)), pa.array(self.counts[often])]
        blank = pa.nulls(len(none), pa.binary())
        return pa.RecordBatch.from_arrays([none, blank, none, none, blank, pa.array([kind] * len(none), pa.string()), *found], NAMES)


def _sketch(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each of ``SKETCH`` ranges, at most 255."""
    return np.minimum(np.bincount((shingles >> np.uint64(56)).astype(int), minlength=SKETCH), 255).astype(np.uint8).tobytes()


def _class(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


ROWS = "doc_id bigint, text_key binary, n bigint, class bigint, sketch binary, kind string, value bigint, seen bigint"
NAMES = ["doc_id", "text_key", "n", "class", "sketch", "kind", "value", "seen"]


def _rows(size: int):
    """One row per document, and how often the task has seen each word and each shingle (once per class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: set[int] = set()
        shingles, single = _Tally(), _Tally()
        for batch in blocks(batches, "text", BLOCK):
            n, names, fresh, sketches = np.zeros(batch.num_rows, np.int64), [], [], [None] * batch.num_rows
            for row, s, name in _sets(batch, size):
                n[row] = len(s)
                names.append(name)
                if name is not None and name not in classes:
                    classes.add(name)
                    fresh.append(s)
                    sketches[row] = _sketch(s)
            none = pa.nulls(batch.num_rows, pa.int64())
            own = [batch.column("doc_id"), batch.column("text_key"), pa.array(n), pa.array(names, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*own, pa.nulls(batch.num_rows, pa.string()), none, none], NAMES)
            if fresh:
                shingles.add(np.concatenate(fresh))
                single.add(words_of(texts_of(batch, "text")).hashes)
        yield shingles.rows("shingle")
        yield single.rows("word")

    return run


@dataclass
class Order:
    """Sorted values and counts of the most common shingles and words."""

    shingles: tuple[np.ndarray, np.ndarray]
    words: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def counts(known: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> np.ndarray:
        """How often each value was seen, 0 if that isn't known."""
        if not len(known[0]):
            return np.zeros(len(values), np.int64)
        place = np.minimum(np.searchsorted(known[0], values), len(known[0]) - 1)
        return np.where(known[0][place] == values, known[1][place], 0)


def extension(seen: np.ndarray, first: int, most: int) -> int:
    """The L of least estimated cost; ``seen`` has the counts of the prefix shingles in order."""
    total = np.cumsum(seen)
    choices = np.arange(1, min(most, LONGEST_EXTENSION, len(seen) - first + 1) + 1)
    lists = total[first + choices - 2]
    return int(choices[np.argmin(lists + COMPARISON * lists / choices + choices)])


def _postings(spec: Spec, order: Order):
    """The prefix entries of each class, once in a task: shingle, class, size, place, L, share of common shingles, salt."""
    names = ["shingle", "class", "n", "place", "need", "pop", "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in blocks(batches, "text", BLOCK):
            found = words_of(texts_of(batch, "text"))
            hashes, offsets = shingles_of(found, spec.words)
            # Twice the log2 of what the counts of a shingle's words let expect, at most 255.
            likely = np.round(2 * np.log2(Order.counts(order.words, found.hashes) + 1)).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(likely)])
            first = ranges(found.offsets[:-1], np.diff(offsets))
            expected = total[np.minimum(first + spec.words, np.repeat(found.offsets[1:], np.diff(offsets)))] - total[first]
            expected = np.minimum(expected * 3 // spec.words, 255).astype(np.uint64)
            seen = Order.counts(order.shingles, hashes)
            often = np.minimum(np.round(4 * np.log2(seen + 1)), 127).astype(np.uint64)
            keys = often << np.uint64(57) | expected << np.uint64(49) | hashes >> np.uint64(15)
            out: list[tuple] = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                if a == b:
                    continue
                s, at = np.unique(hashes[a:b], return_index=True)
                name = _class(s)
                if name in done:
                    continue
                done.add(name)
                n, overlap = len(s), spec.overlap(len(s))
                least = n - overlap + 1
                pop = 1000 * int(np.count_nonzero(seen[a:b][at])) // n
                at = at[np.argsort(keys[a:b][at], kind="stable")][: least + LONGEST_EXTENSION - 1] + a
                known = seen[at]
                need = extension(known, least, overlap) if known.any() else 1
                at, known = at[: least + need - 1], known[: least + need - 1]
                k = len(at)
                salt = np.where(known > 0, 1 + name % SALTS, 0)
                out.append((hashes[at].view(np.int64), np.full(k, name), np.full(k, n), np.arange(k), np.full(k, need), np.full(k, pop), salt))
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                types = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


LISTED = ["shingle", "class", "n", "place", "need", "pop"]
LIST_DDL = "shingle bigint, class bigint, n int, place int, need int, pop int"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by shingle and class: one for each pair of them, if the shingle has several classes or is common."""
    held = None
    for batch in batches:
        both = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        shingle, name, salt = (both.column(c).to_numpy() for c in ("shingle", "class", "salt"))
        new = np.append(True, (shingle[1:] != shingle[:-1]) | (name[1:] != name[:-1]))
        both = both.filter(pa.array(new))
        shingle, salt = shingle[new], salt[new]
        # The last entry waits: its neighbour may come with the next batch. What stands before it is noted in salt.
        same = np.append(False, shingle[1:] == shingle[:-1])
        keep = same | np.append(same[1:], False) | (salt != 0)
        last = len(shingle) - 1
        held = both.slice(last, 1).to_batches()[0]
        if keep[last]:
            held = held.set_column(held.schema.get_field_index("salt"), "salt", pa.array([max(1, int(salt[last]))], pa.int32()))
        keep[last] = False
        yield from both.filter(pa.array(keep)).select(LISTED).to_batches()
    if held is not None and held.column("salt")[0].as_py():
        yield held.select(LISTED)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = []
        for x, y in zip(batch.column("_set_a").to_pylist(), batch.column("_set_b").to_pylist()):
            merged = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            merged.sort(kind="stable")
            shared.append(int(np.count_nonzero(merged[1:] == merged[:-1])))
        sizes = [np.array([len(v) // 8 for v in batch.column(c).to_pylist()], np.int64) for c in ("_set_a", "_set_b")]
        shared = np.array(shared, np.int64)
        yield pa.RecordBatch.from_pydict(
            {"a": batch.column("a"), "b": batch.column("b"), "shared": shared, "total": sizes[0] + sizes[1] - shared}
        )


def _sets_of(docs: DataFrame, spec: Spec, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class`` and ``set`` (sorted hashes as bytes) of the wanted classes."""
    one = rows.join(wanted, "class").groupBy("class").agg(F.min("text_key").alias("text_key"))
    one = materialise(one)
    small = table_bytes(one) <= BROADCAST_BYTES
    texts = docs.join(F.broadcast(one) if small else one, "text_key").select("class", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK):
            names, sets = batch.column("class").to_pylist(), []
            for row, s, name in _sets(batch, spec.words):
                sets.append(s.tobytes() if name == names[row] else None)
            yield pa.RecordBatch.from_pydict({"class": pa.array(names, pa.int64()), "set": pa.array(sets, pa.binary())})

    found = texts.mapInArrow(run, "class bigint, set binary").filter("set is not null")
    return materialise(found.groupBy("class").agg(F.first("set").alias("set")))


def _possible(spec: Spec):
    """Leaves out pairs whose sketches prove that too little is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH).astype(np.int64)
                for c in ("_sketch_a", "_sketch_b")
            )
            most = np.minimum(a, b).sum(1)
            may = spec.whole * most >= spec.part * (a.sum(1) + b.sum(1) - most)
            may |= (a == 255).any(1) | (b == 255).any(1)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(may)], ["a", "b", "may"])

    return run


def _verify(pairs: DataFrame, docs: DataFrame, spec: Spec, rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """``shared`` and ``total`` of the sets of each pair (``a`` < ``b``); null where the sketches rule a link out.

    A sketch bounds from above what two sets share, so no link is lost, and
    only sets that the sketches leave are made and moved.
    """
    ends = [sketches.select(F.col("class").alias(c), F.col("sketch").alias(f"_sketch_{c}")) for c in "ab"]
    both = pairs.select("a", "b").join(ends[0], "a").join(ends[1], "b")
    pairs = materialise(both.mapInArrow(_possible(spec), "a bigint, b bigint, may boolean"))
    left = pairs.filter("may").select("a", "b")
    wanted = left.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = _sets_of(docs, spec, rows, wanted)
    first = sets.select(F.col("class").alias("a"), F.col("set").alias("_set_a"))
    second = sets.select(F.col("class").alias("b"), F.col("set").alias("_set_b"))
    compared = left.join(first, "a").join(second, "b").mapInArrow(_compared, "a bigint, b bigint, shared bigint, total bigint")
    none = F.lit(None).cast("bigint")
    return materialise(compared).unionByName(pairs.filter("not may").select("a", "b", none.alias("shared"), none.alias("total")))


def classes(docs: DataFrame, spec: Spec = Spec()) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets, and links between them.

    First table: one row per document with ``doc_id``, ``n`` (size of its set)
    and ``class`` (null without words). Second: ``a``, ``b``, ``shared``,
    ``total`` of verified links, enough of them to connect all that is connected.
    """
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    source = source.withColumn("text_key", text_key("text"))
    seen = materialise(source.mapInArrow(_rows(spec.words), ROWS))
    rows = seen.filter("seen is null").select("doc_id", "text_key", "n", "class")
    # Several tasks may have met a class; their sketches are equal.
    sketches = seen.filter("sketch is not null").groupBy("class").agg(F.min("sketch").alias("sketch"))
    sketches = materialise(sketches)
    counts = seen.filter("seen is not null").groupBy("kind", "value").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= COMMON)

    def most_common(kind: str) -> tuple[np.ndarray, np.ndarray]:
        # At most MOST_COMMON rows reach the driver; they decide the order only.
        top = counts.filter(F.col("kind") == kind).orderBy(F.desc("seen"), "value").limit(MOST_COMMON).toPandas()
        values, often = top["value"].to_numpy(np.int64).view(np.uint64), top["seen"].to_numpy(np.int64)
        return values[np.argsort(values)], often[np.argsort(values)]

    order = Order(most_common("shingle"), most_common("word"))
    entries = source.select("text").mapInArrow(_postings(spec, order), LIST_DDL + ", salt int")
    spread = entries.repartition("shingle", "salt").sortWithinPartitions("shingle", "class")
    lists = materialise(spread.mapInArrow(_shared, LIST_DDL))
    lists = materialise(lists.join(_ends(lists, "n").select("shingle"), "shingle", "left_semi"))
    # Nothing that stands before a class's first shared entry is shared: at most n - first shingles are.
    firsts = lists.groupBy("class").agg(F.min("place").alias("first"))
    lists = lists.join(firsts, "class")
    lists = materialise(lists.join(_ends(lists, "n", "first"), "shingle"))
    texts = source.select("text_key", "text")
    linked = F.col("shared") * spec.whole >= F.col("total") * spec.part

    def fits(n: str, first: str, m: str, other: str) -> Column:
        """Sets of these sizes can be similar enough, by what they can share."""
        most = F.least(F.col(n) - F.col(first), F.col(m) - F.col(other))
        return most * (spec.whole + spec.part) >= (F.col(n) + F.col(m)) * spec.part

    def against(head: str, entries: DataFrame) -> DataFrame:
        other = F.col(f"{head}.class")
        pair = F.least("class", other).alias("a"), F.greatest("class", other).alias("b")
        return entries.filter((F.col("class") != other) & fits("n", "first", f"{head}.n", f"{head}.first")).select(*pair).distinct()

    def unconnected(entries: DataFrame) -> DataFrame:
        roots = entries.groupBy("shingle").agg(F.min("root").alias("_r"), F.max("root").alias("_s"))
        return entries.join(roots.filter("_r <> _s").select("shingle"), "shingle", "left_semi")

    tested = _verify(against("low", lists), texts, spec, rows, sketches)
    lists = _rooted(lists, components(tested.filter(linked)))
    # The other end of each list that is not connected yet.
    more = against("high", unconnected(lists)).join(tested, ["a", "b"], "left_anti")
    tested = tested.unionByName(_verify(more, texts, spec, rows, sketches))
    lists = _rooted(lists.drop("root"), components(tested.filter(linked)))
    # Distance to the low end of the list, where an entry has been compared with it.
    far = tested.select("a", "b", (1 - F.col("shared") / F.col("total")).alias("far"))
    low = F.col("low.class")
    left = unconnected(lists).withColumns({"a": F.least("class", low), "b": F.greatest("class", low)}).join(far, ["a", "b"], "left")
    left = left.withColumn("far", F.when(F.col("class") == low, 0.0).otherwise(F.col("far")))
    left = materialise(left.select("shingle", "class", "n", "place", "need", "root", "far"))
    names = {"class": "other", "n": "m", "place": "at", "need": "ask", "root": "end", "far": "away"}
    other = left.select("shingle", *[F.col(c).alias(d) for c, d in names.items()])
    ask = F.least("need", "ask")

    def limit(n: str) -> Column:
        """The length of the prefix that belongs to the smaller L."""
        return F.col(n) - F.ceil(F.col(n) * spec.part / spec.whole) + ask

    apart = F.coalesce(F.abs(F.col("far") - F.col("away")), F.lit(0.0))
    near = apart <= 1 - spec.part / spec.whole + 1e-9
    reached = (F.col("place") < limit("n")) & (F.col("at") < limit("m"))
    # Two sets share nothing before their first shared shingle, so a pair is listed
    # only by a shingle from which on both are still long enough.
    met = left.join(other, "shingle").filter((F.col("class") < F.col("other")) & (F.col("root") != F.col("end")) & near & reached & fits("n", "place", "m", "at"))
    met = met.select(F.col("class").alias("a"), F.col("other").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
    # Such a pair has to share as many entries of its prefixes as the smaller L asks for.
    prefix = left.groupBy("class").agg(F.first("n").alias("n"), F.first("need").alias("need"), F.collect_list(F.struct("shingle", "place")).alias("entries"))
    ends = prefix.toDF("a", "n", "need", "entries"), prefix.toDF("b", "m", "ask", "others")
    shingles = lambda entries, n: F.transform(F.filter(entries, lambda e: e["place"] < limit(n)), lambda e: e["shingle"])
    pairs = met.join(ends[0], "a").join(ends[1], "b").filter(F.size(F.array_intersect(shingles("entries", "n"), shingles("others", "m"))) >= ask)
    pairs = pairs.select("a", "b")
    return rows, tested.unionByName(_verify(pairs, texts, spec, rows, sketches)).filter(linked)


def _ends(lists: DataFrame, *columns: str) -> DataFrame:
    """Two classes of each list that has more than one: that with most common shingles, and the highest.

    Of copies that were changed in different places, the text that they come
    from has most shingles in common with all others.
    """
    low, high = F.max(F.struct("pop", "class", *columns)), F.max(F.struct("class", *columns))
    several = F.min("class") < F.max("class")
    ends = lists.groupBy("shingle").agg(low.alias("low"), high.alias("high"), several.alias("_several"))
    return ends.filter("_several").drop("_several")


def _rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
    found = lists.join(roots.withColumnRenamed("node", "class"), "class", "left")
    return materialise(found.withColumn("root", F.coalesce("root", "class")))


def groups(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links) of every document.

    A set has the distinct shingles of ``spec.words`` words; a shorter text is
    one shingle, and a text that is null or has no words has none and is linked
    with nothing. Rows that share an id are documents each; null ids are kept,
    and an id that is null is never the smallest unless the group has no other.
    An empty table gives no rows. Other columns play no part.
    """
    rows, links = classes(docs, spec)
    roots = components(links).withColumnRenamed("node", "class")
    rooted = rows.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = rooted.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("_least"))
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("_least"))
    return rooted.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, then the smallest hash of the text.

    Documents without words all stay. Of rows alike in id and text one stays. All columns stay.
    """
    rows, links = classes(docs, spec)
    rows = rows.filter("class is not null")
    roots = components(links).withColumnRenamed("node", "class")
    rooted = rows.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    # A null id comes after all others.
    mark = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    rooted = rooted.select("root", mark.alias("mark"))
    first = rooted.groupBy("root").agg(F.min("mark").alias("first"))
    seen = rooted.join(first, "root").groupBy("mark").agg((F.first("mark") == F.first("first")).alias("stays"), F.count(F.lit(1)).alias("n"))
    # Those that go, and those of which more than one row would stay.
    special = materialise(seen.filter("not stays or n > 1").select("mark.none", "mark.doc_id", "mark.text_key", "stays"))
    key, id_, key_, none, stays = unused(docs, "_text_key", "_id", "_key", "_none", "_stays")
    special = special.withColumnsRenamed({"doc_id": id_, "text_key": key_, "none": none, "stays": stays})
    if table_bytes(special) <= BROADCAST_BYTES:
        special = F.broadcast(special)
    keyed = docs.withColumn(key, text_key("text"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(key_))
    marked = keyed.join(special, same, "left")
    alone = marked.filter(F.col(stays).isNull()).select(*docs.columns)
    repeated = marked.filter(F.col(stays)).dropDuplicates([id_, key_]).select(*docs.columns)
    return alone.unionByName(repeated)
