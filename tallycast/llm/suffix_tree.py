"""Language-model scores from a probabilistic suffix tree of words.

The tree holds contexts of up to ``depth`` words. A context c is kept if a word
w follows it at least ``LEAST`` times and significantly more often than it
follows the next shorter context s: n(cw) * ln((n(cw)/n(c)) / (n(sw)/n(s))) >=
``DIVERGENCE``. Its distribution keeps these words, discounted, and leaves the
rest of the mass to the shorter context; the empty context has the add-one
estimate of single words. A word's probability is that of the longest kept
context that ends just before it, and every distribution sums to one:

    P(w|c) = [w kept] (n(cw) - DISCOUNT) / n(c) + rest(c) * P(w|s)

Counting. Texts are kept as chunks of a few megabytes, a dictionary of word
hashes and codes. Round by round a chunk asks for the counts of its runs of k
words, and only of those whose two parts of k - 1 words occur often enough; the
questions meet in buckets by hash, are added up there and answered to each
chunk. A chunk's data stays where it is (the table is bucketed by chunk), only
questions and answers move, and no table of all words or runs is ever gathered
or broadcast. Hashes have 64 bits for single words and at least 32 + log2 of
the number of buckets for longer runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, ranges, texts_of
from tallycast.llm.words import BASE, END_OF_TEXT, mix, words_of
from tallycast.session import materialise, scratch_path

# Unless another is given; the query has contexts of up to three words.
DEPTH = 2
# A run of words is frequent from so many occurrences, whatever the size of the corpus.
LEAST = 4
# Every share above that after the shorter context counts, if it is significant.
RATIO = 1.0
DIVERGENCE = 10.0
DISCOUNT = 0.5
CHUNK_BYTES = 5 << 20
MOST_BUCKETS = 1 << 16
# Added to the level of questions about contexts.
ASKED = 100

CHUNKS = "chunk bigint, doc_ids array<bigint>, learn array<boolean>, sizes array<int>, words binary, codes binary"
QUESTION = "bucket int, chunk bigint, level int, keys binary, counts binary"
ANSWER = "chunk bigint, level int, bucket int, counts binary"


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for seq, batch in enumerate(blocks(batches, "text", CHUNK_BYTES)):
        found = words_of(texts_of(batch, "text"))
        sizes = found.counts + 1
        tokens = np.full(int(sizes.sum()), END_OF_TEXT, np.uint64)
        tokens[ranges(np.cumsum(sizes) - sizes, sizes - 1)] = found.hashes
        words, codes = np.unique(tokens, return_inverse=True)
        row = {
            "chunk": [part << 32 | seq],
            "doc_ids": [batch.column("doc_id").to_pylist()],
            "learn": [batch.column("learn").to_pylist()],
            "sizes": pa.array([sizes.tolist()], pa.list_(pa.int32())),
            "words": [words.tobytes()],
            "codes": [_packed(codes.astype(np.uint32))],
        }
        yield pa.RecordBatch.from_pydict(row)


class _Chunk:
    """One chunk with the answers it has so far."""

    def __init__(self, row: dict, bits: int, frequent: int) -> None:
        self.bits, self.frequent = bits, frequent
        self.words = np.frombuffer(row["words"], np.uint64)
        self.codes = _unpacked(row["codes"], np.uint32)
        self.sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.learn = np.repeat(np.array(row["learn"], bool), self.sizes)
        # Tokens of the document from each place on.
        self.ahead = np.repeat(self.ends, self.sizes) - np.arange(len(self.codes))
        answers: dict[int, list[tuple[int, bytes]]] = {}
        for a in row.get("answers") or []:
            answers.setdefault(a["level"], []).append((a["bucket"], a["counts"]))
        self.answers = {k: np.concatenate([_unpacked(c, np.uint32) for _, c in sorted(v)]) for k, v in answers.items()}
        # By level: hash and count of the run of k words from each place on (0: rare, or past the text).
        self.hashes: dict[int, np.ndarray] = {1: self.words[self.codes]}
        self.counts: dict[int, np.ndarray] = {}
        if 1 in self.answers:
            self.counts[1] = self.answers[1][self.codes].astype(np.int64)

    def shifted(self, values: np.ndarray) -> np.ndarray:
        return np.append(values[1:], np.zeros(1, values.dtype))

    def runs(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of runs that may be frequent, their different keys, and which key each place has."""
        before = self.counts[level - 1]
        places = np.flatnonzero((before >= self.frequent) & (self.shifted(before) >= self.frequent) & (self.ahead >= level))
        hashes = np.zeros(len(self.codes), np.uint64)
        last = self.hashes[1][places + level - 1]
        hashes[places] = mix(self.hashes[level - 1][places] * BASE + last)
        self.hashes[level] = hashes
        keys, which = np.unique(hashes[places] >> np.uint64(32 - self.bits), return_inverse=True)
        return places, keys, which

    def learn_level(self, level: int) -> None:
        places, keys, which = self.runs(level)
        counts = np.zeros(len(self.codes), np.int64)
        counts[places] = self.answers.get(level, np.zeros(len(keys), np.uint32))[which]
        self.counts[level] = counts

    def kept(self, level: int, n_words: float) -> tuple[np.ndarray, np.ndarray]:
        """Where a run of ``level`` words ends in a word that its context keeps, and the share it gets."""
        run, context = self.counts[level], self.counts[level - 1]
        shorter = self.shifted(self.counts[level - 1])
        base = self.shifted(self.counts[level - 2]) if level > 2 else np.full(len(run), n_words)
        places = np.flatnonzero(run)
        n = run[places].astype(float)
        ratio = (n / context[places]) / (shorter[places] / base[places])
        clear = n * np.log(ratio) >= DIVERGENCE
        places, n = places[clear], n[clear]
        return places, (n - DISCOUNT) / context[places]

    def contexts(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of frequent contexts of ``level`` words that a word follows, their keys, and which each has."""
        places = np.flatnonzero((self.counts[level] >= self.frequent) & (self.ahead > level))
        keys, which = np.unique(self.hashes[level][places] >> np.uint64(32 - self.bits), return_inverse=True)
        return places, keys, which


def _questions(chunk: int, level: int, keys: np.ndarray, counts: np.ndarray, bits: int, width: int) -> Iterator[tuple]:
    """The sorted keys cut by their highest bits; ``width`` bits of a key are left in a bucket."""
    if not len(keys):
        return
    bucket = (keys >> np.uint64(width)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    kind = np.uint32 if width == 32 else np.uint64
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
        yield int(bucket[a]), chunk, level, keys[a:b].astype(kind).tobytes(), _packed(counts[a:b].astype(np.uint32))


def _added(level: int, least: int):
    """Add up a bucket's counts and answer each chunk in the order of its keys."""
    kind = np.uint64 if level == 1 else np.uint32

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, kind) for k in table.column("keys").to_pylist()]
        counts = [_unpacked(c, np.uint32) for c in table.column("counts").to_pylist()]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, np.concatenate(counts)).astype(np.int64)
        total[total < least] = 0
        total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        out, at = [], 0
        for k in keys:
            out.append(_packed(total[which[at : at + len(k)]]))
            at += len(k)
        chunks, buckets = table.column("chunk").to_pylist(), table.column("bucket").to_pylist()
        if level == 1:  # distinct words and words of this bucket
            chunks, buckets = [*chunks, -1], [*buckets, buckets[0]]
            out.append(np.array([np.count_nonzero(total), total.sum(dtype=np.int64)], "<i8").tobytes())
        return pa.table(
            {
                "chunk": pa.array(chunks, pa.int64()),
                "level": pa.array([level] * len(chunks), pa.int32()),
                "bucket": pa.array(buckets, pa.int32()),
                "counts": pa.array(out, pa.binary()),
            }
        )

    return run


def _told(level: int, context: np.ndarray, run: np.ndarray, share: np.ndarray) -> Iterator[tuple]:
    """Kept words by bucket of their context: both keys (of the run its low half) and the share in billionths."""
    bucket = (context >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
    billionths = np.ceil(share * 1e9).astype(np.uint32)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        keys = np.concatenate([context[a:b].astype(np.uint32), run[a:b].astype(np.uint32)])
        yield int(bucket[a]), -1, level, keys.tobytes(), _packed(billionths[a:b])


def _shares(table: pa.Table) -> pa.Table:
    """Add up what the contexts of a bucket keep, each kept word once, and answer who asked."""
    rows = table.select(["chunk", "level", "bucket", "keys", "counts"]).to_pylist()
    told = [r for r in rows if r["chunk"] == -1]
    known, share = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    if told:
        pairs = np.concatenate([np.frombuffer(r["keys"], np.uint32).reshape(2, -1) for r in told], axis=1)
        parts = np.concatenate([_unpacked(r["counts"], np.uint32) for r in told])
        _, first = np.unique(pairs[0].astype(np.uint64) << np.uint64(32) | pairs[1], return_index=True)
        known, which = np.unique(pairs[0][first], return_inverse=True)
        share = np.bincount(which, parts[first]).astype(np.int64)
    share = np.minimum(share, 10**9 - 1).astype(np.uint32)
    asked = [r for r in rows if r["chunk"] != -1]
    out = []
    for r in asked:
        keys = np.frombuffer(r["keys"], np.uint32)
        found = np.zeros(len(keys), np.uint32)
        if len(known):
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            found = np.where(known[place] == keys, share[place], 0).astype(np.uint32)
        out.append(_packed(found))
    columns = {c: pa.array([r[c] for r in asked], t) for c, t in (("chunk", pa.int64()), ("level", pa.int32()), ("bucket", pa.int32()))}
    return pa.table(columns | {"counts": pa.array(out, pa.binary())})


def least(tokens: int) -> int:
    """Occurrences from which a run is frequent: the same in a corpus of any number of learned tokens."""
    return LEAST


def _over_chunks(work: Callable[[dict], Iterator[tuple]], names: list[str], types: list[pa.DataType]):
    """A function on Arrow batches that does ``work`` chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = list(work(batch.slice(k, 1).to_pylist()[0]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


Q_NAMES = ["bucket", "chunk", "level", "keys", "counts"]
Q_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
S_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
S_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Score whole texts with a tree learned from the rows whose ``learn`` is true.

    Returns ``doc_id``, ``held_out`` (not learned from), ``n_tokens`` (words and
    one end of text), ``n_known`` (tokens that occur in what was learned),
    ``train_tokens``, ``base_score`` (log10 probability of the tokens one by one,
    add-one) and ``score`` (log10 probability under the tree). Null texts are
    empty and null ``learn`` is false; every row is scored, rows that repeat an
    id as well. With nothing to learn from both scores are 0. Other columns
    play no part.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.coalesce(F.col("learn"), F.lit(False)).alias("learn")
    )
    # One bucket for each task of a shuffle, so that answers come to where the chunks are.
    name = f"tallycast_chunks_{uuid.uuid4().hex}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = source.mapInArrow(_chunked, CHUNKS)
    made.write.bucketBy(tasks, "chunk").option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    chunks = spark.table(name)
    bits = max(0, min(chunks.count(), MOST_BUCKETS) - 1).bit_length()

    answers: list[DataFrame] = []

    def informed() -> DataFrame:
        if not answers:
            return chunks
        known = answers[0]
        for more in answers[1:]:
            known = known.unionByName(more)
        known = known.groupBy("chunk").agg(F.collect_list(F.struct("level", "bucket", "counts")).alias("answers"))
        return chunks.join(known.hint("shuffle_hash"), "chunk", "left")

    def ask(work: Callable[[dict], Iterator[tuple]]) -> DataFrame:
        return informed().mapInArrow(_over_chunks(work, Q_NAMES, Q_TYPES), QUESTION).groupBy("bucket")

    def words(row: dict) -> Iterator[tuple]:
        chunk = _Chunk(row, bits, LEAST)
        counts = np.bincount(chunk.codes, chunk.learn, len(chunk.words))
        yield from _questions(row["chunk"], 1, chunk.words, counts, bits, 64 - bits)

    found = ask(words).applyInArrow(_added(1, 1), ANSWER)
    found = materialise(found)
    totals = found.filter("chunk = -1").select("counts").toPandas()["counts"]  # one row per bucket
    distinct, learned = (int(sum(np.frombuffer(c, "<i8")[k] for c in totals)) for k in (0, 1))
    frequent = least(learned)
    answers.append(found.filter("chunk <> -1"))

    def raised(row: dict, upto: int) -> _Chunk:
        chunk = _Chunk(row, bits, frequent)
        for level in range(2, upto + 1):
            chunk.learn_level(level)
        return chunk

    def runs(level: int):
        def work(row: dict) -> Iterator[tuple]:
            chunk = raised(row, level - 1)
            places, keys, which = chunk.runs(level)
            counts = np.bincount(which, chunk.learn[places], len(keys))
            yield from _questions(row["chunk"], level, keys, counts, bits, 32)

        return work

    for level in range(2, depth + 2):
        answers.append(materialise(ask(runs(level)).applyInArrow(_added(level, frequent), ANSWER)))

    def tree(row: dict) -> Iterator[tuple]:
        """Each kept (context, word) with its share, and a question for each context there is."""
        chunk = raised(row, depth + 1)
        shift = np.uint64(32 - bits)
        for level in range(2, depth + 2):
            places, share = chunk.kept(level, learned)
            context, run = chunk.hashes[level - 1][places] >> shift, chunk.hashes[level][places] >> shift
            _, first = np.unique(run, return_index=True)
            first = first[np.argsort(context[first], kind="stable")]
            yield from _told(level, context[first], run[first], share[first])
            keys = chunk.contexts(level - 1)[1]
            yield from _questions(row["chunk"], ASKED + level, keys, np.zeros(len(keys)), bits, 32)

    both = informed().mapInArrow(_over_chunks(tree, Q_NAMES, Q_TYPES), QUESTION)
    answers.append(materialise(both.groupBy("bucket", (F.col("level") % ASKED).alias("_level")).applyInArrow(_shares, ANSWER)))

    def scores(row: dict) -> Iterator[tuple]:
        chunk = raised(row, depth + 1)
        count = chunk.counts[1]
        chance = (count + 1) / (learned + distinct + 1)
        base = np.log10(chance)
        for level in range(2, depth + 2):  # contexts of level - 1 words
            places, _, which = chunk.contexts(level - 1)
            given = chunk.answers.get(ASKED + level)
            share = np.zeros(len(count))
            if given is not None:
                share[places] = given[which]
            own = np.zeros(len(count))
            where, part = chunk.kept(level, learned)
            own[where] = part
            # From the place of the context to that of the word it predicts.
            ahead = level - 1
            rest = 1 - np.minimum(share[:-ahead], 1e9 - 1) / 1e9
            inside = chunk.ahead[:-ahead] > ahead
            chance[ahead:] = np.where(inside, own[:-ahead] + rest * chance[ahead:], chance[ahead:])
        starts = chunk.ends - chunk.sizes
        sums = [np.add.reduceat(v, starts) for v in (base, np.log10(chance))]
        known = np.add.reduceat((count > 0).astype(np.int64), starts)
        held = [not x for x in row["learn"]]
        yield from zip(row["doc_ids"], held, chunk.sizes.tolist(), known.tolist(), [learned] * len(held), *(s.tolist() for s in sums))

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return informed().mapInArrow(_over_chunks(scores, S_NAMES, S_TYPES), schema)
