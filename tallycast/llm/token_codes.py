"""Token ids as directly addressable codes.

A segment holds the ids of consecutive whole documents. Every id is split into
chunks of eight bits, lowest first. Level k holds the k-th chunk of each id
that has one, as bytes, and a bitmap that says which of them go on in level
k + 1; a directory of the bitmap's running counts finds the place there. Any
id is thus read by one step per level, without decoding its neighbours.

Layout of a segment, all little-endian: ``DAC1``, u32 number of levels, u64
entries of each level; then for each level its chunks, and for all but the
last the bitmap (bit i of byte i // 8) and a u32 count of set bits before each
group of 512.

A dataset folder has two tables: ``segments`` (part, seq, offset of its first
id within the part, doc_ids, n_tokens of each document, codes) and ``index``
(part, start: ids before the part).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, give_back, texts_of
from tallycast.llm.tokens import encoder, with_end

MAGIC = b"DAC1"
GROUP = 512
# A segment is closed once it holds so many ids; a document is never split.
SEGMENT_TOKENS = 1 << 18


def pack(ids: np.ndarray) -> bytes:
    """Unsigned ids below 2**32 as one segment."""
    rest = np.asarray(ids, np.uint32)
    levels = []
    while True:
        chunk, more = (rest & 0xFF).astype(np.uint8), rest > 0xFF
        last = not more.any()
        levels.append((chunk, None if last else more))
        if last:
            break
        rest = rest[more] >> np.uint32(8)
    out = [MAGIC, np.array([len(levels)], "<u4").tobytes(), np.array([len(c) for c, _ in levels], "<u8").tobytes()]
    for chunk, more in levels:
        out.append(chunk.tobytes())
        if more is not None:
            counts = np.add.reduceat(more, np.arange(0, len(more), GROUP), dtype=np.int64)
            out.append(np.packbits(more, bitorder="little").tobytes())
            out.append((np.cumsum(counts) - counts).astype("<u4").tobytes())
    return b"".join(out)


def _levels(codes: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap bytes and directory of each level; views, nothing is decoded."""
    if codes[:4] != MAGIC:
        raise ValueError("not a segment of codes")
    n = int(np.frombuffer(codes, "<u4", 1, 4)[0])
    entries = np.frombuffer(codes, "<u8", n, 8).astype(np.int64)
    at, out = 8 + 8 * n, []
    for k, m in enumerate(entries.tolist()):
        bits = (m + 7) // 8 if k < n - 1 else 0
        groups = -(-m // GROUP) if k < n - 1 else 0
        out.append(
            (
                np.frombuffer(codes, np.uint8, m, at),
                np.frombuffer(codes, np.uint8, bits, at + m),
                np.frombuffer(codes, "<u4", groups, at + m + bits),
            )
        )
        at += m + bits + 4 * groups
    return out


def unpack(codes: bytes) -> np.ndarray:
    """All ids of a segment."""
    ids = np.zeros(0, np.uint32)
    for chunk, bitmap, _ in reversed(_levels(codes)):
        value = chunk.astype(np.uint32)
        if len(bitmap):
            value[np.unpackbits(bitmap, count=len(chunk), bitorder="little").view(bool)] |= ids << np.uint32(8)
        ids = value
    return ids


def ids_at(codes: bytes, places: np.ndarray) -> np.ndarray:
    """The ids at the given places of a segment, each by rank look-ups alone."""
    place = np.asarray(places, np.int64)
    out, left = np.zeros(len(place), np.uint32), np.arange(len(place))
    for k, (chunk, bitmap, directory) in enumerate(_levels(codes)):
        out[left] |= chunk[place].astype(np.uint32) << np.uint32(8 * k)
        if not len(bitmap):
            break
        on = (bitmap[place // 8] >> (place % 8) & 1).astype(bool)
        left, place = left[on], place[on]
        group = place // GROUP
        # Set bits between the start of the group and the place.
        spans = np.minimum(group[:, None] * (GROUP // 8) + np.arange(GROUP // 8), len(bitmap) - 1)
        bits = np.unpackbits(bitmap[spans], axis=1, bitorder="little")
        before = np.arange(GROUP) < (place % GROUP)[:, None]
        place = directory[group].astype(np.int64) + (bits & before).sum(axis=1, dtype=np.int64)
    return out


def _segments(tokenizer: str, end_id: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, offset = TaskContext.get().partitionId(), 0, 0
        docs, sizes, held, waiting = [], [], [], 0

        def segment():
            nonlocal seq, offset, docs, sizes, held, waiting
            ids = np.concatenate(held)
            row = {
                "part": [part], "seq": [seq], "offset": [offset],
                "doc_ids": [docs], "n_tokens": [sizes], "codes": [pack(ids)],
            }
            seq, offset, docs, sizes, held, waiting = seq + 1, offset + len(ids), [], [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=SEGMENT)

        for batch in blocks(batches, "text"):
            ids, lengths = with_end(*encoder(tokenizer).encode(texts_of(batch, "text")), end_id)
            ends = np.cumsum(lengths)
            names, first = batch.column("doc_id").to_pylist(), 0
            while first < len(names):
                base = ends[first - 1] if first else 0
                last = min(len(names), int(np.searchsorted(ends, base + most - waiting)) + 1)
                docs += names[first:last]
                sizes += lengths[first:last].tolist()
                held.append(ids[base : ends[last - 1]])
                waiting += len(held[-1])
                first = last
                if waiting >= most:
                    yield segment()
        if docs:
            yield segment()
        encoder(tokenizer).forget()
        give_back()

    return run


SEGMENT = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int32()), ("offset", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("codes", pa.binary()),
    ]
)
SEGMENT_DDL = "part int, seq int, offset bigint, doc_ids array<bigint>, n_tokens array<bigint>, codes binary"


def write_codes(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, *, segment_tokens: int = SEGMENT_TOKENS
) -> None:
    """Encode all texts and write them in ascending order of ``doc_id`` (null first).

    A null text is empty. Rows that share a ``doc_id`` are all kept, in an order
    that their texts fix. An empty table gives a dataset without segments.
    Columns other than ``doc_id`` and ``text`` play no part.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    encode = _segments(tokenizer, end_id, segment_tokens)
    ordered.select("doc_id", "text").mapInArrow(encode, SEGMENT_DDL).write.parquet(f"{path}/segments")
    segments = docs.sparkSession.read.schema(SEGMENT_DDL).parquet(f"{path}/segments")
    # One row for each task that wrote, so one task can add them up.
    sizes = segments.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    sizes.select("part", before.alias("start")).write.parquet(f"{path}/index")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the number of ids before each."""
    segments = spark.read.schema(SEGMENT_DDL).parquet(f"{path}/segments")
    index = spark.read.schema("part int, start bigint").parquet(f"{path}/index")
    # The index has one row for each file of segments.
    joined = segments.join(F.broadcast(index), "part")
    return joined.withColumn("start", F.col("start") + F.col("offset")).drop("offset")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            sizes = np.array(row["n_tokens"], np.int64)
            ends = np.cumsum(sizes)
            data = memoryview(unpack(row["codes"]).astype("<u4").tobytes())
            cuts = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(row["start"] + ends - sizes, pa.int64()),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                    "ids": pa.array([bytes(c) for c in cuts], pa.binary()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, ids (little-endian u32)."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    return read_segments(spark, path).select("start", "doc_ids", "n_tokens", "codes").mapInArrow(_documents, schema)


def read_at(spark: SparkSession, path: str, positions: DataFrame, *, together: int = 4096) -> DataFrame:
    """The ids at global places: ``position`` and ``id`` for each different, valid ``position``.

    Places of one segment are looked up ``together`` at a time, so no group is unbounded.
    """
    segments = read_segments(spark, path)
    size = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n)
    keys = segments.select("part", "seq", "start", size.alias("n"))
    width = SEGMENT_TOKENS
    cells = keys.filter("n > 0").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("n") - 1) / width)))
    )
    wanted = positions.select(F.col("position").cast("bigint")).distinct().withColumn("cell", F.floor(F.col("position") / width))
    found = wanted.join(cells, "cell").filter("position >= start and position < start + n")
    place = F.col("position") - F.col("start")
    groups = found.groupBy("part", "seq", "start", F.floor(place / together).alias("g")).agg(F.collect_list(place).alias("places"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = np.array(row["places"], np.int64)
                got = ids_at(row["codes"], places)
                yield pa.RecordBatch.from_pydict({"position": places + row["start"], "id": got.astype(np.int64)})

    both = groups.join(segments.select("part", "seq", "codes"), ["part", "seq"])
    return both.select("start", "places", "codes").mapInArrow(look_up, "position bigint, id bigint")
