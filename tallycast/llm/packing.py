"""Best-fit packing of documents into sequences, after a dominance reduction.

Only the number of pieces of each length matters for the packing, so the plan
is made on a histogram of at most ``capacity`` entries, however many pieces
there are. The reduction takes lengths from the largest down. A set of one to
three pieces with the length at hand is fixed for good when it dominates every
other set that could share a sequence with that piece: whatever a best packing
puts there can be swapped for it. What is left is packed by best fit, longest
first. The plan is a table of runs: the k-th to the m-th piece of a length go
to consecutive sequences at one offset. Its size depends on the capacity alone.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.batches import blocks, give_back, texts_of
from tallycast.llm.tokens import encoder, with_end
from tallycast.session import materialise

# Texts of so many bytes are encoded together.
BLOCK = 1 << 20
CAPACITY = 2048


@dataclass
class Plan:
    """``runs``: (length, first rank, pieces, first sequence, offset)."""

    capacity: int
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    reduced: int = 0


class _Stock:
    """How many pieces of each length are left, and which rank is next."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.left)
        self.rank = dict.fromkeys(self.left, 0)

    def take(self, length: int, count: int) -> int:
        first = self.rank[length]
        self.rank[length] += count
        self.left[length] -= count
        if not self.left[length]:
            self.lengths.pop(bisect_left(self.lengths, length))
        return first

    def fitting(self, room: int) -> int | None:
        """The longest length of at most ``room``."""
        at = bisect_left(self.lengths, room + 1)
        return self.lengths[at - 1] if at else None

    def smallest(self, count: int) -> list[int]:
        out: list[int] = []
        for n in self.lengths:
            out += [n] * min(self.left[n], count - len(out))
            if len(out) == count:
                break
        return out

    def after(self, length: int, count: int) -> list[int]:
        """The ``count`` shortest pieces that are longer than ``length``."""
        out: list[int] = []
        for n in self.lengths[bisect_left(self.lengths, length + 1) :]:
            out += [n] * min(self.left[n], count - len(out))
            if len(out) == count:
                break
        return out

    def best_pair(self, room: int) -> tuple[int, int] | None:
        """Two pieces, longer first, with the largest sum of at most ``room``."""
        best, low, high = None, 0, len(self.lengths) - 1
        while low <= high:
            a, b = self.lengths[high], self.lengths[low]
            if low == high and self.left[a] < 2 or a + b > room:
                high -= 1
                continue
            if best is None or a + b > sum(best):
                best = (a, b)
            low += 1
        return best


def dominating_set(stock: _Stock, length: int, capacity: int) -> tuple[int, ...] | None:
    """Partners of one piece (already taken out) that no other set beats; None if not known."""
    room = capacity - length
    if not (few := stock.smallest(3)) or few[0] > room:
        return ()
    longest = stock.fitting(room)
    if longest == room or len(few) < 2 or few[0] + few[1] > room:
        return (longest,)
    if len(few) < 3 or sum(few) > room:  # at most two partners fit
        pair = stock.best_pair(room)
        if pair is None or longest >= sum(pair):
            return (longest,)
        longer = stock.after(pair[1], 2)
        if pair[0] == longest and (len(longer) < 2 or sum(longer) > room):
            return pair
    return None


def reduce(stock: _Stock, plan: Plan) -> None:
    """Fix dominating sets, many equal ones at once, until none is found."""
    found = True
    while found:
        found = False
        for length in list(reversed(stock.lengths)):
            while stock.left[length]:
                stock.left[length] -= 1
                if not stock.left[length]:
                    stock.lengths.pop(bisect_left(stock.lengths, length))
                partners = dominating_set(stock, length, plan.capacity)
                if not stock.left[length]:
                    stock.lengths.insert(bisect_left(stock.lengths, length), length)
                stock.left[length] += 1
                if partners is None:
                    break
                members = (length, *partners)
                # Taking pieces away never makes room for a better set: as often as the pieces last.
                times = min(stock.left[n] // members.count(n) for n in set(members))
                offset = 0
                for n in members:
                    plan.runs.append((n, stock.take(n, times), times, plan.sequences, offset))
                    offset += n
                plan.sequences += times
                plan.reduced += times * len(members)
                found = True


def best_fit(stock: _Stock, plan: Plan) -> None:
    """Longest pieces first, each into the fullest open sequence that has room."""
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many)
    rooms: list[int] = []

    def put(room: int, run: tuple[int, int]) -> None:
        if room:
            if room not in open_runs:
                open_runs[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            open_runs[room].append(run)

    for length in list(reversed(stock.lengths)):
        while stock.left[length]:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fresh = max(1, stock.left[length] // (plan.capacity // length))
                put(plan.capacity, (plan.sequences, fresh))
                plan.sequences += fresh
                continue
            room = rooms[at]
            first, many = open_runs[room].pop()
            if not open_runs[room]:
                del open_runs[room]
                rooms.pop(at)
            now = min(many, stock.left[length])
            plan.runs.append((length, stock.take(length, now), now, first, plan.capacity - room))
            put(room - length, (first, now))
            if many > now:
                put(room, (first + now, many - now))


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``counts[length]`` pieces of each length; pieces of length 0 don't count."""
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("every length must be between 1 and the capacity")
    plan, stock = Plan(capacity), _Stock(counts)
    reduce(stock, plan)
    best_fit(stock, plan)
    return plan


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, seq bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, *, ids: bool = False) -> DataFrame:
    """Encode whole texts (null: empty), add ``end_id`` and cut what is longer than ``capacity``.

    ``part`` and ``seq`` number the pieces: seq counts those of one length
    within a task. With ``ids`` the pieces carry their ids (little-endian u32).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in blocks(batches, "text", BLOCK):
            found, lengths = with_end(*encoder(tokenizer).encode(texts_of(batch, "text")), end_id)
            each = -(-lengths // capacity)
            row = np.repeat(np.arange(len(lengths)), each)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            start = piece * capacity
            size = np.minimum(lengths[row] - start, capacity)
            place = (np.cumsum(lengths) - lengths)[row] + start
            data = memoryview(found.astype("<u4").tobytes())
            cuts = [data[4 * p : 4 * (p + n)] for p, n in zip(place.tolist(), size.tolist())]
            order = np.argsort(size, kind="stable")
            first = np.searchsorted(size[order], size[order])
            seq = np.empty(len(size), np.int64)
            seq[order] = np.arange(len(size)) - first
            seq += seen[size]
            np.add.at(seen, size, 1)
            out = {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "start": start,
                "length": size,
                "ids_crc32": pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                "part": pa.array(np.full(len(row), part), pa.int32()),
                "seq": seq,
            }
            if ids:
                out["ids"] = pa.array([bytes(c) for c in cuts], pa.binary())
            yield pa.RecordBatch.from_pydict(out)
        encoder(tokenizer).forget()
        give_back()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, PIECES + (", ids binary" if ids else ""))


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to materialised pieces (``part``, ``seq``, ``length``).

    Each piece gets its rank among all pieces of its length: those of earlier
    tasks, from one small count per task and length, plus ``seq``. Rows that
    are alike in all else still get places of their own.
    """
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    ordered = Window.partitionBy("length").orderBy("part")
    before = counts.select("part", "length", (F.sum("n").over(ordered) - F.col("n")).alias("before"), "n")
    before = materialise(before)
    # At most one row per length reaches the driver.
    totals = {r.length: r.n for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(sorted(make_plan(totals, capacity).runs), np.int64).reshape(-1, 5)
    most = max(totals.values(), default=0) + 1
    starts = plan[:, 0] * most + plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = plan[np.searchsorted(starts, length * most + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    # Both sides are spread by task and length; a group holds what one task wrote at most.
    ranked = cut.join(before.drop("n"), ["part", "length"]).withColumn("rank", F.col("seq") + F.col("before"))
    ranked = ranked.select(*[c for c in cut.columns if c not in ("part", "seq")], "rank")
    schema = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes)
    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint").drop("rank")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, *, ids: bool = False) -> DataFrame:
    """All pieces of ``docs`` with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    An empty or null text is a piece of the end id alone. Rows that share a
    ``doc_id``, null included, are packed each. An empty table gives no rows.
    Columns other than ``doc_id`` and ``text`` play no part.
    """
    return place(materialise(pieces(docs, tokenizer, end_id, capacity, ids=ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``doc_ids`` and ``ids`` in order of offset; needs pieces with ids."""
    group = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    ids = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return group.select("sequence_id", F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), ids.alias("ids"))
