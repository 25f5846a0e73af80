"""Left lookups that hold up under hot keys and large tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tables up to this many bytes are broadcast, all those of one plan together.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot from one in this many rows, so there are never more hot keys.
HOT_KEYS = 20_000
# Rows that need no match are spread over this many join keys.
SPREAD = 4096
# Starts a key that no table holds.
NOWHERE = "\x00"


# Columns of these types tell rows apart at little cost.
CHEAP_TYPES = ("bigint", "int", "smallint", "double", "float", "date", "timestamp", "timestamp_ntz")


def row_bytes(table: DataFrame) -> Column:
    """Rough width of a row in a hash table."""
    parts = [F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(16) for c, t in table.dtypes]
    return sum(parts, F.lit(32)).cast("bigint")


def table_bytes(table: DataFrame) -> int:
    """Rough size of a materialised table, from one cheap pass over it."""
    return table.agg(F.coalesce(F.sum(row_bytes(table)), F.lit(0))).first()[0]


def bytes_by(table: DataFrame, part: str) -> dict[str, int]:
    """``table_bytes`` of every part of a table, in one pass."""
    sizes = table.groupBy(part).agg(F.sum(row_bytes(table)).alias("_bytes"))
    return {r[part]: r["_bytes"] for r in sizes.collect()}


def within_budget(sizes: dict[str, int], budget: int = BROADCAST_BYTES) -> set[str]:
    """The smallest tables that may be broadcast in one plan: together they keep to the budget."""
    chosen, total = set(), 0
    for name in sorted(sizes, key=lambda n: (sizes[n], n)):
        total += sizes[name]
        if total > budget:
            break
        chosen.add(name)
    return chosen


def _joined_key(keys: list[str]) -> Column:
    """One string for all key columns; null if any of them is."""
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.concat(*[F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")) for k in keys])


def lookup(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """``facts`` left-joined to ``table`` on ``keys``, one match at most.

    ``table`` should be materialised; its column ``weight`` is left out. A small
    table is broadcast, which moves no fact row. A larger one is shuffled, but
    for the keys that are frequent among the facts, known to the table or not:
    at most ``HOT_KEYS`` of them, found by a partial count, are broadcast with
    their answers. Their rows and those with a null key travel under scattered
    keys that match nothing. ``size`` in bytes is computed unless given.
    """
    values = [c for c in table.columns if c not in keys and c != weight]
    if (table_bytes(table) if size is None else size) <= broadcast_bytes:
        return facts.join(F.broadcast(table.select(*keys, *values)), keys, "left")

    pack = F.struct(*values)
    cold = table.select(_joined_key(keys).alias("_key"), pack.alias("_cold"))
    keyed = facts.withColumn("_key", _joined_key(keys))
    counts = keyed.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    total = facts.count()
    frequent = counts.filter(F.col("_n") * HOT_KEYS >= total).select("_key")
    hot = frequent.join(cold.withColumnRenamed("_cold", "_hot"), "_key", "left").withColumn("_is_hot", F.lit(True))

    cheap = [c for c, t in facts.dtypes if t in CHEAP_TYPES] or facts.columns
    scatter = F.concat(F.lit(NOWHERE), F.pmod(F.xxhash64(*cheap), F.lit(SPREAD)).cast("string"))
    answered = F.col("_is_hot").isNotNull() | F.col("_key").isNull()
    found = F.coalesce("_hot", "_cold")
    return (
        keyed.join(F.broadcast(hot), "_key", "left")
        .withColumn("_key", F.when(answered, scatter).otherwise(F.col("_key")))
        .join(cold, "_key", "left")
        .select(*facts.columns, *[found.getField(v).alias(v) for v in values])
    )
