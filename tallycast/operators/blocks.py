"""Row-offset windows over keys that may own a large share of the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tallycast.session import materialise

# monotonically_increasing_id: partition number above, row number below.
ROW_BITS = 33


def in_row_blocks(
    df: DataFrame,
    *,
    key: str,
    order: list[str],
    back: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    blocks: int | None = None,
) -> DataFrame:
    """Apply backward windows of at most ``back`` rows without whole-key tasks.

    The rows are range-partitioned by key and order, which splits a large key
    over as many partitions as its size asks for, and numbered globally. Each
    row goes to its own block and, if it is one of the ``back`` rows before a
    later block, to that block as well. Windows then run per block and key, and
    the borrowed rows are dropped from the result. ``order`` should be unique
    within a key, as for any row-offset window.
    """
    spark = df.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(key), *[F.col(c).asc_nulls_last() for c in order]]
    numbered = materialise(
        df.repartitionByRange(blocks, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    numbered = numbered.withColumn("_block", F.shiftright("_id", ROW_BITS).cast("int"))

    # One row per block: its size is the number of blocks, whatever the data.
    sizes = numbered.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    # At most blocks * back rows: which later blocks borrow a global row number.
    borrowed = (
        starts.withColumn("_row", F.explode(F.transform(F.sequence(F.lit(1), F.lit(back)), lambda k: F.col("_start") - k)))
        .filter(F.col("_row") >= 0)
        .groupBy("_row")
        .agg(F.collect_list("_block").alias("_borrowers"))
    )

    row_in_block = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = (
        numbered.join(F.broadcast(starts), "_block")
        .withColumn("_row", F.col("_start") + row_in_block)
        .join(F.broadcast(borrowed), "_row", "left")
        .withColumn(
            "_target",
            F.explode(F.concat(F.array("_block"), F.coalesce("_borrowers", F.array().cast("array<int>")))),
        )
    )
    w = Window.partitionBy("_target", key).orderBy("_row")
    own = F.col("_target") == F.col("_block")
    return build(placed, w).filter(own).drop("_id", "_block", "_start", "_row", "_borrowers", "_target")
