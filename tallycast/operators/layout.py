"""Partitioning of inputs ahead of expensive per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Input of a task on average, as of Spark's file scans.
TASK_BYTES = 128 << 20


def input_bytes(df: DataFrame) -> int:
    """What the plan reads, by the sizes of its sources; nothing is run for it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread_few_tasks(df: DataFrame) -> DataFrame:
    """Spread an input of less than a task's worth for every core over all cores.

    A file of a single row group is one task, however costly the work on its
    rows, and small shuffles are merged into few. Larger inputs have tasks enough
    and stay where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if input_bytes(df) < cores * TASK_BYTES else df
