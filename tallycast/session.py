"""Session settings and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Used only where a local session names no folder; a cluster has to name one.
LOCAL_FOLDER = "/tmp/checkpoints/tallycast"
# From Spark 4.1 on: a query's shuffle files go when it ends, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tallycast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on, UTC time and no web page."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialise(df: DataFrame, rows_a_file: int = 0) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Unlike
    a checkpoint, which computes its input once to count and once to write, a
    table is computed once, and later reads prune its columns. What was shuffled
    for it is deleted as soon as it is written, since nothing reads that again.
    ``rows_a_file`` cuts large rows into files that tasks can share out evenly.
    """
    path = scratch_path(df.sparkSession)
    with shuffle_cleanup(df.sparkSession):
        df.write.option("maxRecordsPerFile", rows_a_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end."""
    with settings(spark, {SHUFFLE_CLEANUP: "true"}):
        yield


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Queries that run inside have these settings; afterwards the session has its own again."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_path(spark: SparkSession, label: str = "table") -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/tallycast-{label}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir")
        if configured is None:
            if context.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = LOCAL_FOLDER
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()
