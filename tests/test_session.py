"""What is written to the shared folder, and what is left of its making."""

import time

from pyspark.sql import functions as F

from tallycast.session import SHUFFLE_CLEANUP, materialise


def shuffled_files(spark):
    """Names of the shuffle files in the folders of this session's block manager."""
    listed = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (listed.apply(i).getName() for i in range(listed.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffle_files_go_when_the_table_is_written(spark):
    before, setting = shuffled_files(spark), spark.conf.get(SHUFFLE_CLEANUP, "false")
    counted = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().repartition(5, "count")
    table = materialise(counted)
    until = time.time() + 20
    while shuffled_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert shuffled_files(spark) - before == set()
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == setting
    # Both the table and what it was made of can be read again.
    assert table.count() == counted.count() == 100
    assert sorted(table.collect()) == sorted(counted.collect()) == sorted(counted.collect())
