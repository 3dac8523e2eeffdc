"""How rows are laid out before a stage that works on them heavily."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: larger tables are never shuffled for this, however many cores there are
MOST_BYTES = 2 << 30
#: bytes of a table, as stored, whose rows by key make one task
TASK_BYTES = 2 << 20
#: estimates from here on stand for an unknown size
UNKNOWN_BYTES = 1 << 50


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread a table too small for its file splits to use every core.

    A table with a split or more per core, or of more than ``MOST_BYTES``, is
    returned as it is.  The size is the optimizer's estimate.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()  # reads 64m as well as 67108864
    size = _estimated_bytes(df)
    return df.repartition(cores) if size < min(split * cores, MOST_BYTES) else df


def fill_batch(batch: DataFrame) -> DataFrame:
    """Spread an arrived batch of fewer partitions than cores, whatever its size.

    A batch may come in one file, which one task would read and work on.
    """
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch.repartition(cores) if batch.rdd.getNumPartitions() < cores else batch


def tasks_by_key(rows: DataFrame, keys: Sequence[str], source: DataFrame) -> DataFrame:
    """Rows of a key in one task, in tasks that do not grow with ``source``, which the rows are made from.

    Narrow rows compress so well that partitions joined up to a size in the
    exchange take many times of it where they are sorted, so a table of more
    than ``TASK_BYTES`` per core gets a number of tasks in proportion to its size.
    """
    size = _estimated_bytes(source)
    tasks = -(-size // TASK_BYTES)
    if size >= UNKNOWN_BYTES or tasks <= rows.sparkSession.sparkContext.defaultParallelism:
        return rows.repartition(*keys)
    return rows.repartition(tasks, *keys)
