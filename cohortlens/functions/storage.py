"""Tables that cut lineage, in storage every executor can reach."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None
_passing = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a fresh temporary
    folder.  On a cluster a machine-local folder would be lost with the machine.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_dir is None:
        held = tempfile.TemporaryDirectory(prefix="cohortlens-", ignore_cleanup_errors=True)
        atexit.register(held.cleanup)
        _local_dir = held.name
    return _local_dir


def new_folder(spark: SparkSession, name: str) -> str:
    within = getattr(_passing, "folder", None) or shared_dir(spark)
    return f"{within}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, whatever file system it is on."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


@contextmanager
def passing_tables(spark: SparkSession, name: str) -> Iterator[None]:
    """What this thread stages inside goes when the block ends, so its results must be written by then."""
    before = getattr(_passing, "folder", None)
    _passing.folder = new_folder(spark, name)
    try:
        yield
    finally:
        folder, _passing.folder = _passing.folder, before
        remove(spark, folder)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the frame once and go on from the written table.

    Lineage ends here, the work survives lost executors, and the optimizer
    knows the size of what it reads next.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables of one run, each removable as soon as the next one is written.

    Used as a context manager it removes what is left at the end; a run whose
    result still reads from its tables keeps them until ``close``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = new_folder(spark, name)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path  # keeps the frame and its path together
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = getattr(t, "_staged_at", None)
            if path:
                remove(self.spark, path)

    def close(self) -> None:
        remove(self.spark, self.folder)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
