"""Where intermediate tables and checkpoints live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a new local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """A new folder for one run."""
    return f"{shared_root(spark)}/countyloom-{uuid.uuid4().hex}"


# Fixed value: more partitions in one task than this are sorted, as Spark does it by itself.
OPEN_WRITERS = 24
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_partitions(spark: SparkSession) -> Iterator[None]:
    """Writes by year inside keep a file open for each of a task's few years, instead of sorting and spilling its rows by year."""
    before = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, str(OPEN_WRITERS))
    try:
        yield
    finally:
        spark.conf.unset(_WRITERS) if before is None else spark.conf.set(_WRITERS, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
