"""Helpers shared by the operators: storage that survives lost executors, numbering, text kernels."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Sub-buckets that a key is split into while its rows are numbered; no task needs to hold a key.
NUMBER_BUCKETS = 1024
FOLDS = 5
#: Bytes of rows that Spark hands to Python at once, where texts are read in several stages by the same workers.
BATCH_BYTES = 4 << 20
#: Rows of a few numbers that a task takes at least, and tasks that a frame of fewer rows still has.
TASK_ROWS, LEAST_TASKS = 1 << 16, 16
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _checkpoint_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame read back from the shared checkpoint folder, so that a lost executor never forces the work again."""
    _checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def gathered(frame: DataFrame, rows: int) -> DataFrame:
    """`frame`, of at most about `rows` narrow rows, in no more partitions than they need: each costs a task, files and log lines."""
    return frame.coalesce(max(LEAST_TASKS, -(-rows // TASK_ROWS)))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder."""
    return f"{_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand their rows to Python in batches of bounded bytes, whatever the length of the texts."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fold that no classifier learns from; rows without an id do."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def number_rows(frame: DataFrame, key: str, order: list[str], name: str, few: bool = True) -> DataFrame:
    """Adds a gapless number from 0 within each value of `key`, in a pseudo-random order of the rows.

    Rows are dealt into hashed sub-buckets of their key; counts of the sub-buckets give each its first number, so a key
    with most of the rows is numbered by many tasks. Rows equal in `order` may swap numbers. Null keys form one key.

    With `few` keys (shards, mixture components) their first numbers, at most NUMBER_BUCKETS rows of a few bytes for each
    key, are broadcast, so that the rows themselves move once; without it, they are joined.
    """
    spread = F.xxhash64(F.lit("number"), *order)
    rows = frame.withColumn("_spread", spread).withColumn("_bucket", F.pmod("_spread", F.lit(NUMBER_BUCKETS)).cast("int"))
    counts = rows.groupBy(F.col(key).alias("_key"), F.col("_bucket").alias("_of")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_key", "_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inner = Window.partitionBy(key, "_bucket").orderBy("_spread", *order)
    numbered = rows.withColumn("_row", F.row_number().over(inner))
    firsts = F.broadcast(firsts) if few else firsts
    joined = numbered.join(firsts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_bucket") == F.col("_of")))
    return joined.select(*frame.columns, (F.col("_first") + F.col("_row") - 1).alias(name))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(29))) * _MIX[1]
    return h ^ (h >> np.uint64(32))


class Words:
    """Hashes of the words of many texts at once, by prefix sums of a polynomial over their bytes.

    Words are the runs between ASCII white space of the texts with A-Z in lower case. `word` holds a 64-bit hash of each
    word, `doc` the index of its text. `grams(k)` gives hashes of all runs of k bytes inside words.
    """

    BASE = 0x9E3779B97F4A7C15
    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)
    _letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
        data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        size = len(data)
        self._grow(size + 1)
        white = (data == 32) | ((data >= 9) & (data <= 13))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(self._letters[data] * self._pow[:size], out=sums[1:])
        edge = np.diff(np.concatenate(([True], white)).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.sums, self.white, self.count = sums, white, len(texts)
        self.word = mix((sums[self.ends] - sums[self.starts]) * self._inv[self.starts] + (self.ends - self.starts).astype(np.uint64))
        bounds = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
        self.doc = np.searchsorted(bounds, self.starts, side="right")
        self.bounds = bounds

    @classmethod
    def _grow(cls, size: int) -> None:
        if len(cls._pow) < size:
            size = max(size, 1 << 16)
            for name, base in (("_pow", cls.BASE), ("_inv", pow(cls.BASE, -1, 1 << 64))):
                powers = np.full(size + 1, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the text) of every run of k bytes that lies inside a word."""
        size = len(self.white)
        if size < k:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        blanks = np.concatenate(([0], np.cumsum(self.white)))
        at = np.flatnonzero(blanks[k:] == blanks[: size - k + 1])
        hashes = mix((self.sums[at + k] - self.sums[at]) * self._inv[at] + np.uint64(k))
        return hashes, np.searchsorted(self.bounds, at, side="right")

    def prefixes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the text) of the first k bytes of every word that has as many."""
        long = self.ends - self.starts >= k
        at = self.starts[long]
        return mix((self.sums[at + k] - self.sums[at]) * self._inv[at] + np.uint64(k)), self.doc[long]


def text_blocks(texts, most: int = 1 << 20):
    """Yields (first, last) ranges of the texts with about `most` characters each; a longer text is a range of its own."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
