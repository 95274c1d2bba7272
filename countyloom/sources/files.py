"""Readers for the raw annual files, the annual Parquet dataset and its ledgers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countyloom.schemas import INGEST_LEDGER, era_of
from countyloom.sources.archives import read_archive

# `enforceSchema` off: every file's header is checked against the first one instead of being skipped unread.
CSV_OPTIONS = {
    "header": True,
    "inferSchema": False,
    "enforceSchema": False,
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
}


@dataclass(frozen=True)
class AnnualSource:
    """One annual file: a CSV path (file or directory; gzip and bzip2 work too) or a ZIP with one CSV in it."""

    file_year: int
    path: str
    multi_line: bool = False

    @property
    def era(self) -> str:
        return era_of(self.file_year)

    @property
    def is_archive(self) -> bool:
        return self.path.lower().endswith(".zip")


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = hadoop_path(spark, path)
    return system.exists(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under a path, from file metadata."""
    system, target = hadoop_path(spark, path)
    return system.getContentSummary(target).getLength()


def leaf(root: str, file_year: int) -> str:
    """Directory of one year inside the annual dataset."""
    return f"{root}/source_era={era_of(file_year)}/file_year={file_year}"


# --- raw annual rows ----------------------------------------------------------------------------------


def read_raw(spark: SparkSession, source: AnnualSource) -> tuple[DataFrame, str | None]:
    """Raw rows of one annual file, every column text, and the archive member they came from."""
    if source.is_archive:
        system, target = hadoop_path(spark, source.path)
        return read_archive(spark, target.makeQualified(system.getUri(), system.getWorkingDirectory()).toString())
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", source.multi_line)
    return reader.csv(source.path), None


# --- annual Parquet dataset ---------------------------------------------------------------------------


def read_year(spark: SparkSession, root: str, file_year: int) -> DataFrame:
    """One year with the merged schema of all its files, including the partition columns."""
    return spark.read.options(basePath=root, mergeSchema=True).parquet(leaf(root, file_year))


def read_era(spark: SparkSession, root: str, era: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All years of one era, or None when no year of it was ingested.

    With a schema no footers are merged and only those columns are read; without one the years' schemas
    are merged.
    """
    path = f"{root}/source_era={era}"
    if not path_exists(spark, path):
        return None
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(path)


def dataset_files(spark: SparkSession, root: str) -> DataFrame:
    """(file_year, path, bytes, changed_at) of every data file of the annual dataset; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    return files.select("file_year", "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed_at"))


def _writer(path: str) -> tuple[str, str]:
    """Sorts files by the job that wrote them: in Spark's names it follows the number of the part. Its files have one schema."""
    name = path.rpartition("/")[2]
    return re.sub(r"^part-\d+-", "", name), path


def uniform_groups(spark: SparkSession, root: str, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files in groups within which every column has one type, each with its schema.

    The footers of a group are read and merged in tasks. Only where types clash is a group halved, so files that agree cost
    one merge, and a change of type somewhere in a sorted list costs a number of merges that grows with its logarithm. The list
    is sorted by writers, whose files would otherwise alternate inside a year and be halved down to each single one.
    """
    return _uniform(spark, root, sorted(paths, key=_writer))


def _uniform(spark: SparkSession, root: str, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    try:
        return [(spark.read.options(basePath=root, mergeSchema=True).parquet(*paths).schema, paths)]
    except (PySparkException, Py4JJavaError) as clash:  # which of them depends on where the footers met
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(clash):
            raise
    half = len(paths) // 2
    return _uniform(spark, root, paths[:half]) + _uniform(spark, root, paths[half:])


def dataset_tag(spark: SparkSession, root: str) -> str:
    """A short name for the state of all files of the annual dataset: their paths, sizes and times."""
    files = dataset_files(spark, root).select(F.xxhash64("path", "bytes", "changed_at").cast("decimal(38,0)").alias("h"))
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
    return f"{row['n']}.{int(row['h'] or 0) & (2**64 - 1):016x}"


def read_ledger(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Ingest ledger, one JSON object per line; with `array` one JSON array per file."""
    return spark.read.schema(INGEST_LEDGER).option("multiLine", array).json(path)


def read_published_csv(spark: SparkSession, path: str) -> DataFrame:
    """A published CSV table, header-driven and untyped; callers cast the columns they use."""
    return spark.read.options(**CSV_OPTIONS).csv(path)


CORRUPT = "_corrupt"


def read_typed_csv(spark: SparkSession, path: str, types: dict[str, str], other: str = "string") -> DataFrame:
    """A published CSV table with declared types, and the text of rows that don't fit them in the column `_corrupt`.

    The header says which columns there are; those without a declared type are read as `other`. A row with a value of another
    type, or with too few or too many fields, keeps what could be read and doesn't fail the rest. Every column of a row is
    parsed whatever is selected, so that a row is corrupt in every query or in none.
    """
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    fields = ", ".join(f"`{c}` {types.get(c, other)}" for c in [*header, CORRUPT])
    reader = spark.read.options(**{**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False})
    # Spark only converts the columns that a query needs; the length, which is never below 0, needs them all.
    whole = F.length(F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in header])) >= 0
    return reader.schema(fields).csv(path).withColumn(CORRUPT, F.when(whole, F.col(CORRUPT)))
