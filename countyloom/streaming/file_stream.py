"""Annual files as a stream: what has arrived since the last run is converted once, whatever happens in between.

Raw files lie below `<raw>/file_year=<year>/`. Each layout is a file stream of its own, which runs until nothing new is left
and remembers in its checkpoint which files it has seen. A batch writes partitions named after itself, so a batch that was cut
off and is run again replaces what it had written, and files that arrive later for a year add to it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countyloom.plans.canonical import with_prefix
from countyloom.schemas import FIRST_YEAR, LAST_PRE_YEAR, LAST_YEAR, POST_2018, PRE_2018
from countyloom.sources.files import CSV_OPTIONS, hadoop_path, path_exists
from countyloom.sources.storage import unsorted_partitions

YEARS = {PRE_2018: range(FIRST_YEAR, LAST_PRE_YEAR + 1), POST_2018: range(LAST_PRE_YEAR + 1, LAST_YEAR + 1)}
PARTITIONS = ("source_era", "file_year", "batch")


def _pattern(raw: str, years: Iterable[int]) -> str:
    """The folders that files of a layout can arrive in."""
    return f"{raw}/file_year={{{','.join(map(str, years))}}}"


def _header(spark: SparkSession, raw: str, years: Iterable[int]) -> list[str] | None:
    """Columns of the layout, from its first year that is there. Files with other columns fail their batch."""
    for year in years:
        path = f"{raw}/file_year={year}"
        system, target = hadoop_path(spark, path)
        if system.exists(target) and any(s.getLen() and not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(target)):
            return spark.read.options(**CSV_OPTIONS).csv(path).columns
    return None


def write_batch(rows: DataFrame, batch: int, root: str) -> None:
    """Writes a batch into partitions of its own; again the same batch replaces them."""
    writer = rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with unsorted_partitions(rows.sparkSession):
        writer.option("compression", "zstd").partitionBy(*PARTITIONS).parquet(root)


def convert_arrived(spark: SparkSession, raw: str, root: str, checkpoints: str, arrived: Iterable[int] | None = None) -> list[str]:
    """Converts all files that have arrived and were not converted before; returns the layouts that had files at all.

    With `arrived` only the folders of these years are looked at, otherwise all that files of a layout can ever be in.

    Stops at the first layout that fails; the next run takes up where it stopped.
    """
    done, wanted = [], set(arrived or ())
    for era in (PRE_2018, POST_2018):
        years = [y for y in YEARS[era] if arrived is None or y in wanted]
        columns = _header(spark, raw, years)
        if columns is None:
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        files = spark.readStream.schema(schema).options(**CSV_OPTIONS).csv(_pattern(raw, years))
        year = F.regexp_extract(F.col("_metadata.file_path"), r"/file_year=(\d+)/", 1).cast("int")
        placed = files.withColumn("_year", year)
        typed = with_prefix(placed.select(*columns), era).columns
        rows = with_prefix(placed, era).withColumnRenamed("_year", "file_year").select(*typed, "file_year")
        query = (
            rows.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", f"{checkpoints}/{era}")
            .foreachBatch(lambda frame, batch: write_batch(frame, batch, root))
            .start()
        )
        query.awaitTermination()
        done.append(era)
    return done


def read_converted(spark: SparkSession, root: str) -> DataFrame:
    """What the streams have written, the columns of both layouts side by side, with `batch`."""
    layouts = []
    for era in (PRE_2018, POST_2018):
        path = f"{root}/source_era={era}"
        if path_exists(spark, path):
            layouts.append(spark.read.options(basePath=root, mergeSchema=True).parquet(path))
    if not layouts:
        raise FileNotFoundError(f"nothing has been converted below {root}")
    found = layouts[0]
    for other in layouts[1:]:
        found = found.unionByName(other, allowMissingColumns=True)
    return found


def converted_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows and batches of each annual file."""
    return (
        read_converted(spark, root)
        .groupBy(F.col("file_year").alias("year"), "source_era")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("batch").alias("batches"))
    )
