"""Whether stored rows stand in order: across the splits of files and inside them, without sorting them again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _place(keys: Sequence[str]) -> Column:
    """The keys as one comparable value, nulls last."""
    return F.struct(*[c for k in keys for c in (F.col(k).isNull(), F.col(k))])


def order_check(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: `rows`, and `inversions`, how many rows are smaller by `keys` than the row before them in the files.

    `stored` must come straight from a read of files of any format. Rows of a split are read one after the other, so they are
    compared inside their split, which bounds a task; then the last row of each split is compared with the first of the next,
    splits in the order of file names and places. No rows: 0 and 0.
    """
    file, key = F.col("_metadata.file_name"), F.col("_key")
    rows = stored.select(
        F.length(file).alias("_long"),  # part-100000 comes after part-99999
        file.alias("_file"),
        F.col("_metadata.file_block_start").alias("_from"),
        F.monotonically_increasing_id().alias("_at"),
        _place(keys).alias("_key"),
    )
    split = ["_long", "_file", "_from"]
    before = F.lag("_key").over(Window.partitionBy(*split).orderBy("_at"))
    inside = rows.withColumn("_down", F.coalesce((key < before).cast("long"), F.lit(0)))
    splits = inside.groupBy(*split).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("_down").alias("_down"),
        F.min_by("_key", "_at").alias("_first"),
        F.max_by("_key", "_at").alias("_last"),
    )
    # A row for each split from here on: a few for each file.
    across = F.coalesce((F.col("_first") < F.lag("_last").over(Window.orderBy(*split))).cast("long"), F.lit(0))
    return splits.withColumn("_down", F.col("_down") + across).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("_down"), F.lit(0)).alias("inversions")
    )
