"""Exact distinct counts that roll up: values become dense numbers, and sets of numbers are stored as bitmaps.

A bitmap covers 32,768 numbers, so a set is one row for each such range it touches. Bitmaps of small groups add up to those of
larger ones by OR, without reading the rows again, and a count is the number of bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countyloom.sources.storage import ensure_checkpoint_dir

NUMBER, RANGE, BITS = "_number", "_range", "_bits"
# Places of a partition in an id made by Spark.
_SHIFT = 33


def dense_numbers(values: DataFrame, column: str) -> DataFrame:
    """(column, _number): the distinct values of a column that are not null, numbered from 1 without gaps, in their order.

    Ranges of values are sorted side by side; only the number of rows of each range is added up in the driver.
    """
    ensure_checkpoint_dir(values.sparkSession)
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    ordered = distinct.repartitionByRange(column).sortWithinPartitions(column)
    placed = ordered.withColumn("_at", F.monotonically_increasing_id()).checkpoint()  # so that places stay as they are
    part = F.shiftright("_at", _SHIFT)
    total, firsts = 0, []
    for row in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        firsts.append((row["part"], total))
        total += row["n"]
    # A row for each range of the sort.
    starts = F.broadcast(values.sparkSession.createDataFrame(firsts, "_part long, _first long"))
    number = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << _SHIFT) - 1)) + 1
    return placed.withColumn("_part", part).join(starts, "_part").select(column, number.alias(NUMBER))


def sets_by(rows: DataFrame, keys: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """(keys..., _range, _bits): for each group the set of its values that are not null. Groups without any do not appear.

    Repeated values are dropped before rows meet their numbers. What is shuffled is numbers, at most 32,768 for a set, and not the
    sets that each task could build of them: those are 4 KB each, however few numbers they hold.
    """
    cells = rows.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    place = F.bitmap_bit_position(NUMBER).alias("_place")
    numbered = cells.join(numbers, column).select(*keys, F.bitmap_bucket_number(NUMBER).alias(RANGE), place)
    return numbered.repartition(*keys, RANGE).groupBy(*keys, RANGE).agg(F.bitmap_construct_agg("_place").alias(BITS))


def merged(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets of coarser groups: the union of the sets inside each."""
    return sets.groupBy(*keys, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys..., name): how many values are in the union of each group's sets."""
    return merged(sets, keys).groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
