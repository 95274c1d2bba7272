"""Deterministic first-rows-per-group sample that stays distributed when one group is very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def first_per_group(
    rows: DataFrame, group: str, coarse: Sequence[str], fine: str, quota: Column, slices: int = SLICES
) -> DataFrame:
    """First `quota` rows of each group in the order (coarse..., fine), nulls last.

    1. Running counts over the coarse keys show where the quota of a group ends; later coarse keys are
       dropped by a join. There is one count row per group and coarse key.
    2. What is left is ranked within slices of the fine key, and each slice keeps its first `quota` rows: no row
       beyond that can be among the first `quota` overall.
    3. The survivors, at most `slices * quota` per group, get their final rank.
    """
    coarse = list(coarse)
    in_order = [F.col(c).asc_nulls_last() for c in coarse]
    running = Window.partitionBy(group).orderBy(*in_order).rowsBetween(Window.unboundedPreceding, 0)
    cells = rows.groupBy(group, *coarse).agg(F.count(F.lit(1)).alias("_n"))
    wanted = (
        cells.withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
        .where(F.col("_before") < quota)
        .select(*[F.col(c).alias(f"_w_{c}") for c in (group, *coarse)])
    )
    same_cell = None
    for c in (group, *coarse):
        match = F.col(c).eqNullSafe(F.col(f"_w_{c}"))
        same_cell = match if same_cell is None else same_cell & match
    near = rows.join(wanted, same_cell, "left_semi").withColumn("_slice", F.pmod(F.xxhash64(fine), F.lit(slices)))

    full_order = [*in_order, F.col(fine).asc_nulls_last()]
    in_slice = Window.partitionBy(group, "_slice").orderBy(*full_order)
    in_group = Window.partitionBy(group).orderBy(*full_order)
    return (
        near.withColumn("_rank", F.row_number().over(in_slice))
        .where(F.col("_rank") <= quota)
        .withColumn("_rank", F.row_number().over(in_group))
        .where(F.col("_rank") <= quota)
        .select(*rows.columns)
    )
