"""Generic data-quality checks over any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countyloom.functions import count_where


def null_counts(table: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows failing each test."""
    return table.agg(*[count_where(test).alias(name) for name, test in tests.items()])


def duplicate_grain(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key combinations that occur more than once."""
    return (
        table.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .agg(F.count(F.lit(1)).alias("duplicate_grain_rows"))
    )


def totals_by_year(table: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    return table.groupBy("activity_year").agg(*[m.alias(n) for n, m in measures.items()])


def sums(*names: str) -> dict[str, Column]:
    return {n: F.sum(n) for n in names}


def ranked_values(cells: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Most frequent key combinations of pre-counted cells; ties broken by the keys, nulls last."""
    return (
        cells.groupBy(*keys)
        .agg(F.sum("row_count").alias("row_count"))
        .orderBy(F.col("row_count").desc(), *[F.col(k).asc_nulls_last() for k in keys])
        .limit(limit)
    )
