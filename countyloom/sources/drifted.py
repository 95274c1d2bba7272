"""A copy of the annual dataset as converters that differ would have left it: some columns change their type.

In odd years the income is a number and the loan type a whole number. The actions of these years are in two kinds of files:
whole numbers where a loan was originated, text elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.functions import to_double, to_int
from countyloom.schemas import POST_2018, PRE_2018
from countyloom.sources.files import read_era
from countyloom.sources.storage import unsorted_partitions

INCOME = {PRE_2018: "applicant_income_000s", POST_2018: "income"}


def _append(rows: DataFrame, root: str) -> None:
    with unsorted_partitions(rows.sparkSession):
        rows.write.mode("append").option("compression", "zstd").partitionBy("source_era", "file_year").parquet(root)


def write_drifted(spark: SparkSession, annual_root: str, root: str, file_years: Iterable[int]) -> str:
    """Writes the copy to a new folder; returns `root`."""
    years = list(file_years)
    for era, income in INCOME.items():
        rows = read_era(spark, annual_root, era)
        if rows is None:
            continue
        rows = rows.where(F.col("file_year").isin(years))
        even, odd = rows.where("file_year % 2 = 0"), rows.where("file_year % 2 = 1")
        odd = odd.withColumns({income: to_double(F.col(income)), "loan_type": to_int(F.col("loan_type"))})
        originated = F.coalesce(F.col("action_taken") == "1", F.lit(False))
        _append(even, root)
        _append(odd.where(originated).withColumn("action_taken", F.col("action_taken").cast("int")), root)
        _append(odd.where(~originated), root)
    return root
