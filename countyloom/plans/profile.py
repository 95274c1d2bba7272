"""Profile of the published CSV tables. Reads the exports only, as a reader of the published data would."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.functions import shown
from countyloom.sources.files import CORRUPT, read_typed_csv


def county_rows(published: DataFrame) -> DataFrame:
    """Typed rows of the published county panel.

    Older files have no `total_records` column, or leave it blank; `total_applications` holds the same number.
    """
    records = F.col("total_applications")
    if "total_records" in published.columns:
        records = F.coalesce(F.nullif(F.col("total_records"), F.lit("")), records)
    return published.select(
        F.col("activity_year").cast("int").alias("activity_year"),
        "county_fips_5",
        records.cast("bigint").alias("total_records"),
        F.col("originated_loans").cast("bigint").alias("originated_loans"),
        F.col("denied_applications").cast("bigint").alias("denied_applications"),
        F.coalesce(F.nullif(F.col("total_loan_amount"), F.lit("")).cast("double"), F.lit(0.0)).alias("total_loan_amount"),
        F.col("lender_count").cast("bigint").alias("lender_count"),
    )


# Declared types of the published county panel; the rest of its columns is text.
COUNTY_TYPES = {
    "activity_year": "int",
    "total_records": "bigint",
    "application_records": "bigint",
    "purchased_loans": "bigint",
    "total_applications": "bigint",
    "originated_loans": "bigint",
    "denied_applications": "bigint",
    "total_loan_amount": "double",
    "average_loan_amount": "double",
    "median_loan_amount": "double",
    "lender_count": "bigint",
}


def typed_county_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the published county panel by declared types, with `_corrupt` for those that don't fit.

    Older files lack `total_records` or leave it blank; `total_applications` holds the same number. A blank amount is 0.
    """
    read = read_typed_csv(spark, path, COUNTY_TYPES)
    records = F.col("total_applications")
    if "total_records" in read.columns:
        records = F.coalesce("total_records", records)
    amount = F.coalesce("total_loan_amount", F.lit(0.0)).alias("total_loan_amount")
    counts = ("originated_loans", "denied_applications")
    return read.select("activity_year", "county_fips_5", records.alias("total_records"), *counts, amount, "lender_count", CORRUPT)


def parse_counts(rows: DataFrame) -> DataFrame:
    """Good and corrupt rows of a typed read, by year; rows whose year can't be read have none."""
    return rows.groupBy("activity_year").agg(
        F.count(F.when(F.col(CORRUPT).isNull(), 1)).alias("good_rows"), F.count(CORRUPT).alias("corrupt_rows")
    )


def by_year(rows: DataFrame) -> DataFrame:
    total = F.col("total_records")
    other = total - F.col("originated_loans") - F.col("denied_applications")
    sums = rows.groupBy("activity_year").agg(
        F.count(F.lit(1)).alias("county_count"),
        *[
            F.sum(c).alias(c)
            for c in ("total_records", "originated_loans", "denied_applications", "total_loan_amount")
        ],
        # The element at position n // 2: the discrete median counted from the top. A year has one row per
        # five-digit county code and state, so its buffer is small whatever the number of loans.
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY lender_count DESC)").cast("bigint").alias("median_lender_count"),
    )
    return sums.select(
        "activity_year",
        "county_count",
        "total_records",
        F.try_divide(F.col("originated_loans"), total).alias("origination_share"),
        F.try_divide(F.col("denied_applications"), total).alias("denial_share"),
        F.try_divide(other, total).alias("other_action_share"),
        F.try_divide(F.col("total_loan_amount"), total).cast("bigint").alias("average_record_amount"),
        "median_lender_count",
    )


def formatted_by_year(rows: DataFrame) -> DataFrame:
    """The yearly profile as display text: separators in counts, three decimals in shares."""
    table = by_year(rows)
    return table.select(
        "activity_year", *[shown(F.col(c), 3 if c.endswith("_share") else 0).alias(c) for c in table.columns[1:]]
    ).orderBy("activity_year")


def _top(rows: DataFrame, columns: list[str], limit: int) -> DataFrame:
    return rows.select(*columns).orderBy(*[F.col(c).desc() for c in columns]).limit(limit)


def top_counties(rows: DataFrame, limit: int = 10) -> DataFrame:
    """Largest county-years by records, ties broken by every following column, all descending."""
    columns = ["total_records", "activity_year", "county_fips_5", "originated_loans", "denied_applications", "lender_count"]
    return _top(rows, columns, limit)


def top_lender_counts(rows: DataFrame, limit: int = 10) -> DataFrame:
    return _top(rows, ["lender_count", "activity_year", "county_fips_5", "total_records"], limit)


def sample_coverage(sample: DataFrame) -> DataFrame:
    return sample.groupBy(F.col("activity_year").cast("int").alias("activity_year")).agg(
        F.count(F.lit(1)).alias("sample_rows")
    )
