"""Checks of loan rows and panels: missing fields, code formats, grain and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countyloom.functions import count_where, full_match, has_text, no_text, sum_where, trimmed
from countyloom.operators.checks import duplicate_grain, null_counts, ranked_values, totals_by_year
from countyloom.plans.panels import COUNTY_KEYS, LENDER_KEYS
from countyloom.schemas import FIRST_YEAR, LAST_YEAR

YEARS = tuple(range(FIRST_YEAR, LAST_YEAR + 1))


# --- loan rows ----------------------------------------------------------------------------------------


def _years_text(c: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(c), lambda y: y.cast("string")))


def row_reconciliation(cells: DataFrame, ledger: DataFrame, expected: Sequence[int] = YEARS) -> DataFrame:
    """Loan rows against the ingest ledger, and the years present against the expected ones."""
    found = cells.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("loan_years_total_rows"),
        F.collect_set("activity_year").alias("_years"),
        F.coalesce(F.max(F.col("activity_year").isNull()), F.lit(False)).alias("_has_null"),
    )
    stated = ledger.agg(
        F.sum(F.coalesce("row_count", F.lit(0))).alias("total"), _years_text(F.collect_set("year")).alias("years")
    )
    wanted = F.array(*[F.lit(y) for y in sorted(expected)])
    return (
        found.withColumns(
            {
                "metadata_total_rows": F.coalesce(stated.select("total").scalar(), F.lit(0)),
                "metadata_years": stated.select("years").scalar(),
                "loan_years_years": _years_text(F.col("_years")),
                "expected_years_present": (F.array_sort("_years") == wanted) & ~F.col("_has_null"),
            }
        )
        .withColumn("row_count_matches_metadata", F.col("loan_years_total_rows") == F.col("metadata_total_rows"))
        .drop("_years", "_has_null")
    )


def invalid_years(cells: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    year = F.col("activity_year")
    return (
        cells.where(year.isNull() | ~year.between(first, last))
        .groupBy("activity_year")
        .agg(F.sum("row_count").alias("row_count"))
    )


def missing_key_fields(rows: DataFrame) -> DataFrame:
    """Missing values per year; a blank is missing here, the text NA is not."""
    return totals_by_year(
        rows,
        {
            "row_count": F.count(F.lit(1)),
            "missing_activity_year": count_where(F.col("activity_year").isNull()),
            "missing_state_code": count_where(no_text(F.col("state_code"))),
            "missing_county_code": count_where(no_text(F.col("county_code"))),
            "missing_lender_id": count_where(no_text(F.col("lender_id"))),
            "missing_loan_amount": count_where(F.col("loan_amount").isNull()),
        },
    )


def _other_format(column: str, *patterns: str) -> Column:
    c = F.col(column)
    known = None
    for p in patterns:
        match = full_match(trimmed(c), p)
        known = match if known is None else known | match
    return has_text(c) & ~known


COUNTY_FORMATS = ("[0-9]{3}", "[0-9]{5}")
STATE_FORMATS = ("[0-9]{2}", "[A-Z]{2}")


def county_patterns(cells: DataFrame) -> DataFrame:
    county, n = F.col("county_code"), F.col("row_count")
    length = F.when(has_text(county), F.length(trimmed(county)))
    return cells.groupBy("activity_year", "source_era").agg(
        F.sum(n).alias("row_count"),
        sum_where(n, no_text(county)).alias("missing_county_code"),
        sum_where(n, full_match(trimmed(county), COUNTY_FORMATS[0])).alias("county_3_digit"),
        sum_where(n, full_match(trimmed(county), COUNTY_FORMATS[1])).alias("county_5_digit"),
        sum_where(n, _other_format("county_code", *COUNTY_FORMATS)).alias("county_other_format"),
        F.min(length).alias("min_county_len"),
        F.max(length).alias("max_county_len"),
    )


def state_patterns(cells: DataFrame) -> DataFrame:
    state, n = F.col("state_code"), F.col("row_count")
    return cells.groupBy("activity_year", "source_era").agg(
        F.sum(n).alias("row_count"),
        F.count_distinct(F.when(has_text(state), state)).alias("distinct_state_values"),
        sum_where(n, no_text(state)).alias("missing_state_code"),
        sum_where(n, full_match(trimmed(state), STATE_FORMATS[0])).alias("state_2_digit"),
        sum_where(n, full_match(trimmed(state), STATE_FORMATS[1])).alias("state_2_alpha"),
        sum_where(n, _other_format("state_code", *STATE_FORMATS)).alias("state_other_format"),
    )


def county_other_samples(cells: DataFrame, limit: int = 20) -> DataFrame:
    return ranked_values(cells.where(_other_format("county_code", *COUNTY_FORMATS)), ["source_era", "county_code"], limit)


def state_other_samples(cells: DataFrame, limit: int = 20) -> DataFrame:
    return ranked_values(cells.where(_other_format("state_code", *STATE_FORMATS)), ["source_era", "state_code"], limit)


def object_report(objects: DataFrame, sizes: DataFrame) -> DataFrame:
    """Tables and views with their row counts and whether they carry a lender identifier."""
    return objects.join(sizes, "table_name", "left").select(
        "table_name",
        "table_type",
        "row_count",
        F.array_contains("column_names", "lender_id").alias("lender_id_column_present"),
        F.array_contains("column_names", "lei_or_respondent_id").alias("lei_or_respondent_id_column_present"),
    )


# --- panel keys and grain -----------------------------------------------------------------------------


def county_key_nulls(county: DataFrame) -> DataFrame:
    return null_counts(county, {f"null_{k}": F.col(k).isNull() for k in COUNTY_KEYS})


def lender_key_checks(lender: DataFrame) -> DataFrame:
    return null_counts(
        lender,
        {**{f"null_{k}": F.col(k).isNull() for k in COUNTY_KEYS}, "null_or_blank_lender_id": no_text(F.col("lender_id"))},
    )


def county_duplicates(county: DataFrame) -> DataFrame:
    return duplicate_grain(county, COUNTY_KEYS)


def lender_duplicates(lender: DataFrame) -> DataFrame:
    return duplicate_grain(lender, LENDER_KEYS)


# --- reconciliation -----------------------------------------------------------------------------------


def _year_sum(table: DataFrame, column: str, name: str) -> DataFrame:
    return table.groupBy("activity_year").agg(F.sum(column).alias(name))


def lender_panel_reconciliation(
    geo: DataFrame, lender: DataFrame, missing_lender: DataFrame, missing_geo: DataFrame
) -> DataFrame:
    """Every loan row is in the panel or in exactly one exclusion table, per year.

    Only the missing-lender side is filled with 0 when a year is absent; the other two stay null, which
    makes an absent year visible.
    """
    has_county, has_lender = F.col("county_fips_5").isNotNull(), has_text(F.col("lender_id"))
    source = totals_by_year(
        geo,
        {
            "expected_main_rows": count_where(has_county & has_lender),
            "expected_missing_lender_rows": count_where(has_county & ~has_lender),
            "expected_missing_geo_rows": count_where(~has_county),
        },
    )
    filled = F.coalesce("_missing_lender", F.lit(0))
    return (
        source.join(_year_sum(lender, "records", "main_records"), "activity_year", "left")
        .join(_year_sum(missing_lender, "missing_lender_rows", "_missing_lender"), "activity_year", "left")
        .join(_year_sum(missing_geo, "missing_geo_rows", "qa_missing_geo_rows"), "activity_year", "left")
        .select(
            "activity_year",
            "expected_main_rows",
            "main_records",
            (F.col("main_records") - F.col("expected_main_rows")).alias("main_difference"),
            "expected_missing_lender_rows",
            filled.alias("qa_missing_lender_rows"),
            (filled - F.col("expected_missing_lender_rows")).alias("missing_lender_difference"),
            "expected_missing_geo_rows",
            "qa_missing_geo_rows",
            (F.col("qa_missing_geo_rows") - F.col("expected_missing_geo_rows")).alias("missing_geo_difference"),
        )
    )


def _geo_split() -> dict[str, Column]:
    return {
        "loan_years_geo_rows": F.count(F.lit(1)),
        "expected_included_records": count_where(F.col("county_fips_5").isNotNull()),
        "expected_excluded_missing_geo": count_where(F.col("county_fips_5").isNull()),
    }


def _with_differences(table: DataFrame, *keys: str) -> DataFrame:
    included, excluded = F.col("aggregate_included_records"), F.col("qa_excluded_missing_geo")
    return table.select(
        *keys,
        "loan_years_geo_rows",
        "expected_included_records",
        "aggregate_included_records",
        (included - F.col("expected_included_records")).alias("included_difference"),
        "expected_excluded_missing_geo",
        "qa_excluded_missing_geo",
        (excluded - F.col("expected_excluded_missing_geo")).alias("excluded_difference"),
    )


def county_reconciliation_by_year(geo: DataFrame, county: DataFrame, missing_geo: DataFrame) -> DataFrame:
    joined = (
        totals_by_year(geo, _geo_split())
        .join(_year_sum(county, "total_records", "aggregate_included_records"), "activity_year", "left")
        .join(_year_sum(missing_geo, "missing_geo_rows", "qa_excluded_missing_geo"), "activity_year", "left")
    )
    return _with_differences(joined, "activity_year")


def county_reconciliation_total(geo: DataFrame, county: DataFrame, missing_geo: DataFrame) -> DataFrame:
    """The same as one row. The two other totals enter as scalar subqueries."""
    totals = geo.agg(*[m.alias(n) for n, m in _geo_split().items()]).withColumns(
        {
            "aggregate_included_records": county.agg(F.sum("total_records")).scalar(),
            "qa_excluded_missing_geo": missing_geo.agg(F.sum("missing_geo_rows")).scalar(),
        }
    )
    return _with_differences(totals)
