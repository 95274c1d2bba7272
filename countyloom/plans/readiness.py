"""Readiness audit: panel totals, lender identifier coverage, raw field names and action codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.functions import count_where, has_text, no_text, text_or_null, to_int, trimmed
from countyloom.plans.canonical import LAYOUTS
from countyloom.plans.panels import COUNTY_TOTALS
from countyloom.schemas import POST_2018, PRE_2018
from countyloom.sources.dimensions import inline_table

# Name fragments that hint at a lender identifier, and at a lender name.
LENDER_TOKENS = "lender|respondent|lei|name"
NAME_TOKEN = "name"
MISSING_ACTION = "<missing>"


def county_summary(county: DataFrame) -> DataFrame:
    return county.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("activity_year").alias("min_year"),
        F.max("activity_year").alias("max_year"),
        F.count_distinct("activity_year").alias("year_count"),
        *[F.sum(c).alias(c) for c in (*COUNTY_TOTALS, "total_loan_amount")],
    )


def lender_coverage(rows: DataFrame) -> DataFrame:
    """Lender identifiers per year. Rows are reduced to one per lender before the two distinct counts."""
    lender, kind = F.col("lender_id"), F.col("lender_id_type")
    lenders = rows.groupBy("activity_year", "lender_id", "lender_id_type").agg(F.count(F.lit(1)).alias("n"))
    return lenders.groupBy("activity_year").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(no_text(lender), F.col("n")).otherwise(0)).alias("missing_lender_id"),
        F.count_distinct(F.when(has_text(lender), lender)).alias("distinct_lenders"),
        F.count_distinct(F.when(has_text(kind), kind)).alias("lender_id_type_count"),
    )


def lender_id_types(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_era", "lender_id_type").agg(
        F.min("activity_year").alias("min_year"),
        F.max("activity_year").alias("max_year"),
        F.count(F.lit(1)).alias("row_count"),
    )


def _flags(name: Column) -> list[Column]:
    return [
        F.lower(name).rlike(LENDER_TOKENS).alias("lender_identifier_like"),
        F.contains(F.lower(name), F.lit(NAME_TOKEN)).alias("lender_name_like"),
    ]


def _exploded(rows: DataFrame) -> DataFrame:
    packed = rows.where(F.col("raw_source_columns").isNotNull())
    return packed.select("source_era", F.explode(F.json_object_keys("raw_source_columns")).alias("name"))


def raw_source_keys(rows: DataFrame) -> DataFrame:
    """Distinct keys of the raw JSON field, over every row."""
    keys = _exploded(rows).select("name").distinct()
    return keys.select(F.lit("raw_source_key").alias("name_kind"), "name", *_flags(F.col("name")))


def source_keys_by_era(rows: DataFrame) -> DataFrame:
    """The keys of each layout and how many rows have them: one branch a layout, so that only its files are read, united."""
    eras = [_exploded(rows.where(F.col("source_era") == era)) for era in (PRE_2018, POST_2018)]
    return eras[0].unionAll(eras[1]).groupBy("source_era", "name").agg(F.count(F.lit(1)).alias("row_count"))


def name_report(spark: SparkSession, rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raw keys and schema columns, flagged where they look like a lender identifier or a lender name."""
    schema = spark.createDataFrame([(c,) for c in columns], "name string").select(
        F.lit("column").alias("name_kind"), "name", *_flags(F.col("name"))
    )
    return raw_source_keys(rows).unionByName(schema)


def action_counts(rows: DataFrame) -> DataFrame:
    """Rows per year, era and action code; numeric codes first, in numeric order."""
    code = F.coalesce(text_or_null(F.col("action_taken")), F.lit(MISSING_ACTION))
    return (
        rows.groupBy("activity_year", "source_era", code.alias("action_taken"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(
            F.col("activity_year").asc_nulls_last(), to_int(F.col("action_taken")).asc_nulls_last(), "action_taken"
        )
    )


def action_metadata_usage(metadata: DataFrame, rows: DataFrame) -> DataFrame:
    """The action code table with the number of loan rows behind every code."""
    used = rows.groupBy("source_era", trimmed("action_taken").alias("action_taken")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return metadata.join(used, ["source_era", "action_taken"], "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0))
    )


def crosswalk_usage(crosswalk: DataFrame, geo_cells: DataFrame) -> DataFrame:
    """The state crosswalk with the number of loan rows normalised to every state."""
    used = geo_cells.groupBy(F.col("state_fips_2").alias("state_fips")).agg(F.sum("row_count").alias("row_count"))
    return crosswalk.join(used, "state_fips", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))


# What each canonical column holds, and what its reader should know.
MEANINGS = {
    "activity_year": ("Year written in the row, as a whole number.", "Need not be the year of the file."),
    "source_era": ("Which of the two layouts the file has.", "The year of the file decides, never a row."),
    "lender_id": ("Whoever reported the loan, under the numbering of the time.", "The two numberings share no key."),
    "lender_id_type": ("Which numbering lender_id uses.", "One value for each layout."),
    "state_code": ("State as written in the file.", "Kept as text; see the normalised columns for codes."),
    "county_code": ("County as written in the file.", "Kept as text; see the normalised columns for codes."),
    "census_tract": ("Tract as written in the file.", "Written differently in the two layouts."),
    "loan_amount": ("Amount of the loan in dollars.", "Thousands in the early layout are scaled up."),
    "loan_type": ("Code of the kind of loan.", "To be read with the codes of its layout."),
    "loan_purpose": ("Code of what the loan is for.", "To be read with the codes of its layout."),
    "occupancy_type": ("Code of how the home is used.", "Has another name in the early layout."),
    "action_taken": ("Code of how the application ended.", "Panels count each code they know by name."),
    "applicant_income": ("Income of the applicant as a number.", "In the unit of the file."),
    "raw_source_columns": ("The values that were renamed or converted, before that.", "One JSON object a row."),
}
_LAYOUT_FIELDS = {
    "activity_year": "year",
    "lender_id": "lender",
    "census_tract": "tract",
    "loan_amount": "amount",
    "occupancy_type": "occupancy",
    "applicant_income": "income",
}
_TYPES = {"int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def _sources(column: str) -> str:
    """Where the layouts keep a column, the early one first."""
    if column in ("source_era", "lender_id_type"):
        return "file year"
    if column == "raw_source_columns":
        return "; ".join(",".join(layout["kept"]) for layout in LAYOUTS.values())
    names = [layout[_LAYOUT_FIELDS[column]] if column in _LAYOUT_FIELDS else column for layout in LAYOUTS.values()]
    return "; ".join(dict.fromkeys(names))


def column_metadata(spark: SparkSession, rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per canonical column: types from the rows, sources from the layouts, years from the ledger."""
    columns = [
        (name, MEANINGS[name][0], "all", _sources(name), "JSON" if name == "raw_source_columns" else _TYPES[kind], MEANINGS[name][1])
        for name, kind in rows.dtypes
    ]
    table = inline_table(spark, ("column_name", "description", "source_era", "source_columns", "data_type", "notes"), columns)
    years = ledger.agg(F.concat_ws("-", F.min("year").cast("string"), F.max("year").cast("string"))).scalar()
    return table.select("*", years.alias("valid_years"))


def column_metadata_usage(metadata: DataFrame, rows: DataFrame) -> DataFrame:
    """The column table with the number of loan rows in which each column has a value."""
    names = rows.columns
    filled = rows.agg(*[count_where(F.col(c).isNotNull()).alias(c) for c in names])
    long = filled.unpivot([], names, "column_name", "non_null_rows")
    return metadata.join(long, "column_name", "left")
