"""Names, types and fixed dimension rows shared by the plans."""

from __future__ import annotations

from pyspark.sql import types as T

# The two record layouts and the year at which they meet.
PRE_2018 = "pre_2018"
POST_2018 = "post_2018"
FIRST_YEAR = 2007
LAST_PRE_YEAR = 2017
LAST_YEAR = 2024

PREFIX_COLUMNS = ("activity_year", "source_era", "lei_or_respondent_id")
GEOGRAPHY_FIELDS = ("state_code", "county_code")
LENDER_FIELDS = ("respondent_id", "lei", "lei_or_respondent_id")


def era_of(file_year: int) -> str:
    """Layout of one annual file. The file's year decides, never the year written in a row."""
    if not FIRST_YEAR <= file_year <= LAST_YEAR:
        raise ValueError(f"file year {file_year} is outside {FIRST_YEAR}-{LAST_YEAR}")
    return PRE_2018 if file_year <= LAST_PRE_YEAR else POST_2018


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# The columns of each layout that the canonical projection reads from the annual dataset.
PRE_2018_READ = T.StructType(
    [T.StructField("activity_year", T.IntegerType())]
    + _text(
        "lei_or_respondent_id",
        "as_of_year",
        "respondent_id",
        "state_code",
        "county_code",
        "census_tract_number",
        "loan_amount_000s",
        "loan_type",
        "loan_purpose",
        "owner_occupancy",
        "action_taken",
        "applicant_income_000s",
    )
    + [T.StructField("source_era", T.StringType()), T.StructField("file_year", T.IntegerType())]
)

POST_2018_READ = T.StructType(
    [T.StructField("activity_year", T.IntegerType())]
    + _text(
        "lei_or_respondent_id",
        "raw_activity_year",
        "lei",
        "state_code",
        "county_code",
        "census_tract",
        "loan_amount",
        "loan_type",
        "loan_purpose",
        "occupancy_type",
        "action_taken",
        "income",
    )
    + [T.StructField("source_era", T.StringType()), T.StructField("file_year", T.IntegerType())]
)

VALIDATION = T.StructType(
    [
        T.StructField("row_count_gt_zero", T.BooleanType()),
        T.StructField("parquet_exists", T.BooleanType()),
        T.StructField("query_ok", T.BooleanType()),
        T.StructField("activity_year_present", T.BooleanType()),
        T.StructField("geography_fields", T.ArrayType(T.StringType())),
        T.StructField("geography_unmapped", T.ArrayType(T.StringType())),
        T.StructField("lender_identifier_fields", T.ArrayType(T.StringType())),
        T.StructField("lender_identifier_unmapped", T.BooleanType()),
        T.StructField("expected_columns_present", T.BooleanType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("row_count", T.LongType()),
    ]
)

INGEST_LEDGER = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("raw_input_path", T.StringType()),
        T.StructField("parquet_output_path", T.StringType()),
        T.StructField("source_era", T.StringType()),
        T.StructField("input_columns", T.ArrayType(T.StringType())),
        T.StructField("output_columns", T.ArrayType(T.StringType())),
        T.StructField("row_count", T.LongType()),
        T.StructField("conversion_status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("validation", VALIDATION),
        T.StructField("zip_member", T.StringType()),
    ]
)

EXPORT_MANIFEST = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("output_path", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("compression", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)

KEY_VALUE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
