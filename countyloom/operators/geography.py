"""Normalise raw state and county codes to FIPS, with a label for every decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.functions import full_match, trimmed
from countyloom.schemas import POST_2018
from countyloom.sources.dimensions import state_crosswalk

GEO_COLUMNS = [
    "state_fips_2",
    "state_fips_2_source",
    "state_fips_2_from_county_prefix",
    "county_fips_3",
    "county_fips_5",
    "county_fips_5_source",
    "county_fips_5_valid_state_prefix",
]


def normalize_codes(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Add the seven geography columns to rows that carry source_era, state_code and county_code.

    Two left joins to the constant 56-row crosswalk, both broadcast, so the rows are never shuffled. Codes are
    classified once; lookup and length decide first, which leaves at most one pattern test per usual code.
    """
    states = state_crosswalk(spark)
    by_abbr = F.broadcast(states.select(F.col("state_abbr").alias("_abbr"), F.col("state_fips").alias("_abbr_fips")))
    by_fips = F.broadcast(states.select(F.col("state_fips").alias("_known_fips")))

    state, county = F.col("_state"), F.col("_county")
    cleaned = rows.withColumns(
        {"_state": F.upper(trimmed("state_code")), "_county": F.upper(trimmed("county_code"))}
    ).join(by_abbr, F.col("_state") == F.col("_abbr"), "left")
    width = F.length(county)
    classified = cleaned.withColumns(
        {
            "_state_kind": F.when(F.col("_abbr_fips").isNotNull(), "letters")
            .when(state.isNull() | state.isin("", "NA"), "missing")
            .when(full_match(state, "[0-9]{1,2}"), "digits")
            .when(full_match(state, "[A-Z]{2}"), "letters")
            .otherwise("other"),
            "_county_kind": F.when(county.isNull() | county.isin("", "NA"), "missing")
            .when((width <= 3) & full_match(county, "[0-9]+"), "part")
            .when((width == 5) & full_match(county, "[0-9]+"), "full")
            .otherwise("other"),
        }
    )

    state_kind, county_kind = F.col("_state_kind"), F.col("_county_kind")
    looked_up = classified.withColumn("_prefix", F.when(county_kind == "full", F.substring(county, 1, 2))).join(
        by_fips, F.col("_prefix") == F.col("_known_fips"), "left"
    )

    # A numeric state code is padded but not looked up: an unknown number passes through.
    own_state = F.when(state_kind == "digits", F.lpad(state, 2, "0")).when(
        state_kind == "letters", F.col("_abbr_fips")
    )
    own_source = (
        F.when(state_kind == "missing", "missing_state_code")
        .when(state_kind == "digits", "state_code_numeric")
        .when((state_kind == "letters") & F.col("_abbr_fips").isNotNull(), "state_code_abbr")
        .when(state_kind == "letters", "unmapped_state_code_abbr")
        .otherwise("unmapped_state_code")
    )
    suffix = F.right(county, F.lit(3))
    decided = looked_up.withColumns(
        {
            "_own_state": own_state,
            "_own_source": own_source,
            "county_fips_5_valid_state_prefix": F.col("_known_fips").isNotNull() & (suffix != "000"),
        }
    )

    valid, own, prefix = F.col("county_fips_5_valid_state_prefix"), F.col("_own_state"), F.col("_prefix")
    late = F.col("source_era") == POST_2018
    decided = decided.withColumns(
        {
            "_fills": late & valid & own.isNull(),
            "_overrides": late & valid & own.isNotNull() & (own != prefix),
        }
    )
    from_prefix = F.col("_fills") | F.col("_overrides")
    decided = decided.withColumns(
        {
            "state_fips_2": F.when(from_prefix, prefix).otherwise(own),
            "state_fips_2_source": F.when(F.col("_fills"), "county_code_prefix_missing_or_unmapped_state_code")
            .when(F.col("_overrides"), "county_code_prefix_conflict_with_state_code")
            .otherwise(F.col("_own_source")),
            "state_fips_2_from_county_prefix": from_prefix,
        }
    )

    # The component path is open to both eras and, unlike the five-digit path, accepts suffix 000.
    padded = F.lpad(county, 3, "0")
    is_part = county_kind == "part"
    by_parts = is_part & F.col("state_fips_2").isNotNull()
    return decided.withColumns(
        {
            "county_fips_3": F.when(valid, suffix).when(is_part, padded),
            "county_fips_5": F.when(valid, county).when(by_parts, F.concat("state_fips_2", padded)),
            "county_fips_5_source": F.when(valid, "county_code_5")
            .when(by_parts, "state_county_components")
            .when(county_kind == "missing", "missing_county_code")
            .when(county_kind == "full", "invalid_county_code_5")
            .otherwise("unmapped_county_code"),
        }
    ).select(*rows.columns, *GEO_COLUMNS)


def loan_years_geo(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Canonical loan rows with geography, in published column order."""
    before = ["activity_year", "source_era", "lender_id", "lender_id_type", "state_code", "county_code"]
    after = [c for c in rows.columns if c not in before]
    return normalize_codes(rows, spark).select(*before, *GEO_COLUMNS, *after)


def code_cells(rows: DataFrame) -> DataFrame:
    """Rows per year, era and raw code pair.

    All code-format and geography checks depend on nothing else, so they read this aggregate: its size follows
    the number of distinct codes, not the number of loans, and normalisation runs once per distinct pair.
    """
    return rows.groupBy("activity_year", "source_era", "state_code", "county_code").agg(
        F.count(F.lit(1)).alias("row_count")
    )
