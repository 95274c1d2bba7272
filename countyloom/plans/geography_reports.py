"""Geography checks. All of them read code cells (see `code_cells`), never loan rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countyloom.functions import full_match, has_text, missing_or_na, sum_where, trimmed
from countyloom.operators.geography import GEO_COLUMNS


EXAMPLE_COLUMNS = ["activity_year", "source_era", "state_code", "county_code", *GEO_COLUMNS]


def _rows_where(predicate: Column) -> Column:
    return sum_where(F.col("row_count"), predicate)


def raw_formats(cells: DataFrame) -> DataFrame:
    """Code formats per year and era. Codes are trimmed but not upper-cased here."""
    state, county = F.col("state_code"), F.col("county_code")
    s, c = trimmed(state), trimmed(county)
    return cells.groupBy("activity_year", "source_era").agg(
        F.sum("row_count").alias("row_count"),
        F.count_distinct(F.when(has_text(state), state)).alias("distinct_state_values"),
        F.count_distinct(F.when(has_text(county), county)).alias("distinct_county_values"),
        _rows_where(full_match(s, "[0-9]{1,2}")).alias("state_numeric_1_2"),
        _rows_where(full_match(s, "[A-Z]{2}")).alias("state_alpha_2"),
        _rows_where(missing_or_na(state)).alias("state_missing_or_na"),
        _rows_where(full_match(c, "[0-9]{1,3}")).alias("county_numeric_1_3"),
        _rows_where(full_match(c, "[0-9]{5}")).alias("county_numeric_5"),
        _rows_where(missing_or_na(county)).alias("county_missing_or_na"),
    )


def _validation_measures() -> list[Column]:
    state, county = F.col("state_fips_2"), F.col("county_fips_5")
    return [
        F.sum("row_count").alias("row_count"),
        _rows_where(state.isNull()).alias("missing_state_fips_2"),
        _rows_where(county.isNull()).alias("missing_county_fips_5"),
        _rows_where(county.isNotNull() & state.isNull()).alias("county_present_state_missing"),
        _rows_where(F.substring(county, 1, 2) != state).alias("state_county_prefix_mismatches"),
        _rows_where(F.col("state_fips_2_from_county_prefix")).alias("state_from_county_prefix_rows"),
        F.count_distinct(state).alias("distinct_states_normalized"),
        F.count_distinct(county).alias("distinct_counties_normalized"),
    ]


def validation_by_year(geo: DataFrame) -> DataFrame:
    return geo.groupBy("activity_year").agg(*_validation_measures())


def validation_totals(geo: DataFrame) -> DataFrame:
    out = geo.agg(*_validation_measures())
    # A count over nothing is 0 where a sum is null.
    return out.withColumn("row_count", F.coalesce("row_count", F.lit(0)))


def unmapped_examples(geo: DataFrame, limit: int = 30) -> DataFrame:
    """Most frequent code pairs without a state or county. Cells are already unique per raw code pair."""
    return (
        geo.where(F.col("state_fips_2").isNull() | F.col("county_fips_5").isNull())
        .select(*EXAMPLE_COLUMNS, "row_count")
        .orderBy(F.col("row_count").desc(), *[F.col(c).asc_nulls_last() for c in EXAMPLE_COLUMNS])
        .limit(limit)
    )


def sample_mappings(geo: DataFrame, limit: int = 40) -> DataFrame:
    """First mapped code pairs by year and frequency."""
    return (
        geo.where(F.col("state_fips_2").isNotNull() & F.col("county_fips_5").isNotNull())
        .select(*EXAMPLE_COLUMNS, "row_count")
        .orderBy(
            F.col("activity_year").asc_nulls_last(),
            F.col("row_count").desc(),
            *[F.col(c).asc_nulls_last() for c in EXAMPLE_COLUMNS[1:]],
        )
        .limit(limit)
    )


def source_flags(geo: DataFrame) -> DataFrame:
    return (
        geo.groupBy("activity_year", "source_era", "state_fips_2_source", "county_fips_5_source")
        .agg(F.sum("row_count").alias("row_count"))
        .orderBy(F.col("activity_year").asc_nulls_last(), F.col("row_count").desc())
    )
