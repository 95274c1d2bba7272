"""Raw annual rows → typed prefix → the 14-column canonical loan row, and its per-year summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countyloom.functions import distinct_where, has_text, to_double, to_int
from countyloom.operators.grouped import KEY, unpacked, with_key
from countyloom.schemas import POST_2018, POST_2018_READ, PRE_2018, PRE_2018_READ, PREFIX_COLUMNS, era_of
from countyloom.sources.files import dataset_files, read_era, uniform_groups

# Where each layout keeps the fields that were renamed in 2018, and the raw fields kept as JSON.
LAYOUTS = {
    PRE_2018: {
        "year": "as_of_year",
        "lender": "respondent_id",
        "tract": "census_tract_number",
        "amount": "loan_amount_000s",
        "amount_unit": 1000,
        "occupancy": "owner_occupancy",
        "income": "applicant_income_000s",
        "kept": (
            "as_of_year",
            "respondent_id",
            "loan_amount_000s",
            "owner_occupancy",
            "applicant_income_000s",
            "census_tract_number",
        ),
    },
    POST_2018: {
        "year": "activity_year",
        "lender": "lei",
        "tract": "census_tract",
        "amount": "loan_amount",
        "amount_unit": 1,
        "occupancy": "occupancy_type",
        "income": "income",
        "kept": ("raw_activity_year", "lei", "loan_amount", "occupancy_type", "income", "census_tract"),
    },
}


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def with_prefix(raw: DataFrame, era: str) -> DataFrame:
    """Typed year, era and lender in front of the raw columns; clashing raw names get a `raw_` prefix."""
    layout = LAYOUTS[era]
    return raw.select(
        to_int(_named(layout["year"])).alias("activity_year"),
        F.lit(era).alias("source_era"),
        _named(layout["lender"]).alias("lei_or_respondent_id"),
        *[_named(c).alias(f"raw_{c}") if c in PREFIX_COLUMNS else _named(c) for c in raw.columns],
    )


def _number(annual: DataFrame, column: str) -> Column:
    """A DOUBLE from a column of text, or from one that some converter stored as numbers."""
    stored = isinstance(annual.schema[column].dataType, T.DoubleType | T.IntegerType | T.LongType)
    return F.col(column).cast("double") if stored else to_double(F.col(column))


def canonical(annual: DataFrame, era: str) -> DataFrame:
    """One era of the annual dataset as canonical loan rows."""
    layout = LAYOUTS[era]
    return annual.select(
        F.col("activity_year").cast("int").alias("activity_year"),
        F.lit(era).alias("source_era"),
        F.col("lei_or_respondent_id").cast("string").alias("lender_id"),
        F.lit("respondent_id" if era == PRE_2018 else "lei").alias("lender_id_type"),
        F.col("state_code").cast("string").alias("state_code"),
        F.col("county_code").cast("string").alias("county_code"),
        F.col(layout["tract"]).cast("string").alias("census_tract"),
        (_number(annual, layout["amount"]) * layout["amount_unit"]).alias("loan_amount"),
        F.col("loan_type").cast("string").alias("loan_type"),
        F.col("loan_purpose").cast("string").alias("loan_purpose"),
        F.col(layout["occupancy"]).cast("string").alias("occupancy_type"),
        F.col("action_taken").cast("string").alias("action_taken"),
        _number(annual, layout["income"]).alias("applicant_income"),
        # Only computed where it is selected: column pruning drops it from every panel.
        F.to_json(F.struct(*layout["kept"]), {"ignoreNullFields": "false"}).alias("raw_source_columns"),
    )


def annual_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every column of every year of the annual dataset; columns of the other era are null."""
    eras = [read_era(spark, root, era) for era in (PRE_2018, POST_2018)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [e for e in eras if e is not None])


def loan_years(spark: SparkSession, root: str) -> DataFrame:
    """Canonical loan rows over the annual dataset: one branch per era, whatever the number of years."""
    eras = [(PRE_2018, PRE_2018_READ), (POST_2018, POST_2018_READ)]
    found = [(era, read_era(spark, root, era, schema)) for era, schema in eras]
    parts = [canonical(annual, era) for era, annual in found if annual is not None]
    return reduce(DataFrame.unionByName, parts)


def mixed_loan_years(spark: SparkSession, root: str) -> DataFrame:
    """`loan_years` over files that store some columns as other types than text, as other converters leave them.

    Files that agree on their types are read together, as they are, and cast afterwards; footers are merged in tasks.
    """
    by_era: dict[str, list[str]] = {}
    for r in dataset_files(spark, root).orderBy("path").collect():  # metadata: a row a file
        by_era.setdefault(era_of(r["file_year"]), []).append(r["path"])
    parts = []
    for era, paths in by_era.items():
        alike: dict[str, tuple[T.StructType, list[str]]] = {}
        for schema, group in uniform_groups(spark, root, paths):
            alike.setdefault(schema.json(), (schema, []))[1].extend(group)
        parts += [canonical(spark.read.option("basePath", root).schema(schema).parquet(*files), era) for schema, files in alike.values()]
    if not parts:
        raise FileNotFoundError(f"no annual files below {root}")
    return reduce(DataFrame.unionByName, parts)


def year_summary(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Per year: rows, distinct raw states, counties and lenders, and the amount.

    Several distinct counts over loan rows would copy every row once per count. States and counties are counted
    in the code cells instead, which leaves one distinct count for the pass over the rows.
    """
    state, county, lender = F.col("state_code"), F.col("county_code"), F.col("lender_id")
    both = has_text(state) & has_text(county)
    places = (
        with_key(cells, ["activity_year"])
        .groupBy(KEY)
        .agg(
            F.count_distinct(F.when(has_text(state), state)).alias("state_count"),
            F.count_distinct(F.when(both, F.concat(state, F.lit("-"), county))).alias("county_count"),
        )
    )
    loans = (
        with_key(rows, ["activity_year"])
        .groupBy(KEY)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            distinct_where(lender, has_text(lender)).alias("lender_count"),
            F.sum("loan_amount").alias("total_loan_amount"),
        )
    )
    return unpacked(loans.join(places, KEY), ["activity_year"]).select(
        "activity_year", "row_count", "state_count", "county_count", "lender_count", "total_loan_amount"
    )
