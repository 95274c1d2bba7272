"""County-year and lender-county-year panels and the tables that account for excluded rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countyloom.functions import count_where, distinct_where, has_text, no_text, trimmed
from countyloom.operators.bitmaps import counted, dense_numbers, sets_by
from countyloom.operators.checks import sums, totals_by_year
from countyloom.operators.grouped import KEY, summarise, unpacked, with_key
from countyloom.sources.dimensions import APPLICATION_CODES, DENIED, ORIGINATED, PURCHASED

# Columns of a normalised loan row that the panels and exclusion tables read.
ROW_COLUMNS = [
    "activity_year",
    "state_fips_2",
    "county_fips_5",
    "lender_id",
    "lender_id_type",
    "loan_amount",
    "loan_type",
    "loan_purpose",
    "action_taken",
]
COUNTY_KEYS = ["activity_year", "state_fips_2", "county_fips_5"]
LENDER_KEYS = [*COUNTY_KEYS, "lender_id"]

# Codes that get a count column of their own; anything else, and null, goes to "other".
LOAN_TYPE_CODES = ("1", "2", "3", "4")
LOAN_PURPOSE_CODES = ("1", "2", "3", "31", "32", "4", "5")


def _rows() -> Column:
    return F.count(F.lit(1))


def _coded(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows whose codes are trimmed once, not in each of the many counts over them."""
    return rows.withColumns({c: trimmed(c) for c in columns})


def _action(*codes: str) -> Column:
    return count_where(F.col("action_taken").isin(*codes))


def _denominators(all_rows: str, legacy: str) -> dict[str, Column]:
    """Independent record counts: a null or unknown action counts in the totals only."""
    return {
        all_rows: _rows(),
        "application_records": _action(*APPLICATION_CODES),
        "purchased_loans": _action(PURCHASED),
        legacy: _rows(),
        "originated_loans": _action(ORIGINATED),
        "denied_applications": _action(DENIED),
    }


def _amounts() -> dict[str, Column]:
    return {"total_loan_amount": F.sum("loan_amount"), "average_loan_amount": F.avg("loan_amount")}


def _code_counts(column: str, codes: tuple[str, ...]) -> dict[str, Column]:
    c = F.col(column)
    out = {f"{column}_{code}_count": count_where(c == code) for code in codes}
    out[f"{column}_other_count"] = count_where(c.isNull() | ~c.isin(*codes))
    return out


MEDIANS = {"median_loan_amount": "loan_amount"}


def _known(rows: DataFrame | None) -> DataFrame | None:
    return None if rows is None else rows.where(F.col("county_fips_5").isNotNull())


def distinct_lenders() -> Column:
    return distinct_where(F.col("lender_id"), has_text(F.col("lender_id")))


def county_year_lending(geo: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """One row per year, state and county, over rows whose county is known.

    `cells` are normalised code cells, if at hand; they spare the panel a counting pass over the rows.
    """
    measures = {
        **_denominators("total_records", "total_applications"),
        **_amounts(),
        "lender_count": distinct_lenders(),
    }
    out = summarise(_known(_coded(geo, "action_taken")), COUNTY_KEYS, measures, MEDIANS, _known(cells), apart=True)
    return out.select(*[c for c in out.columns if c not in ("median_loan_amount", "lender_count")], "median_loan_amount", "lender_count")


def county_medians(geo: DataFrame) -> DataFrame:
    """The county panel's medians alone, every group by the route for large groups."""
    rows = geo.where(F.col("county_fips_5").isNotNull())
    return summarise(rows, COUNTY_KEYS, {"total_records": _rows()}, MEDIANS, large_group=0)


def lender_county_year(geo: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """One row per year, state, county and lender, over rows whose county and lender are known.

    The identifier type is aggregated as a small integer and named afterwards: text has no fixed width, and
    one text aggregate would turn the whole hash aggregation into a sort.
    """
    kind = F.col("lender_id_type")
    measures = {
        "_kind": F.min(F.when(kind == "lei", 1).when(kind == "respondent_id", 2)),
        **_denominators("records", "applications"),
        **_amounts(),
        **_code_counts("loan_type", LOAN_TYPE_CODES),
        **_code_counts("loan_purpose", LOAN_PURPOSE_CODES),
    }
    known = _coded(_known(geo).where(has_text(F.col("lender_id"))), "action_taken", "loan_type", "loan_purpose")
    out = summarise(known, LENDER_KEYS, measures, MEDIANS, _known(cells))
    first = [c for c in measures if c != "_kind"]
    split = first.index("average_loan_amount") + 1
    return out.select(
        *LENDER_KEYS,
        F.when(F.col("_kind") == 1, "lei").when(F.col("_kind") == 2, "respondent_id").alias("lender_id_type"),
        *first[:split],
        "median_loan_amount",
        *first[split:],
    )


def lender_sets(geo: DataFrame) -> DataFrame:
    """The lenders of every year, state and county (null where it is unknown), as sets that roll up."""
    lenders = geo.where(has_text(F.col("lender_id"))).select(*COUNTY_KEYS, "lender_id")
    return sets_by(lenders, COUNTY_KEYS, "lender_id", dense_numbers(lenders, "lender_id"))


def lender_counts_by_year(sets: DataFrame) -> DataFrame:
    """Distinct lenders of a year over all rows, and over those whose county is known, from the stored sets."""
    every = counted(sets, ["activity_year"], "lender_count")
    placed = counted(sets.where(F.col("county_fips_5").isNotNull()), ["activity_year"], "panel_lender_count")
    both = with_key(every, ["activity_year"]).drop("activity_year").join(with_key(placed, ["activity_year"]).drop("activity_year"), KEY, "left")
    return unpacked(both.withColumn("panel_lender_count", F.coalesce("panel_lender_count", F.lit(0))), ["activity_year"])


def lender_counts_by_state(sets: DataFrame) -> DataFrame:
    """Distinct lenders of each state over all years and of each of its years."""
    yearly = counted(sets, ["activity_year", "state_fips_2"], "lender_count")
    whole = counted(sets, ["state_fips_2"], "lender_count")
    columns = [F.lit("year").alias("grain"), "activity_year", "state_fips_2", "lender_count"]
    return yearly.select(*columns).unionByName(whole.select(F.lit("all years").alias("grain"), F.lit(None).cast("int").alias("activity_year"), *columns[2:]))


def _missing_geo(geo: DataFrame) -> DataFrame:
    return geo.where(F.col("county_fips_5").isNull())


def county_year_missing_geo(geo: DataFrame) -> DataFrame:
    """Rows left out of the county panel, per year."""
    return totals_by_year(
        _missing_geo(geo),
        {
            "missing_geo_rows": _rows(),
            "missing_state_fips_2": count_where(F.col("state_fips_2").isNull()),
            "missing_county_fips_5": count_where(F.col("county_fips_5").isNull()),
            "lender_count": distinct_lenders(),
            "total_loan_amount": F.sum("loan_amount"),
        },
    )


def lender_panel_missing_geo(geo: DataFrame) -> DataFrame:
    """Rows left out of the lender panel because the county is unknown, per year."""
    return totals_by_year(
        _coded(_missing_geo(geo), "action_taken"),
        {
            "missing_geo_rows": _rows(),
            "missing_state_fips_2": count_where(F.col("state_fips_2").isNull()),
            "missing_county_fips_5": count_where(F.col("county_fips_5").isNull()),
            "missing_lender_id": count_where(no_text(F.col("lender_id"))),
            "distinct_lenders": distinct_lenders(),
            "originated_loans": _action(ORIGINATED),
            "denied_applications": _action(DENIED),
            "total_loan_amount": F.sum("loan_amount"),
        },
    )


def lender_panel_missing_lender(geo: DataFrame) -> DataFrame:
    """Rows left out of the lender panel because the lender is unknown, per county-year."""
    return (
        _coded(geo.where(F.col("county_fips_5").isNotNull() & no_text(F.col("lender_id"))), "action_taken")
        .groupBy(*COUNTY_KEYS)
        .agg(
            _rows().alias("missing_lender_rows"),
            _action(ORIGINATED).alias("originated_loans"),
            _action(DENIED).alias("denied_applications"),
            F.sum("loan_amount").alias("total_loan_amount"),
        )
    )


# --- reports over the stored panels -------------------------------------------------------------------

COUNTY_TOTALS = (
    "total_records",
    "application_records",
    "purchased_loans",
    "total_applications",
    "originated_loans",
    "denied_applications",
)
LENDER_TOTALS = (
    "records",
    "application_records",
    "purchased_loans",
    "applications",
    "originated_loans",
    "denied_applications",
    "total_loan_amount",
)


def _span() -> dict[str, Column]:
    return {"min_year": F.min("activity_year"), "max_year": F.max("activity_year")}


def _one_row(table: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return table.agg(*[m.alias(n) for n, m in measures.items()])


def county_panel_summary(county: DataFrame) -> DataFrame:
    return _one_row(
        county,
        {
            "aggregate_row_count": _rows(),
            **_span(),
            "included_applications": F.sum("total_applications"),
            "included_records": F.sum("total_records"),
            "included_application_records": F.sum("application_records"),
            **sums("purchased_loans", "originated_loans", "denied_applications"),
        },
    )


def county_panel_by_year(county: DataFrame) -> DataFrame:
    return totals_by_year(county, {"county_count": _rows(), **sums(*COUNTY_TOTALS, "total_loan_amount")})


def county_panel_geo_consistency(county: DataFrame) -> DataFrame:
    state, fips = F.col("state_fips_2"), F.col("county_fips_5")
    return totals_by_year(
        county,
        {
            "aggregate_rows": _rows(),
            "distinct_county_fips_5": F.count_distinct(fips),
            "rows_with_null_state_fips_2": count_where(state.isNull()),
            "state_county_prefix_mismatches": count_where(F.substring(fips, 1, 2) != state),
        },
    )


def lender_panel_summary(lender: DataFrame) -> DataFrame:
    return _one_row(lender, {"row_count": _rows(), **_span(), **sums(*LENDER_TOTALS)})


def lender_panel_by_year(lender: DataFrame) -> DataFrame:
    """Year totals. Each distinct count has its own narrow pass over the panel, so no row is copied."""
    years = with_key(lender, ["activity_year"]).groupBy(KEY)
    main = years.agg(
        _rows().alias("lender_county_rows"),
        F.count_distinct("county_fips_5").alias("county_count"),
        *[m.alias(n) for n, m in sums(*LENDER_TOTALS).items()],
    )
    lenders = years.agg(F.count_distinct("lender_id").alias("lender_count"))
    return unpacked(main.join(lenders, KEY), ["activity_year"]).select(
        "activity_year", "lender_county_rows", "county_count", "lender_count", *LENDER_TOTALS
    )


def missing_lender_by_year(missing_lender: DataFrame) -> DataFrame:
    return totals_by_year(missing_lender, {"county_rows": _rows(), **sums("missing_lender_rows", "total_loan_amount")})
