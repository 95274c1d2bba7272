"""Every loan row is accounted for; faults show up in the checks; edge inputs."""

from pyspark.sql import functions as F

from countyloom.operators.geography import code_cells, loan_years_geo, normalize_codes
from countyloom.plans import canonical, geography_reports, panels, quality, readiness

COLUMNS = (
    "activity_year int, source_era string, lender_id string, lender_id_type string, state_code string, county_code string, "
    "census_tract string, loan_amount double, loan_type string, loan_purpose string, occupancy_type string, "
    "action_taken string, applicant_income double, raw_source_columns string"
)


def loans(spark, *rows):
    """rows: (year, lender, state, county, amount, action)"""
    full = [
        (y, "pre_2018" if (y or 2010) < 2018 else "post_2018", lender, "lei", s, c, None, amount, "1", "1", "1", action, None, "{}")
        for y, lender, s, c, amount, action in rows
    ]
    return spark.createDataFrame(full, COLUMNS)


def one(frame):
    return frame.collect()[0]


def test_rows_are_in_a_panel_or_in_one_exclusion_table(run):
    total = run.loan_years.count()
    add = lambda table, column: table.agg(F.sum(column)).first()[0] or 0
    geo_missing = add(run.county_missing_geo, "missing_geo_rows")
    assert total == add(run.county_year_lending, "total_records") + geo_missing
    assert total == add(run.lender_county_year, "records") + add(run.lender_missing_lender, "missing_lender_rows") + add(
        run.lender_missing_geo, "missing_geo_rows"
    )
    assert total == add(run.code_cells, "row_count")


def test_all_differences_are_zero(run):
    for report in (
        quality.lender_panel_reconciliation(
            run.loan_years_geo, run.lender_county_year, run.lender_missing_lender, run.lender_missing_geo
        ),
        quality.county_reconciliation_by_year(run.loan_years_geo, run.county_year_lending, run.county_missing_geo),
        quality.county_reconciliation_total(run.loan_years_geo, run.county_year_lending, run.county_missing_geo),
    ):
        for row in report.collect():
            if row.asDict().get("activity_year", 0) is None:
                continue  # tables join on the year, so rows without one have nothing to compare with
            # Null: a table has no rows of that year.
            assert [v for k, v in row.asDict().items() if k.endswith("difference")] and all(
                v in (0, None) for k, v in row.asDict().items() if k.endswith("difference")
            )


def test_a_lost_row_and_a_doubled_row_are_detected(run):
    county = run.county_year_lending
    victim = county.where(F.col("state_fips_2").isNotNull() & F.col("activity_year").isNotNull()).orderBy("activity_year", "county_fips_5").limit(1)
    short = county.join(victim, ["activity_year", "state_fips_2", "county_fips_5"], "left_anti")
    report = quality.county_reconciliation_total(run.loan_years_geo, short, run.county_missing_geo)
    assert one(report)["included_difference"] == -one(victim)["total_records"]
    doubled = county.unionByName(victim)
    assert one(quality.county_duplicates(doubled))["duplicate_grain_rows"] == 1


def test_a_year_without_excluded_rows_stays_null_not_zero(spark):
    geo = loan_years_geo(loans(spark, (2010, "L", "06", "037", 1.0, "1"), (2011, "L", "06", "NA", 1.0, "1")), spark)
    report = quality.lender_panel_reconciliation(
        geo, panels.lender_county_year(geo), panels.lender_panel_missing_lender(geo), panels.lender_panel_missing_geo(geo)
    )
    by_year = {r["activity_year"]: r for r in report.collect()}
    assert by_year[2010]["missing_geo_difference"] is None and by_year[2010]["main_difference"] == 0
    assert by_year[2011]["main_difference"] is None and by_year[2011]["missing_geo_difference"] == 0
    assert by_year[2010]["missing_lender_difference"] == by_year[2011]["missing_lender_difference"] == 0


def test_denominators_are_independent(spark):
    rows = loans(spark, *[(2010, "L", "06", "037", 1.0, a) for a in ("1", "3", "6", " 8 ", "9", None)])
    row = one(panels.county_year_lending(loan_years_geo(rows, spark)))
    assert (row["total_records"], row["total_applications"]) == (6, 6)
    assert (row["application_records"], row["purchased_loans"]) == (3, 1)
    assert (row["originated_loans"], row["denied_applications"]) == (1, 1)


def test_amounts_and_lenders(spark):
    rows = loans(
        spark,
        (2010, "A", "06", "037", 1.0, "1"),
        (2010, "A", "06", "037", 2.0, "1"),
        (2010, " ", "06", "037", None, "1"),
        (2010, "B", "6", "37", 6.0, "1"),
        (2010, "A", "06", "039", None, "1"),
    )
    geo = loan_years_geo(rows, spark)
    county = {r["county_fips_5"]: r for r in panels.county_year_lending(geo).collect()}
    full, empty = county["06037"], county["06039"]
    assert (full["total_loan_amount"], full["average_loan_amount"], full["median_loan_amount"]) == (9.0, 3.0, 2.0)
    assert full["lender_count"] == 2
    assert (empty["total_loan_amount"], empty["average_loan_amount"], empty["median_loan_amount"]) == (None, None, None)
    lender = {(r["county_fips_5"], r["lender_id"]): r for r in panels.lender_county_year(geo).collect()}
    assert lender[("06037", "A")]["median_loan_amount"] == 1.5
    assert set(lender) == {("06037", "A"), ("06037", "B"), ("06039", "A")}
    assert one(panels.lender_panel_missing_lender(geo))["missing_lender_rows"] == 1


def test_lender_ids_are_grouped_untrimmed(spark):
    rows = loans(spark, (2010, "A", "06", "037", 1.0, "1"), (2010, "A ", "06", "037", 1.0, "1"))
    assert panels.lender_county_year(loan_years_geo(rows, spark)).count() == 2


def test_null_year_and_null_state_are_groups_of_their_own(spark):
    rows = loans(spark, (None, "A", "06", "037", 4.0, "1"), (2010, "A", None, "06037", 8.0, "1"))
    found = panels.county_year_lending(loan_years_geo(rows, spark)).collect()
    assert {(r["activity_year"], r["state_fips_2"], r["county_fips_5"], r["median_loan_amount"]) for r in found} == {
        (None, "06", "06037", 4.0),
        (2010, None, "06037", 8.0),
    }
    cells = code_cells(rows)
    assert {tuple(r) for r in canonical.year_summary(rows, cells).collect()} == {(None, 1, 1, 1, 1, 4.0), (2010, 1, 0, 0, 1, 8.0)}
    assert {tuple(r)[:4] for r in panels.lender_panel_by_year(panels.lender_county_year(loan_years_geo(rows, spark))).collect()} == {
        (None, 1, 1, 1),
        (2010, 1, 1, 1),
    }
    assert [tuple(r) for r in quality.invalid_years(cells).collect()] == [(None, 1)]


def test_empty_input(spark):
    rows = loans(spark, (2010, "A", "06", "037", 4.0, "1")).where("false")
    geo = loan_years_geo(rows, spark)
    county, lender = panels.county_year_lending(geo), panels.lender_county_year(geo)
    assert county.isEmpty() and lender.isEmpty()
    assert one(panels.county_panel_summary(county))["included_records"] is None
    assert one(quality.lender_key_checks(lender))["null_activity_year"] is None
    assert one(geography_reports.validation_totals(normalize_codes(code_cells(rows), spark)))["row_count"] == 0
    assert one(quality.lender_duplicates(lender))["duplicate_grain_rows"] == 0
    assert canonical.year_summary(rows, code_cells(rows)).isEmpty()


def test_action_counts_sort_numbers_before_text(spark):
    rows = loans(spark, *[(2010, "A", "06", "037", 1.0, a) for a in ("10", "9", "x", " ", None, "1")])
    assert [r["action_taken"] for r in readiness.action_counts(rows).collect()] == ["1", "9", "10", "<missing>", "x"]


def test_sampled_and_full_key_discovery_agree(run):
    full = {r["name"] for r in readiness.raw_source_keys(run.loan_years).collect()}
    assert full == {r["name"] for r in readiness.source_keys_by_era(run.loan_years).collect()}
    assert {"lei", "respondent_id"} <= full
