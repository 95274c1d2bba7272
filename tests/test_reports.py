"""Every registered report against its SQL twin."""

import compare
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
import oracle
from countyloom.plans.pipeline import Run
from countyloom.reports import REPORTS

QUERIES = {name: query for name, query in contract.queries().items() if name in REPORTS}
SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_report_has_a_twin():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() == REPORTS.keys() and len(QUERIES) >= 67


@pytest.mark.parametrize("name", list(QUERIES))
def test_report_matches_its_twin(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:3] == ["activity_year", "state_fips_2", "county_fips_5"]
    assert not frame.isEmpty()


def test_objects_are_counted_without_building_the_panels(spark, run, tmp_path):
    fresh = Run(spark, run.annual_root, str(tmp_path), run.sources)
    found = {r["table_name"]: r["row_count"] for r in REPORTS["qa_objects"](fresh).collect()}
    assert found == {
        "loan_years": run.loan_years.count(),
        "loan_years_geo": run.loan_years_geo.count(),
        "county_year_lending": run.county_year_lending.count(),
        "lender_county_year": run.lender_county_year.count(),
        "year_summary": run.year_summary.count(),
    }
    assert [p.name for p in tmp_path.iterdir()] == ["code_cells"]
