"""Physical plans: what must not be shuffled, expanded, collected or read."""

import re

import pytest
from pyspark.sql import functions as F

from countyloom.operators.geography import normalize_codes
from countyloom.operators.grouped import LARGE_GROUP
from countyloom.plans import canonical, panels


@pytest.fixture(autouse=True)
def whole_plan_strings(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", text))))


def test_geography_broadcasts_twice_and_never_shuffles(run):
    text = plan(run.loan_years_geo)
    assert text.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text
    assert "ObjectHash" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text


def test_loan_rows_have_one_branch_per_era(run):
    assert plan(run.loan_years).count("FileScan parquet") == 2


def test_panels_read_only_their_columns_and_build_no_json(run):
    text = run.loan_years_geo.select(*panels.COUNTY_KEYS, "loan_amount")._jdf.queryExecution().executedPlan().toString()
    assert "to_json" not in text.lower() and "structstojson" not in text.lower()
    measures = {**panels._denominators("total_records", "total_applications"), **panels._amounts()}
    text = plan(run.loan_years_geo.groupBy(*panels.COUNTY_KEYS).agg(*[m.alias(n) for n, m in measures.items()]))
    assert "structstojson" not in text.lower()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_county_panel_needs_no_expand(run):
    assert "Expand" not in plan(panels.county_year_lending(run.loan_years_geo, run.geo_cells))


def test_ordinary_lender_panel_is_one_aggregation(run):
    """No join and one shuffle, on stored rows that need no lookups."""
    assert run.county_year_lending.agg(F.max("total_records")).first()[0] < LARGE_GROUP
    text = plan(panels.lender_county_year(run.panel_rows, run.geo_cells))
    assert "Join" not in text and text.count("FileScan parquet") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert read_columns(text) == set(panels.ROW_COLUMNS)


def test_county_panel_shuffles_medians_once(run):
    """Two shuffles for the distinct lenders, one for the medians; the join reuses their partitioning."""
    text = plan(panels.county_year_lending(run.panel_rows, run.geo_cells))
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("ObjectHashAggregate") == 2 and "SortAggregate" not in text


def test_exclusion_tables_push_their_filter(run):
    text = plan(panels.county_year_missing_geo(run.panel_rows))
    assert "PushedFilters: [IsNull(county_fips_5)]" in text
    assert read_columns(text) == {"activity_year", "state_fips_2", "county_fips_5", "lender_id", "loan_amount"}


def test_geography_checks_read_code_cells(run):
    cells = normalize_codes(run.code_cells, run.spark)
    assert plan(cells).count("FileScan parquet") == 1
    assert all("/code_cells/" in f for f in cells.inputFiles())


def test_file_year_filters_prune_partitions(run):
    from countyloom.schemas import POST_2018, POST_2018_READ
    from countyloom.sources.files import read_era

    one_year = read_era(run.spark, run.annual_root, POST_2018, POST_2018_READ).where("file_year = 2019")
    assert re.search(r"PartitionFilters: \[[^\]]*file_year", plan(one_year))
    assert {r[0] for r in one_year.select("file_year").distinct().collect()} == {2019}
    assert not canonical.canonical(one_year, POST_2018).isEmpty()


def test_filters_on_panels_reach_the_scan(run):
    text = plan(run.county_year_lending.where("county_fips_5 = '06037'").select("total_records"))
    assert "PushedFilters: [IsNotNull(county_fips_5), EqualTo(county_fips_5,06037)]" in text
    assert read_columns(text) == {"county_fips_5", "total_records"}


@pytest.mark.parametrize("name", ["loan_years_geo", "county_year_lending", "lender_county_year", "export_lender_sample"])
def test_no_cross_joins(run, name):
    from countyloom.reports import REPORTS

    text = plan(REPORTS[name](run))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
