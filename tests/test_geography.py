"""Truth table of the geography rules, and the shape of the plan."""

import pytest

from countyloom.operators.geography import GEO_COLUMNS, normalize_codes

PRE, POST = "pre_2018", "post_2018"
FILLED = "county_code_prefix_missing_or_unmapped_state_code"
OVERRIDE = "county_code_prefix_conflict_with_state_code"
PARTS, FULL = "state_county_components", "county_code_5"

CASES = [
    (PRE, "06", "037", "06", "state_code_numeric", False, "037", "06037", PARTS, False),
    (PRE, "6", "37", "06", "state_code_numeric", False, "037", "06037", PARTS, False),
    (PRE, " 6 ", " 37 ", "06", "state_code_numeric", False, "037", "06037", PARTS, False),
    (PRE, "NA", "NA ", None, "missing_state_code", False, None, None, "missing_county_code", False),
    (PRE, None, None, None, "missing_state_code", False, None, None, "missing_county_code", False),
    (PRE, "48", "NA ", "48", "state_code_numeric", False, None, None, "missing_county_code", False),
    (PRE, None, "037", None, "missing_state_code", False, "037", None, "unmapped_county_code", False),
    (PRE, "6", "0", "06", "state_code_numeric", False, "000", "06000", PARTS, False),
    (PRE, "99", "1", "99", "state_code_numeric", False, "001", "99001", PARTS, False),
    (PRE, "36", "06037", "36", "state_code_numeric", False, "037", "06037", FULL, True),
    (POST, "CA", "06037", "06", "state_code_abbr", False, "037", "06037", FULL, True),
    (POST, "ca", "06037", "06", "state_code_abbr", False, "037", "06037", FULL, True),
    (POST, "NA", "06037", "06", FILLED, True, "037", "06037", FULL, True),
    (POST, "ZZ", "06037", "06", FILLED, True, "037", "06037", FULL, True),
    (POST, "NY", "06037", "06", OVERRIDE, True, "037", "06037", FULL, True),
    (POST, "123", "06037", "06", FILLED, True, "037", "06037", FULL, True),
    (POST, "CA", "06000", "06", "state_code_abbr", False, None, None, "invalid_county_code_5", False),
    (POST, "CA", "99001", "06", "state_code_abbr", False, None, None, "invalid_county_code_5", False),
    (POST, "TX", "NA", "48", "state_code_abbr", False, None, None, "missing_county_code", False),
    (POST, "ZZ", "NA", None, "unmapped_state_code_abbr", False, None, None, "missing_county_code", False),
    (POST, "CAL", "37", None, "unmapped_state_code", False, "037", None, "unmapped_county_code", False),
    (POST, "CA", "37", "06", "state_code_abbr", False, "037", "06037", PARTS, False),
    (POST, "CA", "1234", "06", "state_code_abbr", False, None, None, "unmapped_county_code", False),
    (POST, "", "", None, "missing_state_code", False, None, None, "missing_county_code", False),
    # beyond the published table: text that only looks numeric, and wide characters
    (POST, "1\n", "3\n7", None, "unmapped_state_code", False, None, None, "unmapped_county_code", False),
    (PRE, "6", "é1", "06", "state_code_numeric", False, None, None, "unmapped_county_code", False),
]


@pytest.fixture(scope="module")
def normalised(spark):
    rows = spark.createDataFrame(
        [(i, *case[:3]) for i, case in enumerate(CASES)], "i int, source_era string, state_code string, county_code string"
    )
    return {r["i"]: tuple(r[c] for c in GEO_COLUMNS) for r in normalize_codes(rows, spark).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_truth_table(normalised, i):
    assert normalised[i] == CASES[i][3:]
