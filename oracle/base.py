"""Common table expressions shared by the SQL twins: derived loan rows, geography and the two panels.

Written for DuckDB. Nothing here is run by Spark. Counts use FILTER clauses and sums are cast, because the
engine widens integer sums.
"""

from __future__ import annotations

from oracle.constants import STATE_ROWS

_STATE_ROWS = ", ".join(f"({i}, '{f}', '{a}', '{n}')" for i, (f, a, n) in enumerate(STATE_ROWS))

XWALK = f"xwalk(pos, fips, abbr, name) AS (VALUES {_STATE_ROWS})"

# One record per line item. Empty text does not survive a CSV file: it comes back as null.
SRC = """
src AS (
  SELECT l_orderkey * 7 + l_linenumber AS h, CAST(year(o_orderdate) + 20 AS INTEGER) AS yr, fips AS fx, abbr AS ab,
         lpad(CAST(2 * (l_partkey % 12) + 1 AS VARCHAR), 3, '0') AS c3, l_linenumber AS ln,
         lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS supp10, lpad(CAST(l_suppkey AS VARCHAR), 17, '0') AS supp17,
         CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR) AS price_k,
         CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS price, l_partkey % 100 AS p100
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN xwalk ON (c_nationkey + 25 * (c_custkey % 3)) % 56 = pos
)"""

RAW_PRE = """
raw_pre AS (
  SELECT yr AS file_year, CASE WHEN h % 127 = 0 THEN NULL WHEN h % 131 = 0 THEN '2031' WHEN h % 137 = 0 THEN yr || '.4'
         WHEN h % 139 = 0 THEN CAST(yr + 1 AS VARCHAR) ELSE CAST(yr AS VARCHAR) END AS as_of_year,
    CASE WHEN h % 97 = 0 THEN NULL WHEN h % 89 = 0 THEN ' ' ELSE supp10 END AS respondent_id,
    CASE WHEN h % 41 = 0 THEN 'NA' WHEN h % 43 = 0 THEN NULL WHEN h % 37 = 0 THEN 'ZZ'
         WHEN h % 47 = 0 THEN chr(160) || fx WHEN h % 2 = 0 AND fx < '10' THEN right(fx, 1) ELSE fx END AS state_code,
    CASE WHEN h % 31 = 0 THEN 'NA ' WHEN h % 61 = 0 THEN NULL WHEN h % 67 = 0 THEN '1234'
         WHEN h % 79 = 0 THEN fx || c3 WHEN h % 83 = 0 THEN '0' ELSE c3 END AS county_code,
    CAST(1000 + p100 AS VARCHAR) || '.00' AS census_tract_number,
    CASE WHEN h % 101 = 0 THEN ' ' WHEN h % 29 = 0 THEN '1_' || lpad(CAST(p100 AS VARCHAR), 3, '0')
         WHEN h % 23 = 0 THEN price_k || '.25' ELSE price_k END AS loan_amount_000s,
    CASE WHEN h % 107 = 0 THEN NULL ELSE CAST(1 + ln % 5 AS VARCHAR) END AS loan_type,
    CASE WHEN h % 109 = 0 THEN NULL ELSE CAST(1 + h % 3 AS VARCHAR) END AS loan_purpose,
    CAST(1 + h % 3 AS VARCHAR) AS owner_occupancy,
    CASE WHEN h % 103 = 0 THEN NULL WHEN h % 113 = 0 THEN '9' ELSE CAST(1 + h % 8 AS VARCHAR) END AS action_taken,
    CASE WHEN h % 11 = 0 THEN 'NA' ELSE CAST(20 + h % 200 AS VARCHAR) END AS applicant_income_000s
  FROM src WHERE yr <= 2017
)"""

RAW_POST = """
raw_post AS (
  SELECT yr AS file_year, CASE WHEN h % 127 = 0 THEN NULL WHEN h % 131 = 0 THEN '2031' WHEN h % 137 = 0 THEN '2_0' || right(CAST(yr AS VARCHAR), 2)
         WHEN h % 139 = 0 THEN CAST(yr + 1 AS VARCHAR) ELSE CAST(yr AS VARCHAR) END AS raw_activity_year,
    CASE WHEN h % 97 = 0 OR h % 89 = 0 THEN NULL ELSE 'LEI' || supp17 END AS lei,
    CASE WHEN h % 41 = 0 THEN 'NA' WHEN h % 43 = 0 THEN NULL WHEN h % 37 = 0 THEN 'ZZ' WHEN h % 53 = 0 THEN 'NY'
         WHEN h % 59 = 0 THEN lower(ab) WHEN h % 47 = 0 THEN chr(160) || ab || chr(160) ELSE ab END AS state_code,
    CASE WHEN h % 31 = 0 THEN 'NA' WHEN h % 61 = 0 THEN NULL WHEN h % 67 = 0 THEN '1234'
         WHEN h % 71 = 0 THEN fx || '000' WHEN h % 73 = 0 THEN '99' || c3 WHEN h % 83 = 0 THEN c3
         ELSE fx || c3 END AS county_code,
    fx || c3 || '0' || CAST(10000 + p100 AS VARCHAR) AS census_tract,
    CASE WHEN h % 101 = 0 THEN NULL WHEN h % 29 = 0 THEN '1_' || lpad(CAST(p100 AS VARCHAR), 3, '0') || '.0'
         WHEN h % 23 = 0 THEN price || '.5' ELSE price || '.0' END AS loan_amount,
    CASE WHEN h % 107 = 0 THEN NULL ELSE CAST(1 + ln % 5 AS VARCHAR) END AS loan_type,
    ['1', '2', '31', '32', '4', '5', '9'][1 + h % 7] AS loan_purpose,
    CAST(1 + h % 3 AS VARCHAR) AS occupancy_type,
    CASE WHEN h % 103 = 0 THEN NULL WHEN h % 113 = 0 THEN '9' ELSE CAST(1 + h % 8 AS VARCHAR) END AS action_taken,
    CASE WHEN h % 11 = 0 THEN 'NA' ELSE CAST(20 + h % 200 AS VARCHAR) END AS income
  FROM src WHERE yr > 2017
)"""

LOAN_YEARS = """
loan_years AS (
  SELECT TRY_CAST(as_of_year AS INTEGER) AS activity_year, 'pre_2018' AS source_era, respondent_id AS lender_id,
    'respondent_id' AS lender_id_type, state_code, county_code, census_tract_number AS census_tract,
    TRY_CAST(nullif(trim(loan_amount_000s), '') AS DOUBLE) * 1000 AS loan_amount, loan_type, loan_purpose,
    owner_occupancy AS occupancy_type, action_taken,
    TRY_CAST(nullif(trim(applicant_income_000s), '') AS DOUBLE) AS applicant_income,
    CAST(json_object('as_of_year', as_of_year, 'respondent_id', respondent_id, 'loan_amount_000s', loan_amount_000s,
      'owner_occupancy', owner_occupancy, 'applicant_income_000s', applicant_income_000s,
      'census_tract_number', census_tract_number) AS VARCHAR) AS raw_source_columns
  FROM raw_pre
  UNION ALL
  SELECT TRY_CAST(raw_activity_year AS INTEGER), 'post_2018', lei, 'lei', state_code, county_code, census_tract,
    TRY_CAST(nullif(trim(loan_amount), '') AS DOUBLE), loan_type, loan_purpose, occupancy_type, action_taken,
    TRY_CAST(nullif(trim(income), '') AS DOUBLE),
    CAST(json_object('raw_activity_year', raw_activity_year, 'lei', lei, 'loan_amount', loan_amount,
      'occupancy_type', occupancy_type, 'income', income, 'census_tract', census_tract) AS VARCHAR)
  FROM raw_post
)"""

# Nested steps: cleaned codes and lookups, the state decision, then the county columns.
GEO = """
looked_up AS (
  SELECT l.*, upper(trim(l.state_code)) AS s, upper(trim(l.county_code)) AS c,
    CASE WHEN regexp_full_match(upper(trim(l.county_code)), '[0-9]{5}') THEN left(upper(trim(l.county_code)), 2) END AS pre2
  FROM loan_years l
),
placed AS (
  SELECT u.*,
    CASE WHEN s IS NULL OR s IN ('', 'NA') THEN NULL WHEN regexp_full_match(s, '[0-9]{1,2}') THEN lpad(s, 2, '0')
         WHEN regexp_full_match(s, '[A-Z]{2}') THEN a.fips END AS own,
    CASE WHEN s IS NULL OR s IN ('', 'NA') THEN 'missing_state_code'
         WHEN regexp_full_match(s, '[0-9]{1,2}') THEN 'state_code_numeric'
         WHEN regexp_full_match(s, '[A-Z]{2}') THEN if(a.fips IS NULL, 'unmapped_state_code_abbr', 'state_code_abbr')
         ELSE 'unmapped_state_code' END AS own_source,
    p.fips IS NOT NULL AND right(c, 3) <> '000' AS county_fips_5_valid_state_prefix
  FROM looked_up u LEFT JOIN xwalk a ON s = a.abbr LEFT JOIN xwalk p ON pre2 = p.fips
),
stated AS (
  SELECT *,
    source_era = 'post_2018' AND county_fips_5_valid_state_prefix AND own IS DISTINCT FROM pre2
      AS state_fips_2_from_county_prefix,
    if(state_fips_2_from_county_prefix, pre2, own) AS state_fips_2,
    CASE WHEN NOT state_fips_2_from_county_prefix THEN own_source
         WHEN own IS NULL THEN 'county_code_prefix_missing_or_unmapped_state_code'
         ELSE 'county_code_prefix_conflict_with_state_code' END AS state_fips_2_source,
    coalesce(regexp_full_match(c, '[0-9]{1,3}'), false) AS part
  FROM placed
),
loan_years_geo AS (
  SELECT activity_year, source_era, lender_id, lender_id_type, state_code, county_code, state_fips_2,
    state_fips_2_source, state_fips_2_from_county_prefix,
    CASE WHEN county_fips_5_valid_state_prefix THEN right(c, 3) WHEN part THEN lpad(c, 3, '0') END AS county_fips_3,
    CASE WHEN county_fips_5_valid_state_prefix THEN c WHEN part THEN state_fips_2 || lpad(c, 3, '0') END AS county_fips_5,
    CASE WHEN county_fips_5_valid_state_prefix THEN 'county_code_5'
         WHEN part AND state_fips_2 IS NOT NULL THEN 'state_county_components'
         WHEN c IS NULL OR c IN ('', 'NA') THEN 'missing_county_code'
         WHEN pre2 IS NOT NULL THEN 'invalid_county_code_5' ELSE 'unmapped_county_code' END AS county_fips_5_source,
    county_fips_5_valid_state_prefix, census_tract, loan_amount, loan_type, loan_purpose, occupancy_type, action_taken,
    applicant_income, raw_source_columns
  FROM stated
)"""


def rows(name: str, condition: str = "") -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}" if condition else f"count(*) AS {name}"


def total(column: str, name: str | None = None) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {name or column}"


def action(name: str, *codes: str) -> str:
    return rows(name, f"trim(action_taken) IN ({', '.join(repr(c) for c in codes)})")


HAS_LENDER = "coalesce(trim(lender_id), '') <> ''"
LENDERS = f"count(DISTINCT lender_id) FILTER (WHERE {HAS_LENDER})"
_OUTCOMES = [
    action("application_records", "1", "2", "3", "4", "5", "7", "8"),
    action("purchased_loans", "6"),
]
_ENDS = [action("originated_loans", "1"), action("denied_applications", "3")]
_AMOUNTS = [
    "sum(loan_amount) AS total_loan_amount",
    "avg(loan_amount) AS average_loan_amount",
    "median(loan_amount) AS median_loan_amount",
]


def _codes(column: str, codes: list[str]) -> list[str]:
    listed = ", ".join(repr(c) for c in codes)
    return [rows(f"{column}_{c}_count", f"trim({column}) = '{c}'") for c in codes] + [
        rows(f"{column}_other_count", f"coalesce(trim({column}), '?') NOT IN ({listed})")
    ]


def _cte(name: str, select: list[str], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(select)} FROM {source})"


COUNTY = _cte(
    "county",
    ["activity_year", "state_fips_2", "county_fips_5", rows("total_records"), *_OUTCOMES, rows("total_applications"), *_ENDS, *_AMOUNTS, f"{LENDERS} AS lender_count"],
    "loan_years_geo WHERE county_fips_5 IS NOT NULL GROUP BY ALL",
)

COUNTY_MISSING = _cte(
    "county_missing",
    ["activity_year", rows("missing_geo_rows"), rows("missing_state_fips_2", "state_fips_2 IS NULL"), rows("missing_county_fips_5", "county_fips_5 IS NULL"), f"{LENDERS} AS lender_count", "sum(loan_amount) AS total_loan_amount"],
    "loan_years_geo WHERE county_fips_5 IS NULL GROUP BY ALL",
)

LENDER = _cte(
    "lender",
    [
        "activity_year", "state_fips_2", "county_fips_5", "lender_id", "min(lender_id_type) AS lender_id_type",
        rows("records"), *_OUTCOMES, rows("applications"), *_ENDS, *_AMOUNTS,
        *_codes("loan_type", ["1", "2", "3", "4"]),
        *_codes("loan_purpose", ["1", "2", "3", "31", "32", "4", "5"]),
    ],
    f"loan_years_geo WHERE county_fips_5 IS NOT NULL AND {HAS_LENDER} GROUP BY ALL",
)

NO_LENDER = _cte(
    "no_lender",
    ["activity_year", "state_fips_2", "county_fips_5", rows("missing_lender_rows"), *_ENDS, "sum(loan_amount) AS total_loan_amount"],
    f"loan_years_geo WHERE county_fips_5 IS NOT NULL AND NOT ({HAS_LENDER}) GROUP BY ALL",
)

LENDER_MISSING = _cte(
    "lender_missing",
    [
        "activity_year", rows("missing_geo_rows"), rows("missing_state_fips_2", "state_fips_2 IS NULL"),
        rows("missing_county_fips_5", "county_fips_5 IS NULL"), rows("missing_lender_id", f"NOT ({HAS_LENDER})"),
        f"{LENDERS} AS distinct_lenders", *_ENDS, "sum(loan_amount) AS total_loan_amount",
    ],
    "loan_years_geo WHERE county_fips_5 IS NULL GROUP BY ALL",
)

# Stored columns of an annual file, per era, in the engine's simple type names.
PRE_COLUMNS = (
    "activity_year source_era lei_or_respondent_id as_of_year respondent_id state_code county_code census_tract_number "
    "loan_amount_000s loan_type loan_purpose owner_occupancy action_taken applicant_income_000s"
).split()
POST_COLUMNS = (
    "activity_year source_era lei_or_respondent_id raw_activity_year lei state_code county_code census_tract "
    "loan_amount loan_type loan_purpose occupancy_type action_taken income"
).split()


def _values(columns: list[str]) -> str:
    return ", ".join(f"('{c}')" for c in columns)


def _filled(kind: str, columns: list[str], typed: dict[str, str]) -> str:
    """Values of each stored column of an era, by year of the file."""
    return " UNION ALL ".join(
        f"SELECT file_year AS activity_year, '{c}' AS column_name, count({typed.get(c, c)}) AS non_null_rows FROM raw_{kind} GROUP BY 1"
        for c in columns
    )


SCHEMA_ROWS = f"""
years AS (SELECT DISTINCT yr FROM src),
schema_rows AS (
  SELECT activity_year, column_name, if(column_name = 'activity_year', 'int', 'string') AS column_type, true AS nullable, non_null_rows
  FROM ({_filled("pre", PRE_COLUMNS, {"activity_year": "TRY_CAST(as_of_year AS INTEGER)", "source_era": "1", "lei_or_respondent_id": "respondent_id"})}
    UNION ALL {_filled("post", POST_COLUMNS, {"activity_year": "TRY_CAST(raw_activity_year AS INTEGER)", "source_era": "1", "lei_or_respondent_id": "lei"})})
)"""

# The copy in which odd years store some columns as numbers: these rows replace those of the same year and column.
DRIFTED_ROWS = """
retyped AS (
  SELECT file_year AS activity_year, 'applicant_income_000s' AS column_name, 'double' AS column_type,
    count(TRY_CAST(nullif(trim(applicant_income_000s), '') AS DOUBLE)) AS non_null_rows
  FROM raw_pre WHERE file_year % 2 = 1 GROUP BY 1
  UNION ALL SELECT file_year, 'income', 'double', count(TRY_CAST(nullif(trim(income), '') AS DOUBLE)) FROM raw_post WHERE file_year % 2 = 1 GROUP BY 1
  UNION ALL SELECT file_year, 'loan_type', 'int', count(TRY_CAST(loan_type AS INTEGER))
  FROM (SELECT file_year, loan_type FROM raw_pre UNION ALL SELECT file_year, loan_type FROM raw_post) WHERE file_year % 2 = 1 GROUP BY 1
  UNION ALL SELECT file_year, 'action_taken', kind, if(kind = 'int', count(*) FILTER (WHERE action_taken = '1'), count(*) FILTER (WHERE action_taken <> '1'))
  FROM (SELECT file_year, action_taken FROM raw_pre UNION ALL SELECT file_year, action_taken FROM raw_post),
    (VALUES ('int'), ('string')) kinds(kind) WHERE file_year % 2 = 1 GROUP BY 1, 3
),
drifted AS (
  SELECT activity_year, column_name, column_type, true AS nullable, non_null_rows FROM retyped
  UNION ALL SELECT * FROM schema_rows s
  WHERE NOT EXISTS (SELECT 1 FROM retyped r WHERE r.activity_year = s.activity_year AND r.column_name = s.column_name)
)"""

_CHAIN = {
    "raw": [XWALK, SRC, RAW_PRE, RAW_POST],
    "loan_years": [XWALK, SRC, RAW_PRE, RAW_POST, LOAN_YEARS],
    "geo": [XWALK, SRC, RAW_PRE, RAW_POST, LOAN_YEARS, GEO],
    "schema": [XWALK, SRC, RAW_PRE, RAW_POST, SCHEMA_ROWS],
    "drifted": [XWALK, SRC, RAW_PRE, RAW_POST, SCHEMA_ROWS, DRIFTED_ROWS],
}


def query(base: str, select: str, *extra: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in [*_CHAIN[base], *extra]) + "\n" + select.strip()
