"""One SQL statement per report."""

from __future__ import annotations

from oracle.base import (
    COUNTY,
    COUNTY_MISSING,
    HAS_LENDER,
    LENDER,
    LENDER_MISSING,
    LENDERS,
    NO_LENDER,
    POST_COLUMNS,
    PRE_COLUMNS,
    query,
    rows,
    total,
)
from oracle.constants import ACTIONS, COLUMNS, KEY_FIELDS


def _list(*parts: str) -> str:
    return ", ".join(parts)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _blank(c: str) -> str:
    return f"coalesce(trim({c}), '') = ''"


def _na(c: str) -> str:
    return f"coalesce(upper(trim({c})), '') IN ('', 'NA')"


def _match(c: str, pattern: str) -> str:
    return f"regexp_full_match(trim({c}), '{pattern}')"


EXAMPLES = (
    "activity_year, source_era, state_code, county_code, state_fips_2, state_fips_2_source, "
    "state_fips_2_from_county_prefix, county_fips_3, county_fips_5, county_fips_5_source, "
    "county_fips_5_valid_state_prefix"
)
GEO_CHECKS = _list(
    rows("row_count"),
    rows("missing_state_fips_2", "state_fips_2 IS NULL"),
    rows("missing_county_fips_5", "county_fips_5 IS NULL"),
    rows("county_present_state_missing", "county_fips_5 IS NOT NULL AND state_fips_2 IS NULL"),
    rows("state_county_prefix_mismatches", "left(county_fips_5, 2) <> state_fips_2"),
    rows("state_from_county_prefix_rows", "state_fips_2_from_county_prefix"),
    "count(DISTINCT state_fips_2) AS distinct_states_normalized",
    "count(DISTINCT county_fips_5) AS distinct_counties_normalized",
)
COUNTY_SUMS = _list(
    *[
        total(c)
        for c in (
            "total_records",
            "application_records",
            "purchased_loans",
            "total_applications",
            "originated_loans",
            "denied_applications",
        )
    ],
    "sum(total_loan_amount) AS total_loan_amount",
)
LENDER_SUMS = _list(
    *[
        total(c)
        for c in (
            "records",
            "application_records",
            "purchased_loans",
            "applications",
            "originated_loans",
            "denied_applications",
        )
    ],
    "sum(total_loan_amount) AS total_loan_amount",
)
SPAN = "min(activity_year) AS min_year, max(activity_year) AS max_year"
SPLIT = _list(
    rows("loan_years_geo_rows"),
    rows("expected_included_records", "county_fips_5 IS NOT NULL"),
    rows("expected_excluded_missing_geo", "county_fips_5 IS NULL"),
)
SPLIT_DIFFERENCES = """
  loan_years_geo_rows, expected_included_records, a AS aggregate_included_records,
  a - expected_included_records AS included_difference, expected_excluded_missing_geo,
  m AS qa_excluded_missing_geo, m - expected_excluded_missing_geo AS excluded_difference"""

STATE_NAME = "(SELECT name FROM xwalk WHERE fips = state_fips_2) AS state_name"

SAMPLE = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY activity_year ORDER BY state_fips_2 NULLS LAST, county_fips_5, lender_id) AS pos
  FROM lender
),
sample AS (
  SELECT * EXCLUDE (pos) FROM ranked
  WHERE pos <= ceil(100000 / (SELECT count(DISTINCT activity_year) FROM lender))
  ORDER BY activity_year, state_fips_2 NULLS LAST, county_fips_5, lender_id LIMIT 100000
)"""


def _annual_columns() -> str:
    """Every column of both eras, with nulls where an era lacks one."""
    names = list(dict.fromkeys([*PRE_COLUMNS, *POST_COLUMNS]))
    source = {
        "pre": {"activity_year": "TRY_CAST(as_of_year AS INTEGER)", "source_era": "'pre_2018'", "lei_or_respondent_id": "respondent_id"},
        "post": {"activity_year": "TRY_CAST(raw_activity_year AS INTEGER)", "source_era": "'post_2018'", "lei_or_respondent_id": "lei"},
    }

    def side(kind: str, own: list[str]) -> str:
        cells = [f"{source[kind].get(n, n) if n in own else 'CAST(NULL AS VARCHAR)'} AS {n}" for n in names]
        return f"SELECT {', '.join(cells)}, file_year FROM raw_{kind}"

    return side("pre", PRE_COLUMNS) + " UNION ALL " + side("post", POST_COLUMNS)


def _key_fields() -> str:
    values = ", ".join(f"({i}, '{f}', '{c}')" for f, names in KEY_FIELDS.items() for i, c in enumerate(names))
    return f"""
SELECT logical_field, yr AS activity_year, count(s.column_name) > 0 AS present,
  coalesce(string_agg(s.column_name, ',' ORDER BY pos), '') AS columns,
  CAST(coalesce(sum(non_null_rows), 0) AS BIGINT) AS non_null_rows
FROM years CROSS JOIN (VALUES {values}) k(pos, logical_field, candidate)
LEFT JOIN schema_rows s ON s.activity_year = yr AND s.column_name = candidate
GROUP BY logical_field, yr"""


def _drifted(out: dict[str, str]) -> dict[str, str]:
    """The schema audit again, over the copy whose columns change their type; a column of two types counts once a year."""
    per_column = "schema_rows AS (SELECT activity_year, column_name, CAST(sum(non_null_rows) AS BIGINT) AS non_null_rows FROM drifted GROUP BY 1, 2)"
    bodies = {n: out[f"schema_{n}"].removeprefix(query("schema", "")) for n in ("years_for_column", "column_counts", "common_columns", "era_only_columns", "key_field_availability", "type_differences")}
    types = bodies.pop("type_differences")
    found = {f"drift_{n}": query("drifted", f"SELECT * FROM (WITH {per_column} {body})") for n, body in bodies.items()}
    found["drift_type_differences"] = query("drifted", f"SELECT * FROM (WITH schema_rows AS (SELECT * FROM drifted) {types})")
    found["drift_schema_by_year"] = query("drifted", "SELECT * FROM drifted")
    return found


def _column_usage() -> str:
    meta = ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in COLUMNS)
    counts = " UNION ALL ".join(f"SELECT '{c[0]}' AS column_name, count({c[0]}) AS non_null_rows FROM loan_years" for c in COLUMNS)
    return f"""
SELECT m.*, 'all' AS source_era, (SELECT min(yr) || '-' || max(yr) FROM src) AS valid_years, non_null_rows
FROM (VALUES {meta}) m(column_name, data_type, source_columns, description, notes)
JOIN ({counts}) USING (column_name)"""


def _action_usage() -> str:
    values = ", ".join(
        f"('{era}', '{code}', {_text(text)}, {str(code == '1').lower()}, {str(code == '3').lower()})"
        for era in ("pre_2018", "post_2018")
        for code, text in ACTIONS
    )
    return f"""
SELECT m.*, (SELECT count(*) FROM loan_years l WHERE l.source_era = m.source_era AND trim(l.action_taken) = m.action_taken) AS row_count
FROM (VALUES {values}) m(source_era, action_taken, action_description, counts_as_origination, counts_as_denial)"""


def statements() -> dict[str, str]:
    county_panel = (COUNTY,)
    lender_panel = (LENDER,)
    ledger = "ledger AS (SELECT yr AS year, count(*) AS row_count FROM src GROUP BY yr)"
    out = {
        # ingest and canonical rows
        "ingest_annual": query("raw", _annual_columns()),
        "ingest_incremental": query(
            "raw",
            """SELECT year, if(year <= 2017, 'pre_2018', 'post_2018') AS source_era,
               if(year % 2 = 0, 'skipped_existing', 'converted') AS conversion_status, row_count FROM ledger""",
            ledger,
        ),
        "ingest_validation": query(
            "raw",
            """SELECT year, row_count, row_count > 0 AS row_count_gt_zero, true AS parquet_exists, true AS query_ok, true AS activity_year_present,
               'state_code,county_code' AS geography_fields, '' AS geography_unmapped,
               if(year <= 2017, 'respondent_id', 'lei') || ',lei_or_respondent_id' AS lender_identifier_fields,
               false AS lender_identifier_unmapped, true AS expected_columns_present, row_count > 0 AS passed FROM ledger""",
            ledger,
        ),
        "loan_years": query("loan_years", "SELECT * FROM loan_years"),
        "column_metadata": query("loan_years", _column_usage()),
        "year_summary": query(
            "loan_years",
            f"""SELECT activity_year, count(*) AS row_count,
              count(DISTINCT state_code) FILTER (WHERE NOT {_blank("state_code")}) AS state_count,
              count(DISTINCT state_code || '-' || county_code)
                FILTER (WHERE NOT {_blank("state_code")} AND NOT {_blank("county_code")}) AS county_count,
              {LENDERS} AS lender_count, sum(loan_amount) AS total_loan_amount
            FROM loan_years GROUP BY activity_year""",
        ),
        "build_log": query(
            "loan_years",
            """SELECT 'years' AS key, '[' || string_agg(CAST(year AS VARCHAR), ', ' ORDER BY year) || ']' AS value FROM ledger
            UNION ALL SELECT 'objects_created', '["loan_years", "column_metadata", "year_summary", "build_log"]'
            UNION ALL SELECT 'loan_years_kind', 'VIEW'
            UNION ALL SELECT 'year_summary_years', CAST(count(*) AS VARCHAR) FROM (SELECT 1 FROM loan_years GROUP BY activity_year)
            UNION ALL SELECT 'year_summary_total_rows', CAST(sum(row_count) AS VARCHAR) FROM ledger
            UNION ALL SELECT 'notes', '["loan_years is a view over the annual dataset."]'""",
            ledger,
        ),
        # geography
        "state_fips_crosswalk": query(
            "geo",
            """SELECT fips AS state_fips, abbr AS state_abbr, name AS state_name,
              (SELECT count(*) FROM loan_years_geo WHERE state_fips_2 = fips) AS row_count FROM xwalk""",
        ),
        "loan_years_geo": query("geo", "SELECT * FROM loan_years_geo"),
        "geo_raw_formats": query(
            "loan_years",
            "SELECT activity_year, source_era, "
            + _list(
                rows("row_count"),
                f"count(DISTINCT state_code) FILTER (WHERE NOT {_blank('state_code')}) AS distinct_state_values",
                f"count(DISTINCT county_code) FILTER (WHERE NOT {_blank('county_code')}) AS distinct_county_values",
                rows("state_numeric_1_2", _match("state_code", "[0-9]{1,2}")),
                rows("state_alpha_2", _match("state_code", "[A-Z]{2}")),
                rows("state_missing_or_na", _na("state_code")),
                rows("county_numeric_1_3", _match("county_code", "[0-9]{1,3}")),
                rows("county_numeric_5", _match("county_code", "[0-9]{5}")),
                rows("county_missing_or_na", _na("county_code")),
            )
            + " FROM loan_years GROUP BY activity_year, source_era",
        ),
        "geo_validation_by_year": query(
            "geo", f"SELECT activity_year, {GEO_CHECKS} FROM loan_years_geo GROUP BY activity_year"
        ),
        "geo_validation_totals": query("geo", f"SELECT {GEO_CHECKS} FROM loan_years_geo"),
        "geo_unmapped_examples": query(
            "geo",
            f"""SELECT {EXAMPLES}, count(*) AS row_count FROM loan_years_geo
            WHERE state_fips_2 IS NULL OR county_fips_5 IS NULL GROUP BY ALL
            ORDER BY row_count DESC, {", ".join(c.strip() + " NULLS LAST" for c in EXAMPLES.split(","))} LIMIT 30""",
        ),
        "geo_sample_mappings": query(
            "geo",
            f"""SELECT {EXAMPLES}, count(*) AS row_count FROM loan_years_geo
            WHERE state_fips_2 IS NOT NULL AND county_fips_5 IS NOT NULL GROUP BY ALL
            ORDER BY activity_year NULLS LAST, row_count DESC,
              {", ".join(c.strip() + " NULLS LAST" for c in EXAMPLES.split(",")[1:])} LIMIT 40""",
        ),
        "geo_source_flags": query(
            "geo",
            """SELECT activity_year, source_era, state_fips_2_source, county_fips_5_source, count(*) AS row_count
            FROM loan_years_geo GROUP BY ALL""",
        ),
        # panels and exclusion tables
        "county_year_lending": query("geo", "SELECT * FROM county", *county_panel),
        "county_year_missing_geo_qa": query("geo", "SELECT * FROM county_missing", COUNTY_MISSING),
        "action_taken_metadata": query("loan_years", _action_usage()),
        "county_panel_summary": query(
            "geo",
            f"""SELECT count(*) AS aggregate_row_count, {SPAN}, {total("total_applications", "included_applications")},
              {total("total_records", "included_records")}, {total("application_records", "included_application_records")},
              {total("purchased_loans")}, {total("originated_loans")}, {total("denied_applications")} FROM county""",
            *county_panel,
        ),
        "county_panel_by_year": query(
            "geo",
            f"SELECT activity_year, count(*) AS county_count, {COUNTY_SUMS} FROM county GROUP BY activity_year",
            *county_panel,
        ),
        "county_panel_geo_consistency": query(
            "geo",
            f"""SELECT activity_year, count(*) AS aggregate_rows, count(DISTINCT county_fips_5) AS distinct_county_fips_5,
              {rows("rows_with_null_state_fips_2", "state_fips_2 IS NULL")},
              {rows("state_county_prefix_mismatches", "left(county_fips_5, 2) <> state_fips_2")}
            FROM county GROUP BY activity_year""",
            *county_panel,
        ),
        "lender_county_year": query("geo", "SELECT * FROM lender", *lender_panel),
        "lender_panel_missing_lender_qa": query("geo", "SELECT * FROM no_lender", NO_LENDER),
        "lender_panel_missing_geo_qa": query("geo", "SELECT * FROM lender_missing", LENDER_MISSING),
        "lender_panel_summary": query(
            "geo", f"SELECT count(*) AS row_count, {SPAN}, {LENDER_SUMS} FROM lender", *lender_panel
        ),
        "lender_panel_by_year": query(
            "geo",
            f"""SELECT activity_year, count(*) AS lender_county_rows, count(DISTINCT county_fips_5) AS county_count,
              count(DISTINCT lender_id) AS lender_count, {LENDER_SUMS} FROM lender GROUP BY activity_year""",
            *lender_panel,
        ),
        "lender_panel_key_checks": query(
            "geo",
            "SELECT "
            + _list(
                *[rows(f"null_{k}", f"{k} IS NULL") for k in ("activity_year", "state_fips_2", "county_fips_5")],
                rows("null_or_blank_lender_id", _blank("lender_id")),
            )
            + " FROM lender",
            *lender_panel,
        ),
        "lender_panel_duplicates": query(
            "geo",
            """SELECT count(*) AS duplicate_grain_rows FROM (SELECT count(*) AS n FROM lender
            GROUP BY activity_year, state_fips_2, county_fips_5, lender_id HAVING n > 1)""",
            *lender_panel,
        ),
        "lender_panel_reconciliation": query(
            "geo",
            f"""SELECT s.activity_year, expected_main_rows, main_records, main_records - expected_main_rows AS main_difference,
              expected_missing_lender_rows, coalesce(q, 0) AS qa_missing_lender_rows,
              coalesce(q, 0) - expected_missing_lender_rows AS missing_lender_difference,
              expected_missing_geo_rows, qa_missing_geo_rows,
              qa_missing_geo_rows - expected_missing_geo_rows AS missing_geo_difference
            FROM (SELECT activity_year, {rows("expected_main_rows", f"county_fips_5 IS NOT NULL AND {HAS_LENDER}")},
                    {rows("expected_missing_lender_rows", f"county_fips_5 IS NOT NULL AND NOT ({HAS_LENDER})")},
                    {rows("expected_missing_geo_rows", "county_fips_5 IS NULL")}
                  FROM loan_years_geo GROUP BY activity_year) s
            LEFT JOIN (SELECT activity_year, {total("records", "main_records")} FROM lender GROUP BY 1) USING (activity_year)
            LEFT JOIN (SELECT activity_year, {total("missing_lender_rows", "q")} FROM no_lender GROUP BY 1) USING (activity_year)
            LEFT JOIN (SELECT activity_year, {total("missing_geo_rows", "qa_missing_geo_rows")} FROM lender_missing GROUP BY 1)
              USING (activity_year)""",
            LENDER,
            NO_LENDER,
            LENDER_MISSING,
        ),
        "lender_panel_missing_lender_by_year": query(
            "geo",
            f"""SELECT activity_year, count(*) AS county_rows, {total("missing_lender_rows")},
            sum(total_loan_amount) AS total_loan_amount FROM no_lender GROUP BY activity_year""",
            NO_LENDER,
        ),
        # quality of the loan rows
        "qa_row_reconciliation": query(
            "loan_years",
            """SELECT *, loan_years_total_rows = metadata_total_rows AS row_count_matches_metadata FROM (
              SELECT (SELECT count(*) FROM loan_years) AS loan_years_total_rows,
                CAST(sum(row_count) AS BIGINT) AS metadata_total_rows,
                string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS metadata_years,
                (SELECT string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) FROM (SELECT DISTINCT activity_year AS y FROM loan_years))
                  AS loan_years_years,
                (SELECT list(DISTINCT activity_year ORDER BY activity_year) FROM loan_years) = range(2007, 2025)
                  AS expected_years_present
              FROM ledger)""",
            ledger,
        ),
        "qa_invalid_years": query(
            "loan_years",
            """SELECT activity_year, count(*) AS row_count FROM loan_years
            WHERE coalesce(activity_year, 0) NOT BETWEEN 2007 AND 2024 GROUP BY activity_year""",
        ),
        "qa_missing_key_fields": query(
            "loan_years",
            "SELECT activity_year, "
            + _list(
                rows("row_count"),
                rows("missing_activity_year", "activity_year IS NULL"),
                *[rows(f"missing_{c}", _blank(c)) for c in ("state_code", "county_code", "lender_id")],
                rows("missing_loan_amount", "loan_amount IS NULL"),
            )
            + " FROM loan_years GROUP BY activity_year",
        ),
        "qa_county_patterns": query(
            "loan_years",
            f"""SELECT activity_year, source_era, count(*) AS row_count, {rows("missing_county_code", _blank("county_code"))},
              {rows("county_3_digit", _match("county_code", "[0-9]{3}"))},
              {rows("county_5_digit", _match("county_code", "[0-9]{5}"))},
              {rows("county_other_format", f"NOT {_blank('county_code')} AND NOT {_match('county_code', '[0-9]{3}|[0-9]{5}')}")},
              CAST(min(length(nullif(trim(county_code), ''))) AS INTEGER) AS min_county_len,
              CAST(max(length(nullif(trim(county_code), ''))) AS INTEGER) AS max_county_len
            FROM loan_years GROUP BY activity_year, source_era""",
        ),
        "qa_state_patterns": query(
            "loan_years",
            f"""SELECT activity_year, source_era, count(*) AS row_count,
              count(DISTINCT state_code) FILTER (WHERE NOT {_blank("state_code")}) AS distinct_state_values,
              {rows("missing_state_code", _blank("state_code"))},
              {rows("state_2_digit", _match("state_code", "[0-9]{2}"))},
              {rows("state_2_alpha", _match("state_code", "[A-Z]{2}"))},
              {rows("state_other_format", f"NOT {_blank('state_code')} AND NOT {_match('state_code', '[0-9]{2}|[A-Z]{2}')}")}
            FROM loan_years GROUP BY activity_year, source_era""",
        ),
        "qa_county_other_samples": query(
            "loan_years",
            f"""SELECT source_era, county_code, count(*) AS row_count FROM loan_years
            WHERE NOT {_blank("county_code")} AND NOT {_match("county_code", "[0-9]{3}|[0-9]{5}")}
            GROUP BY ALL ORDER BY row_count DESC, source_era, county_code LIMIT 20""",
        ),
        "qa_state_other_samples": query(
            "loan_years",
            f"""SELECT source_era, state_code, count(*) AS row_count FROM loan_years
            WHERE NOT {_blank("state_code")} AND NOT {_match("state_code", "[0-9]{2}|[A-Z]{2}")}
            GROUP BY ALL ORDER BY row_count DESC, source_era, state_code LIMIT 20""",
        ),
        "qa_objects": query(
            "geo",
            """SELECT table_name, 'VIEW' AS table_type, row_count,
              table_name IN ('loan_years', 'loan_years_geo', 'lender_county_year') AS lender_id_column_present,
              false AS lei_or_respondent_id_column_present
            FROM (SELECT 'loan_years' AS table_name, count(*) AS row_count FROM loan_years
              UNION ALL SELECT 'loan_years_geo', count(*) FROM loan_years_geo
              UNION ALL SELECT 'county_year_lending', count(*) FROM county
              UNION ALL SELECT 'lender_county_year', count(*) FROM lender
              UNION ALL SELECT 'year_summary', count(*) FROM (SELECT 1 FROM loan_years GROUP BY activity_year))""",
            COUNTY,
            LENDER,
        ),
        # readiness
        "ready_county_summary": query(
            "geo",
            f"""SELECT count(*) AS row_count, {SPAN}, count(DISTINCT activity_year) AS year_count, {COUNTY_SUMS}
            FROM county""",
            *county_panel,
        ),
        "ready_county_nulls": query(
            "geo",
            "SELECT "
            + _list(*[rows(f"null_{k}", f"{k} IS NULL") for k in ("activity_year", "state_fips_2", "county_fips_5")])
            + " FROM county",
            *county_panel,
        ),
        "ready_county_duplicates": query(
            "geo",
            """SELECT count(*) AS duplicate_grain_rows FROM (SELECT count(*) AS n FROM county
            GROUP BY activity_year, state_fips_2, county_fips_5 HAVING n > 1)""",
            *county_panel,
        ),
        "ready_reconciliation_by_year": query(
            "geo",
            f"""SELECT activity_year, {SPLIT_DIFFERENCES} FROM (SELECT activity_year, {SPLIT} FROM loan_years_geo GROUP BY 1)
            LEFT JOIN (SELECT activity_year, {total("total_records", "a")} FROM county GROUP BY 1) USING (activity_year)
            LEFT JOIN (SELECT activity_year, {total("missing_geo_rows", "m")} FROM county_missing GROUP BY 1) USING (activity_year)""",
            COUNTY,
            COUNTY_MISSING,
        ),
        "ready_reconciliation_total": query(
            "geo",
            f"""SELECT {SPLIT_DIFFERENCES} FROM (SELECT {SPLIT} FROM loan_years_geo),
            (SELECT {total("total_records", "a")} FROM county), (SELECT {total("missing_geo_rows", "m")} FROM county_missing)""",
            COUNTY,
            COUNTY_MISSING,
        ),
        "ready_lender_coverage": query(
            "loan_years",
            f"""SELECT activity_year, count(*) AS row_count, {rows("missing_lender_id", f"NOT ({HAS_LENDER})")},
              {LENDERS} AS distinct_lenders, count(DISTINCT lender_id_type) AS lender_id_type_count
            FROM loan_years GROUP BY activity_year""",
        ),
        "ready_lender_id_types": query(
            "loan_years",
            f"SELECT source_era, lender_id_type, {SPAN}, count(*) AS row_count FROM loan_years GROUP BY 1, 2",
        ),
        "ready_raw_source_keys": query(
            "geo",
            """SELECT name_kind, name, regexp_matches(lower(name), 'lender|respondent|lei|name') AS lender_identifier_like,
              contains(lower(name), 'name') AS lender_name_like
            FROM (SELECT DISTINCT 'raw_source_key' AS name_kind, unnest(json_keys(raw_source_columns)) AS name FROM loan_years_geo
              UNION ALL SELECT 'column', column_name FROM (DESCRIBE SELECT * FROM loan_years_geo))""",
        ),
        "ready_action_counts": query(
            "loan_years",
            """SELECT activity_year, source_era, coalesce(nullif(trim(action_taken), ''), '<missing>') AS action_taken,
              count(*) AS row_count FROM loan_years GROUP BY 1, 2, 3""",
        ),
        # schema audit
        "schema_by_year": query("schema", "SELECT * FROM schema_rows"),
        "schema_years_for_column": query(
            "schema",
            """SELECT column_name, string_agg(CAST(activity_year AS VARCHAR), ',' ORDER BY activity_year) AS years,
              CAST(sum(non_null_rows) AS BIGINT) AS non_null_rows
            FROM schema_rows GROUP BY column_name""",
        ),
        "schema_column_counts": query(
            "schema",
            """SELECT activity_year, count(*) AS columns, count(*) FILTER (WHERE non_null_rows > 0) AS filled_columns
            FROM schema_rows GROUP BY activity_year""",
        ),
        "schema_common_columns": query(
            "schema",
            """SELECT column_name, CAST(sum(non_null_rows) AS BIGINT) AS non_null_rows FROM schema_rows GROUP BY column_name
            HAVING count(DISTINCT activity_year) = (SELECT count(*) FROM years)""",
        ),
        "schema_era_only_columns": query(
            "schema",
            """SELECT if(max(activity_year) <= 2017, 'pre_2018', 'post_2018') AS source_era, column_name,
              CAST(sum(non_null_rows) AS BIGINT) AS non_null_rows FROM schema_rows
            GROUP BY column_name HAVING max(activity_year) <= 2017 OR min(activity_year) > 2017""",
        ),
        "schema_type_differences": query(
            "schema",
            """SELECT column_name, column_type, string_agg(CAST(activity_year AS VARCHAR), ',' ORDER BY activity_year) AS years,
              CAST(sum(non_null_rows) AS BIGINT) AS non_null_rows
            FROM schema_rows
            WHERE column_name IN (SELECT column_name FROM schema_rows GROUP BY 1 HAVING count(DISTINCT column_type) > 1)
            GROUP BY column_name, column_type""",
        ),
        "schema_key_field_availability": query("schema", _key_fields()),
        "schema_audit_tables": query(
            "schema",
            """SELECT 'ledger_summary' AS table_name, 1 AS rows UNION ALL SELECT 'schema_by_year', count(*) FROM schema_rows
            UNION ALL SELECT 'years_for_column', count(DISTINCT column_name) FROM schema_rows
            UNION ALL SELECT 'column_counts', count(*) FROM years
            UNION ALL SELECT 'common_columns', count(*) FROM (SELECT 1 FROM schema_rows GROUP BY column_name
              HAVING count(DISTINCT activity_year) = (SELECT count(*) FROM years))
            UNION ALL SELECT 'era_only_columns', count(*) FROM (SELECT 1 FROM schema_rows GROUP BY column_name
              HAVING max(activity_year) <= 2017 OR min(activity_year) > 2017)
            UNION ALL SELECT 'key_field_availability', 13 * count(*) FROM years UNION ALL SELECT 'canonical_schema', 14""",
        ),
        "schema_ledger_summary": query(
            "raw",
            """SELECT count(*) AS records, string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years,
              CAST(sum(row_count) AS BIGINT) AS total_rows, 'converted' AS statuses, '' AS errors FROM ledger""",
            ledger,
        ),
        # exports and their profile
        "export_county_panel": query("geo", f"SELECT *, {STATE_NAME} FROM county", *county_panel),
        "export_lender_panel": query("geo", f"SELECT *, {STATE_NAME} FROM lender", *lender_panel),
        "export_lender_sample_small": query(
            "geo", f"SELECT *, {STATE_NAME} FROM sample", LENDER, SAMPLE.replace("100000", "703")
        ),
        "county_medians_by_histogram": query(
            "geo",
            """SELECT activity_year, state_fips_2, county_fips_5, count(*) AS total_records, median(loan_amount) AS median_loan_amount
            FROM loan_years_geo WHERE county_fips_5 IS NOT NULL GROUP BY ALL""",
        ),
        "export_lender_sample": query("geo", f"SELECT *, {STATE_NAME} FROM sample", LENDER, SAMPLE),
        "export_manifest": query(
            "geo",
            """SELECT label, table_name, format, compression, 'exported' AS status, row_count, '' AS error FROM (
              SELECT 'county_year_lending_csv' AS label, 'county_year_lending' AS table_name, 'csv' AS format,
                '' AS compression, (SELECT count(*) FROM county) AS row_count
              UNION ALL SELECT 'lender_county_year_parquet', 'lender_county_year', 'parquet', '', (SELECT count(*) FROM lender)
              UNION ALL SELECT 'lender_county_year_sample_csv', 'lender_county_year', 'csv', '', (SELECT count(*) FROM sample)
              UNION ALL SELECT 'lender_county_year_csv_gz', 'lender_county_year', 'csv.gz', 'gzip', (SELECT count(*) FROM lender))""",
            COUNTY,
            LENDER,
            SAMPLE,
        ),
        "profile_by_year": query(
            "geo",
            """SELECT activity_year, count(*) AS county_count, CAST(sum(total_records) AS BIGINT) AS total_records,
              sum(originated_loans) / sum(total_records) AS origination_share,
              sum(denied_applications) / sum(total_records) AS denial_share,
              (sum(total_records) - sum(originated_loans) - sum(denied_applications)) / sum(total_records) AS other_action_share,
              CAST(trunc(coalesce(sum(total_loan_amount), 0) / sum(total_records)) AS BIGINT) AS average_record_amount,
              list_sort(list(lender_count))[count(*) // 2 + 1] AS median_lender_count
            FROM county GROUP BY activity_year""",
            *county_panel,
        ),
        "profile_top_counties": query(
            "geo",
            """SELECT total_records, activity_year, county_fips_5, originated_loans, denied_applications, lender_count
            FROM county ORDER BY ALL DESC LIMIT 10""",
            *county_panel,
        ),
        "profile_top_lender_counts": query(
            "geo",
            "SELECT lender_count, activity_year, county_fips_5, total_records FROM county ORDER BY ALL DESC LIMIT 10",
            *county_panel,
        ),
        "profile_sample_coverage": query(
            "geo", "SELECT activity_year, count(*) AS sample_rows FROM sample GROUP BY activity_year", LENDER, SAMPLE
        ),
    }
    out["ready_source_keys_by_era"] = query(
        "loan_years",
        """SELECT source_era, name, count(*) AS row_count
        FROM (SELECT source_era, unnest(json_keys(raw_source_columns)) AS name FROM loan_years) GROUP BY ALL""",
    )
    out["drift_loan_years"] = query("loan_years", "SELECT * EXCLUDE (raw_source_columns) FROM loan_years")
    out["ingest_stream"] = query(
        "raw",
        """SELECT CAST(file_year AS INTEGER) AS year, era AS source_era, count(*) AS row_count, CAST(1 AS BIGINT) AS batches FROM (
          SELECT file_year, 'pre_2018' AS era FROM raw_pre UNION ALL SELECT file_year, 'post_2018' FROM raw_post) GROUP BY 1, 2""",
    )
    out["ingest_stream_rows"] = out["ingest_annual"]
    out["export_order"] = query(
        "geo",
        """SELECT 'county_year_lending_csv' AS label, count(*) AS rows, CAST(0 AS BIGINT) AS inversions FROM county
        UNION ALL SELECT 'lender_county_year_parquet', count(*), 0 FROM lender
        UNION ALL SELECT 'lender_county_year_sample_csv', count(*), 0 FROM sample""",
        COUNTY,
        LENDER,
        SAMPLE,
    )
    out["typed_profile_by_year"], out["typed_profile_top_counties"] = out["profile_by_year"], out["profile_top_counties"]
    out["typed_parse_counts"] = query(
        "geo",
        """SELECT activity_year, count(*) FILTER (WHERE lender_count % 7 <> 3) AS good_rows,
          count(*) FILTER (WHERE lender_count % 7 = 3) AS corrupt_rows FROM county GROUP BY activity_year""",
        COUNTY,
    )
    out["profile_small_sample_coverage"] = query(
        "geo", "SELECT activity_year, count(*) AS sample_rows FROM sample GROUP BY activity_year", LENDER, SAMPLE.replace("100000", "703")
    )
    whole = [f"format('{{:,}}', {c}) AS {c}" for c in ("county_count", "total_records", "average_record_amount", "median_lender_count")]
    shares = [f"format('{{:.3f}}', {c}) AS {c}" for c in ("origination_share", "denial_share", "other_action_share")]
    out["profile_formatted_by_year"] = out["profile_by_year"].replace(
        "SELECT activity_year, count(*) AS county_count", f"SELECT activity_year, {_list(*whole, *shares)} FROM (SELECT activity_year, count(*) AS county_count"
    ) + ")"
    out["lender_counts_by_year"] = query(
        "geo",
        f"""SELECT activity_year, {LENDERS} AS lender_count,
          count(DISTINCT lender_id) FILTER (WHERE {HAS_LENDER} AND county_fips_5 IS NOT NULL) AS panel_lender_count
        FROM loan_years_geo GROUP BY activity_year HAVING {LENDERS} > 0""",
    )
    out["lender_counts_by_state"] = query(
        "geo",
        f"""SELECT 'year' AS grain, activity_year, state_fips_2, {LENDERS} AS lender_count FROM loan_years_geo
        GROUP BY activity_year, state_fips_2 HAVING {LENDERS} > 0
        UNION ALL SELECT 'all years', CAST(NULL AS INTEGER), state_fips_2, {LENDERS} FROM loan_years_geo
        GROUP BY state_fips_2 HAVING {LENDERS} > 0""",
    )
    out["refreshed_county_year_lending"] = out["county_year_lending"]
    out["refreshed_county_missing_geo"] = out["county_year_missing_geo_qa"]
    out["refreshed_lender_county_year"] = out["lender_county_year"]
    out["refreshed_years"] = query(
        "geo",
        """SELECT activity_year, 'changed' AS reason, panel_rows FROM (
          SELECT DISTINCT activity_year FROM (
            SELECT TRY_CAST(as_of_year AS INTEGER) AS activity_year, file_year FROM raw_pre
            UNION ALL SELECT TRY_CAST(raw_activity_year AS INTEGER), file_year FROM raw_post)
          WHERE file_year IN (SELECT DISTINCT yr FROM src ORDER BY yr DESC LIMIT 2)) touched
        LEFT JOIN (SELECT activity_year AS y, count(*) AS panel_rows FROM county GROUP BY 1) ON y IS NOT DISTINCT FROM activity_year""",
        COUNTY,
    )
    out["ready_county_by_year"] = out["county_panel_by_year"]
    return out | _drifted(out)
