"""Casts, trims, patterns, JSON and null order: the places where engines disagree."""

import math

import pytest
from pyspark.sql import functions as F

from countyloom.functions import count_where, full_match, has_text, missing_or_na, no_text, to_double, to_int, trimmed


def values(spark, texts, build):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("x"))).collect()]


def test_integers_round_half_away_from_zero(spark):
    texts = ["2007", "2007.6", "2008.5", "-2.5", ".5", "5.", "1e3", " 5 ", "99999999999", "NA", "", None]
    assert values(spark, texts, to_int) == [2007, 2008, 2009, -3, 1, 5, 1000, 5, None, None, None, None]


def test_suffixes_are_not_numbers(spark):
    assert values(spark, ["5d", "5f", "0x1p3", "1,000", "Exempt", "5 d", "1__0", "_1", "1_", "5_.1"], to_double) == [None] * 10
    assert values(spark, ["0x10", "-0x10", "0b11"], to_double) == [None] * 3


def test_underscores_and_other_bases(spark):
    assert values(spark, ["1_000", "1_0.5", "1.5_0", " -1_0 ", ".5_1"], to_double) == [1000.0, 10.5, 1.5, -10.0, 0.51]
    texts = ["0x10", "0X1f", "0x1_0", "0x7fffffff", "0xffffffff", "0b11", "0o17", "-0x10", "0x", "1_0.5", "1e_5"]
    assert values(spark, texts, to_int) == [16, 31, 16, 2147483647, None, 3, None, None, None, 11, None]


def test_space_separators_are_trimmed_and_tabs_are_not(spark):
    texts = ["\u00a0x\u00a0", "\u3000 x", "\tx", "\u00a0", None]
    assert values(spark, texts, trimmed) == ["x", "x", "\tx", "", None]
    assert values(spark, texts, has_text) == [True, True, True, False, False]


def test_doubles(spark):
    out = values(spark, [" 12 ", "-0.5", "1e400", "inf", "-Infinity", "nan"], to_double)
    assert out[:5] == [12.0, -0.5, math.inf, math.inf, -math.inf]
    assert math.isnan(out[5])


def test_full_match_rejects_a_trailing_newline(spark):
    assert values(spark, ["12", "12\n", "x12", None], lambda c: full_match(c, "[0-9]{2}")) == [True, False, False, None]


def test_text_predicates_are_complements_and_never_null(spark):
    texts = ["a", " a ", "", "   ", "NA", None]
    assert values(spark, texts, has_text) == [True, True, False, False, True, False]
    assert values(spark, texts, no_text) == [False, False, True, True, False, True]


def test_na_is_missing_only_where_asked(spark):
    assert values(spark, ["NA", " na ", "", None, "NAB"], missing_or_na) == [True, True, True, True, False]


@pytest.mark.parametrize("rows, expected", [([], None), ([("a",)], 0), ([("b",), ("b",)], 2)])
def test_count_where_over_a_global_input(spark, rows, expected):
    frame = spark.createDataFrame(rows, "x string")
    assert frame.agg(count_where(F.col("x") == "b")).first()[0] == expected


def test_packed_json_keeps_null_fields(spark):
    from countyloom.plans.canonical import canonical

    columns = "activity_year int, lei_or_respondent_id string, raw_activity_year string, lei string, state_code string, county_code string, census_tract string, loan_amount string, loan_type string, loan_purpose string, occupancy_type string, action_taken string, income string"  # noqa: E501
    frame = spark.createDataFrame([(2018,) + (None,) * 12], columns)
    packed = canonical(frame, "post_2018").first()["raw_source_columns"]
    assert packed == '{"raw_activity_year":null,"lei":null,"loan_amount":null,"occupancy_type":null,"income":null,"census_tract":null}'  # noqa: E501


def test_amount_units_depend_on_the_era_and_income_is_not_scaled(spark):
    from countyloom.plans.canonical import canonical

    early = "activity_year int, lei_or_respondent_id string, as_of_year string, respondent_id string, state_code string, county_code string, census_tract_number string, loan_amount_000s string, loan_type string, loan_purpose string, owner_occupancy string, action_taken string, applicant_income_000s string"  # noqa: E501
    frame = spark.createDataFrame(
        [(2010, "7", "2010", "7", "06", "037", "1", " 150 ", "1", "1", "1", "1", "80")], early
    )
    row = canonical(frame, "pre_2018").first()
    assert (row["loan_amount"], row["applicant_income"], row["lender_id_type"]) == (150000.0, 80.0, "respondent_id")


def test_usual_whole_numbers_need_no_pattern_and_odd_ones_keep_their_meaning(spark):
    texts = ["2017", "-3", "-0", "007", "+5", "\t7", "7\n", "9007199254740993", "9223372036854775808", "1_000", "2147483648"]
    whole = [2017, -3, 0, 7, 5, None, None, None, None, 1000, None]
    numbers = [2017.0, -3.0, 0.0, 7.0, 5.0, None, None, 9007199254740992.0, 9223372036854775808.0, 1000.0, 2147483648.0]
    assert values(spark, texts, to_int) == whole
    assert values(spark, texts, to_double) == numbers
    for build in (to_int, to_double):
        plan = spark.range(1).select(F.col("id").cast("string").alias("x")).select(build(F.col("x")))._jdf.queryExecution().analyzed().toString()
        assert "regexp_replace" not in plan.lower().partition(" then ")[0]  # the first case has one short pattern and no rewriting
