"""The per-group sample against brute force, with one group and one coarse key holding most rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from countyloom.operators.stratified import first_per_group
from countyloom.plans.exports import lender_sample

ORDER = lambda row: tuple((v is None, v) for v in row)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = set()
    while len(out) < 3000:
        hot = rng.random() < 0.4
        year = 2020 if hot else rng.choice([2018, 2019, 2020, None])
        state = "06" if hot else rng.choice(["01", "06", None])
        county = "06037" if hot else rng.choice(["01001", "06037", "06039"])
        out.add((year, state, county, f"L{rng.randint(1, 5000):05d}"))
    return list(out)


def brute(rows, quota):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return {row for group in groups.values() for row in sorted(group, key=lambda r: ORDER(r[1:]))[:quota]}


@pytest.mark.parametrize("quota", [1, 7, 400, 10**6])
def test_first_rows_of_every_group(spark, rows, quota):
    frame = spark.createDataFrame(rows, "activity_year int, state_fips_2 string, county_fips_5 string, lender_id string")
    found = first_per_group(
        frame, "activity_year", ["state_fips_2", "county_fips_5"], "lender_id", F.lit(quota), slices=5
    )
    assert {tuple(r) for r in found.collect()} == brute(rows, quota)


def test_sample_is_capped_and_the_last_year_gives_way(spark, rows):
    frame = spark.createDataFrame(rows, "activity_year int, state_fips_2 string, county_fips_5 string, lender_id string")
    found = [tuple(r) for r in lender_sample(frame, spark, 100).collect()]
    assert len(found) == 100
    # Three known years: 34 rows each, of which the null year, last in order, gets nothing.
    kept = [(r[0], r[1], r[3], r[4]) for r in found]
    wanted = sorted(brute(rows, 34), key=ORDER)[:100]
    assert kept == [(r[0], r[1], r[2], r[3]) for r in wanted]


def test_sample_carries_state_names(spark, rows):
    frame = spark.createDataFrame(rows, "activity_year int, state_fips_2 string, county_fips_5 string, lender_id string")
    sample = lender_sample(frame, spark, 50)
    assert sample.columns[:5] == ["activity_year", "state_fips_2", "state_name", "county_fips_5", "lender_id"]
    assert {(r["state_fips_2"], r["state_name"]) for r in sample.collect()} <= {("01", "Alabama"), ("06", "California"), (None, None)}
