"""Exact medians against brute force, with one group holding a third of the rows."""

import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from countyloom.operators import grouped
from countyloom.operators.grouped import grouped_median, ordered_bits, summarise

KEYS = ["activity_year", "county"]


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        if i % 3 == 0:
            key = (2020, "hot")
        else:
            key = (rng.choice([2019, 2020, None]), rng.choice(["a", "b", None, "c", "d"]))
        value = rng.choice([None, 0.0, float(rng.randint(-50, 50)), rng.uniform(-1e6, 1e6), float(rng.randint(1, 10**7))])
        rows.append((*key, value))
    rows += [(2021, "nothing", None), (2021, "one", 5.0), (2022, "same", 3.0), (2022, "same", 3.0), (2023, "two", 1.0), (2023, "two", 2.0)]
    return rows


def expected(rows):
    groups = defaultdict(list)
    for year, county, value in rows:
        groups[(year, county)].append(value)
    out = {}
    for key, values in groups.items():
        known = [v for v in values if v is not None]
        out[key] = (len(values), statistics.median(known) if known else None)
    return out


@pytest.mark.parametrize("limit, apart", [(0, False), (1, False), (500, True), (10**9, False), (10**9, True)])
def test_every_route_gives_the_same_exact_medians(spark, skewed, limit, apart):
    frame = spark.createDataFrame(skewed, "activity_year int, county string, amount double")
    out = summarise(frame, KEYS, {"n": F.count(F.lit(1))}, {"mid": "amount"}, large_group=limit, apart=apart)
    found = {(r["activity_year"], r["county"]): (r["n"], r["mid"]) for r in out.collect()}
    wanted = expected(skewed)
    assert found.keys() == wanted.keys()
    for key, (n, mid) in wanted.items():
        assert found[key][0] == n
        assert found[key][1] == (None if mid is None else pytest.approx(mid, rel=1e-12)), key


def test_precounted_cells_choose_the_same_route(spark, skewed):
    frame = spark.createDataFrame(skewed, "activity_year int, county string, amount double")
    cells = frame.groupBy("activity_year").agg(F.count(F.lit(1)).alias("row_count"))
    plain = summarise(frame, KEYS, {"n": F.count(F.lit(1))}, {"mid": "amount"}, large_group=700)
    helped = summarise(frame, KEYS, {"n": F.count(F.lit(1))}, {"mid": "amount"}, cells, large_group=700)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, helped.collect()), key=repr)


def test_infinite_and_repeated_values(spark):
    frame = spark.createDataFrame(
        [("a", math.inf), ("a", math.inf), ("b", -math.inf), ("b", 1.0), ("b", math.inf)] + [("c", 2.0)] * 1000 + [("c", 9.0)],
        "k string, v double",
    )
    found = dict(map(tuple, grouped_median(frame, ["k"], "v", "m").collect()))
    assert found == {"a": math.inf, "b": 1.0, "c": 2.0}


def test_bits_keep_the_order_of_values(spark):
    values = sorted([-math.inf, -1e300, -7.5, -1e-9, -5e-324, 0.0, 5e-324, 1e-9, 1.0, 1.0000001, 99999.0, 100000.0, 1e300, math.inf]) + [math.nan]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bits = [r[0] for r in frame.orderBy("i").select(ordered_bits(F.col("v"))).collect()]
    assert bits == sorted(set(bits))
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "v double").select(ordered_bits(F.col("v"))).collect()
    assert zeros[0] == zeros[1] and zeros[2][0] is None


def test_values_close_together_are_dealt_by_their_bits(spark, monkeypatch):
    """Very many distinct values within one per cent, in one group: every round has few choices, and the median is exact."""
    n = 200_001
    frame = spark.range(n).select(F.lit("hot").alias("k"), (F.lit(1e6) + F.pmod(F.xxhash64("id"), F.lit(10_000_000)) / 1000.0).alias("v"))
    frame = frame.unionByName(spark.range(7).select(F.lit("small").alias("k"), F.col("id").cast("double").alias("v")))
    kept = []
    behind = grouped._behind
    monkeypatch.setattr(grouped, "_behind", lambda counts, sought, known: kept.append((known, behind(counts, sought, known))) or kept[-1][1])
    found = dict(map(tuple, grouped_median(frame, ["k"], "v", "m").collect()))
    values = sorted(r[0] for r in frame.where("k = 'hot'").select("v").collect())
    assert found == {"hot": values[n // 2], "small": 3.0}
    for known, rows in kept[:-1]:
        choices = rows.groupBy("_key", "_middle", F.shiftright("_bits", 64 - known - grouped.RADIX_BITS)).count().groupBy("_key", "_middle").count()
        assert choices.agg(F.max("count")).first()[0] <= 2**grouped.RADIX_BITS
    assert kept[-1][1].groupBy("_key", "_middle").count().agg(F.max("count")).first()[0] <= grouped.FEW_VALUES


def test_large_groups_are_not_collected_into_one_row_buffer(spark, skewed):
    """The histogram route has no typed aggregate and no window over a whole group's values."""
    frame = spark.createDataFrame(skewed, "activity_year int, county string, amount double").na.fill("x", ["county"])
    plan = grouped_median(frame.na.fill(0, ["activity_year"]), KEYS, "amount", "m")._jdf.queryExecution().toString()
    assert "ObjectHashAggregate" not in plan
    assert "collect_list" not in plan


def test_odd_keys_stay_apart_from_null(spark):
    """Values that look like stand-ins for null are groups of their own, on every route."""
    rows = [(None, "\u0000", 1.0), (-(2**31), None, 2.0), (None, None, 3.0), (-(2**31), "\u0000", 4.0), (None, None, 5.0)]
    frame = spark.createDataFrame(rows, "activity_year int, county string, amount double")
    for limit, apart in ((0, False), (1, False), (10**9, False), (10**9, True)):
        out = summarise(frame, KEYS, {"n": F.count(F.lit(1))}, {"mid": "amount"}, large_group=limit, apart=apart)
        found = {(r["activity_year"], r["county"]): (r["n"], r["mid"]) for r in out.collect()}
        assert found == {
            (None, "\u0000"): (1, 1.0), (-(2**31), None): (1, 2.0), (None, None): (2, 4.0), (-(2**31), "\u0000"): (1, 4.0)
        }


def test_both_routes_agree_on_extreme_values(spark):
    pairs = [(-1.5e308, 1.5e308), (1e308, 1.7e308), (math.inf, -math.inf), (math.nan, 1.0), (0.1, 0.2), (-5e-324, 5e-324), (1e16, 1e16 + 2)]
    frame = spark.createDataFrame([(i, v) for i, pair in enumerate(pairs) for v in pair], "k int, v double")
    routes = [
        {r["k"]: repr(r["m"]) for r in summarise(frame, ["k"], {"n": F.count(F.lit(1))}, {"m": "v"}, large_group=limit).collect()}
        for limit in (0, 10**9)
    ]
    assert routes[0] == routes[1]


def test_large_route_joins_on_equal_keys(spark, skewed):
    frame = spark.createDataFrame(skewed, "activity_year int, county string, amount double")
    plan = summarise(frame, KEYS, {"n": F.count(F.lit(1))}, {"mid": "amount"}, large_group=500)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_small_groups_need_no_median_buffers(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 900).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    out = summarise(rows, ["k"], {"n": F.count(F.lit(1)), "s": F.sum("v")}, {"mid": "v"})
    builtin = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.median("v").alias("mid"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, builtin.collect()), key=repr)
    assert "ObjectHashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
