"""Sets as bitmaps against sets in Python."""

import random

from pyspark.sql import functions as F

from countyloom.operators.bitmaps import counted, dense_numbers, merged, sets_by


def test_numbers_are_dense_and_ordered(spark):
    values = spark.range(1000).select((F.col("id") * 7 % 400).cast("string").alias("v")).unionByName(spark.createDataFrame([(None,)], "v string"))
    found = {r.v: r._number for r in dense_numbers(values.repartition(5), "v").collect()}
    assert found == {v: i for i, v in enumerate(sorted({str(i) for i in range(400)}), 1)}
    assert dense_numbers(values.where("false"), "v").count() == 0


def test_counts_roll_up(spark):
    rng = random.Random(6)
    rows = [(rng.choice([2019, 2020, None]), rng.choice(["a", "b", None]), rng.choice([None, *range(60)])) for _ in range(3000)]
    rows += [(2021, "many", i) for i in range(70_000)] + [(2021, "some", i) for i in range(60_000, 90_000)]
    frame = spark.createDataFrame(rows, "y int, c string, v long")
    sets = sets_by(frame, ["y", "c"], "v", dense_numbers(frame, "v"))
    assert merged(sets, ["y"]).where("y = 2021").count() == 3  # 90,000 numbers are three ranges

    def wanted(key):
        groups = {}
        for y, c, v in rows:
            if v is not None:
                groups.setdefault(key(y, c), set()).add(v)
        return {k: len(v) for k, v in groups.items()}

    assert {(r.y, r.c): r.n for r in counted(sets, ["y", "c"], "n").collect()} == wanted(lambda y, c: (y, c))
    assert {r.y: r.n for r in counted(sets, ["y"], "n").collect()} == wanted(lambda y, c: y)
    assert counted(sets, [], "n").first().n == 90_000


def test_sets_are_built_after_the_shuffle(spark):
    rows = spark.range(3000).select((F.col("id") % 40).alias("k"), (F.col("id") % 700).cast("string").alias("v"))
    plan = sets_by(rows, ["k"], "v", dense_numbers(rows, "v"))._jdf.queryExecution().executedPlan().toString()
    merging, _, before = plan.partition("partial_bitmap_construct_agg")
    assert before and "Exchange" not in merging  # nothing is sent between the two steps of the aggregation
