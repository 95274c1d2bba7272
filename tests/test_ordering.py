"""Order of stored files, and typed reads of published CSV tables."""

import random

from pyspark.sql import functions as F

from countyloom.operators.ordering import order_check
from countyloom.plans import profile
from countyloom.sources.files import CORRUPT, read_typed_csv

KEYS = ["y", "k"]


def counted(frame):
    return tuple(order_check(frame, KEYS).first())


def falls(spark, path, kind):
    """Inversions by reading the files one after the other in the driver."""
    import pathlib

    out, before = 0, None
    for file in sorted(pathlib.Path(path).glob("part-*")):
        frame = spark.read.parquet(str(file)) if kind == "parquet" else spark.read.csv(str(file), header=True, schema="y int, k string")
        for r in frame.collect():
            key = (r.y is None, r.y or 0, r.k is None, r.k or "")
            out += before is not None and key < before
            before = key
    return out


def test_inversions_inside_and_between_files(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.choice([2019, 2020, 2021, None]), rng.choice(["a", "b", "c", None])) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "y int, k string")
    for kind in ("parquet", "csv"):
        options = {"header": True} if kind == "csv" else {"parquet.block.size": 4096}
        ordered, shuffled = str(tmp_path / f"{kind}-ordered"), str(tmp_path / f"{kind}-shuffled")
        in_order = frame.orderBy(*[F.col(k).asc_nulls_last() for k in KEYS])
        in_order.write.options(**options, maxRecordsPerFile=700).format(kind).save(ordered)
        frame.orderBy(F.rand(3)).write.options(**options).format(kind).save(shuffled)
        read = spark.read.options(header=True).schema("y int, k string").format(kind)
        assert counted(read.load(ordered)) == (5000, 0)
        rows_, down = counted(read.load(shuffled))
        assert rows_ == 5000 and down == falls(spark, shuffled, kind) > 1000
        plan = order_check(read.load(shuffled), KEYS)._jdf.queryExecution().toString()
        assert "rangepartitioning" not in plan
    swapped = str(tmp_path / "swapped")
    spark.range(0, 100).coalesce(1).selectExpr("cast(id as int) y", "'a' k").write.parquet(swapped)
    spark.range(50, 60).coalesce(1).selectExpr("cast(id as int) y", "'a' k").write.mode("append").parquet(swapped)
    assert counted(spark.read.parquet(swapped)) == (110, 1)
    assert counted(spark.read.schema("y int, k string").parquet(swapped).where("false")) == (0, 0)


def test_rows_that_do_not_fit_their_types(spark, tmp_path):
    path = tmp_path / "county.csv"
    header = "activity_year,county_fips_5,total_applications,originated_loans,denied_applications,total_loan_amount,lender_count"
    good = ["2019,06037,10,4,3,100.5,2", "2019,06039,8,4,,,1", "2020,,5,1,1,7.0,1"]
    bad = ["2019,06041,x10,4,3,1.0,2", "2020,06043,10,4", "oops,06045,1,1,1,1.0,1", "2020,06047,1,1,1,1.0,1,more"]
    path.write_text("\n".join([header, good[0], bad[0], good[1], bad[1], bad[2], good[2], bad[3]]) + "\n")
    rows = profile.typed_county_rows(spark, str(path))
    assert dict(rows.dtypes)["total_records"] == "bigint" and dict(rows.dtypes)["total_loan_amount"] == "double"
    kept = rows.where(F.col(CORRUPT).isNull())
    assert sorted(r.total_records for r in kept.collect()) == [5, 8, 10]
    assert sorted(r[CORRUPT] for r in rows.where(F.col(CORRUPT).isNotNull()).collect()) == sorted(bad)
    counts = {r.activity_year: (r.good_rows, r.corrupt_rows) for r in profile.parse_counts(rows).collect()}
    assert counts == {2019: (2, 1), 2020: (1, 2), None: (0, 1)}
    assert read_typed_csv(spark, str(path), {"activity_year": "int"}).where(F.col(CORRUPT).isNotNull()).count() == 3
