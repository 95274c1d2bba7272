"""Annual loan files derived from the star-schema test tables.

One loan record per lineitem row, joined to its order and customer. Values are all text, in the two raw
layouts, with missing, dirty and conflicting codes, years and amounts placed by remainders of a per-row number. Amounts are
whole numbers or quarters, so sums over the result are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.schemas import LAST_PRE_YEAR
from countyloom.sources.dimensions import STATES, inline_table
from countyloom.sources.storage import unsorted_partitions


def _first_match(*arms: tuple[Column, Column | str | None], otherwise: Column) -> Column:
    out = None
    for test, value in arms:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(otherwise)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    order = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", (F.year("o_orderdate") + 20).alias("file_year")
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    # 56 constant rows: the broadcast cannot grow with the data.
    place = F.broadcast(
        inline_table(spark, ("position", "fx", "ab"), [(i, s[0], s[1]) for i, s in enumerate(STATES)])
    )
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(place, (F.col("c_nationkey") + F.col("c_custkey") % 3 * 25) % 56 == F.col("position"))
        .select(
            "*",
            (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("h"),
            F.lpad(((F.col("l_partkey") % 12) * 2 + 1).cast("string"), 3, "0").alias("c3"),
        )
    )


def _every(n: int) -> Column:
    return F.col("h") % n == 0


def _text(c: Column) -> Column:
    return c.cast("string")


NBSP = "\u00a0"


def _row_year(spelling: Column) -> Column:
    """The year written in a row: mostly the file's, but also none, one out of range, the next one, and an odd spelling."""
    year = F.col("file_year")
    return _first_match(
        (_every(127), None), (_every(131), "2031"), (_every(137), spelling), (_every(139), _text(year + 1)),
        otherwise=_text(year),
    )


def _thousand() -> Column:
    return F.concat(F.lit("1_"), F.lpad(_text(F.col("l_partkey") % 100), 3, "0"))


def raw_pre_2018(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw early-layout rows, all text, plus the file_year they belong to."""
    fx, c3 = F.col("fx"), F.col("c3")
    return (
        _records(spark, sf_dir)
        .where(F.col("file_year") <= LAST_PRE_YEAR)
        .select(
            _row_year(F.concat(_text(F.col("file_year")), F.lit(".4"))).alias("as_of_year"),
            _first_match(
                (_every(97), None), (_every(89), " "),
                otherwise=F.lpad(_text(F.col("l_suppkey")), 10, "0"),
            ).alias("respondent_id"),
            _first_match(
                (_every(41), "NA"), (_every(43), None), (_every(37), "ZZ"),
                (_every(47), F.concat(F.lit(NBSP), fx)), (_every(2) & (fx < "10"), F.substring(fx, 2, 1)),
                otherwise=fx,
            ).alias("state_code"),
            _first_match(
                (_every(31), "NA "), (_every(61), None), (_every(67), "1234"),
                (_every(79), F.concat(fx, c3)), (_every(83), "0"),
                otherwise=c3,
            ).alias("county_code"),
            F.concat(_text(F.col("l_partkey") % 100 + 1000), F.lit(".00")).alias("census_tract_number"),
            _first_match(
                (_every(101), " "), (_every(29), _thousand()),
                (_every(23), F.concat(_text(F.floor(F.col("l_extendedprice") / 1000)), F.lit(".25"))),
                otherwise=_text(F.floor(F.col("l_extendedprice") / 1000)),
            ).alias("loan_amount_000s"),
            F.when(~_every(107), _text(F.col("l_linenumber") % 5 + 1)).alias("loan_type"),
            F.when(~_every(109), _text(F.col("h") % 3 + 1)).alias("loan_purpose"),
            _text(F.col("h") % 3 + 1).alias("owner_occupancy"),
            _first_match(
                (_every(103), None), (_every(113), "9"), otherwise=_text(F.col("h") % 8 + 1)
            ).alias("action_taken"),
            F.when(_every(11), F.lit("NA")).otherwise(_text(F.col("h") % 200 + 20)).alias("applicant_income_000s"),
            "file_year",
        )
    )


def raw_post_2018(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw late-layout rows, all text, plus the file_year they belong to."""
    fx, ab, c3 = F.col("fx"), F.col("ab"), F.col("c3")
    purposes = F.array(*[F.lit(p) for p in ("1", "2", "31", "32", "4", "5", "9")])
    return (
        _records(spark, sf_dir)
        .where(F.col("file_year") > LAST_PRE_YEAR)
        .select(
            _row_year(F.concat(F.lit("2_0"), F.substring(_text(F.col("file_year")), 3, 2))).alias("activity_year"),
            _first_match(
                (_every(97), None), (_every(89), ""),
                otherwise=F.concat(F.lit("LEI"), F.lpad(_text(F.col("l_suppkey")), 17, "0")),
            ).alias("lei"),
            _first_match(
                (_every(41), "NA"), (_every(43), None), (_every(37), "ZZ"), (_every(53), "NY"),
                (_every(59), F.lower(ab)), (_every(47), F.concat(F.lit(NBSP), ab, F.lit(NBSP))),
                otherwise=ab,
            ).alias("state_code"),
            _first_match(
                (_every(31), "NA"), (_every(61), None), (_every(67), "1234"),
                (_every(71), F.concat(fx, F.lit("000"))), (_every(73), F.concat(F.lit("99"), c3)),
                (_every(83), c3),
                otherwise=F.concat(fx, c3),
            ).alias("county_code"),
            F.concat(fx, c3, F.lit("0"), _text(F.col("l_partkey") % 100 + 10000)).alias("census_tract"),
            _first_match(
                (_every(101), ""), (_every(29), F.concat(_thousand(), F.lit(".0"))),
                (_every(23), F.concat(_text(F.floor(F.col("l_extendedprice"))), F.lit(".5"))),
                otherwise=F.concat(_text(F.floor(F.col("l_extendedprice"))), F.lit(".0")),
            ).alias("loan_amount"),
            F.when(~_every(107), _text(F.col("l_linenumber") % 5 + 1)).alias("loan_type"),
            F.element_at(purposes, (F.col("h") % 7 + 1).cast("int")).alias("loan_purpose"),
            _text(F.col("h") % 3 + 1).alias("occupancy_type"),
            _first_match(
                (_every(103), None), (_every(113), "9"), otherwise=_text(F.col("h") % 8 + 1)
            ).alias("action_taken"),
            F.when(_every(11), F.lit("NA")).otherwise(_text(F.col("h") % 200 + 20)).alias("income"),
            "file_year",
        )
    )


def write_raw_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the derived rows as annual CSV files under `<root>/file_year=<year>/`; returns `root`."""
    for rows in (raw_pre_2018(spark, sf_dir), raw_post_2018(spark, sf_dir)):
        with unsorted_partitions(spark):
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("file_year")
                .options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
                .csv(root)
            )
    return root
