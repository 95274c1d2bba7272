"""Panels kept by year: a changed annual file rewrites the years that its rows belong to, and no others.

A ledger holds, for each annual file, the state of its data files and the years written in its rows. Rows of a file mostly
carry the file's own year, but not only: those of another year, of no year, or of an impossible one belong to that year of the
panels. So a changed file touches the years its rows had before and the years they have now; these are computed again from
all files that hold any of them, and replace their partitions. The ledger is written last: whatever breaks before is done
again by the next refresh, with the same result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countyloom.operators.geography import loan_years_geo
from countyloom.plans import panels
from countyloom.plans.canonical import canonical
from countyloom.schemas import POST_2018, POST_2018_READ, PRE_2018, PRE_2018_READ
from countyloom.sources.files import dataset_files, hadoop_path, read_era
from countyloom.sources.storage import unsorted_partitions
from countyloom.sources.versions import current, write_version

PANELS = {
    "county_year_lending": panels.county_year_lending,
    "county_missing_geo": panels.county_year_missing_geo,
    "lender_county_year": panels.lender_county_year,
    "lender_missing_lender": panels.lender_panel_missing_lender,
    "lender_missing_geo": panels.lender_panel_missing_geo,
}
# Panels that look for large groups, which counted rows spare them.
COUNTED = ("county_year_lending", "lender_county_year")
LEDGER = "file_year int, state long, years array<int>"
SCHEMAS = "name string, schema string"
CHANGES = "activity_year int, reason string"


def _ledger_path(root: str) -> str:
    return f"{root}/_refreshed"


def _ledger(spark: SparkSession, root: str) -> dict[int, tuple[int, set[int | None]]]:
    """What the panels were last computed from: state and row years by file year, a few dozen rows."""
    path = current(spark, _ledger_path(root))
    if path is None:
        return {}
    return {r["file_year"]: (r["state"], set(r["years"])) for r in spark.read.schema(LEDGER).parquet(path).collect()}


def _states(spark: SparkSession, annual_root: str, arrived: Iterable[int] | None) -> dict[int, int]:
    """A number for the data files of each annual file, from their names, sizes and times."""
    state = F.xxhash64("path", "bytes", "changed_at")
    files = dataset_files(spark, annual_root)
    files = files if arrived is None else files.where(F.col("file_year").isin(sorted(arrived)))
    found = files.groupBy("file_year").agg(F.sum(state.cast("decimal(38,0)")).alias("h"))
    return {r["file_year"]: hash(int(r["h"])) for r in found.collect()}


def _eras(spark: SparkSession, annual_root: str) -> list[tuple[str, DataFrame]]:
    found = [(era, read_era(spark, annual_root, era, schema)) for era, schema in ((PRE_2018, PRE_2018_READ), (POST_2018, POST_2018_READ))]
    return [(era, rows) for era, rows in found if rows is not None]


def _row_years(spark: SparkSession, annual_root: str, file_years: set[int]) -> dict[int, set[int | None]]:
    """Years written in the rows of some annual files; reads one column of them."""
    parts = [rows.where(F.col("file_year").isin(sorted(file_years))).select("file_year", "activity_year") for _, rows in _eras(spark, annual_root)]
    out: dict[int, set[int | None]] = {y: set() for y in file_years}
    for r in reduce(DataFrame.unionByName, parts).distinct().collect():
        out[r["file_year"]].add(r["activity_year"])
    return out


def _among(years: Iterable[int | None], column: str = "activity_year") -> Column:
    """Whether a year is one of these; None stands for rows without a year."""
    known = sorted(y for y in years if y is not None)
    test = F.col(column).isin(known)
    return test | F.col(column).isNull() if None in years else test


def _partition(year: int | None) -> str:
    return f"activity_year={'__HIVE_DEFAULT_PARTITION__' if year is None else year}"


def county_cells(rows: DataFrame) -> DataFrame:
    """Rows of each year, state and county: the coarsest groups around those of every panel."""
    return rows.groupBy(*panels.COUNTY_KEYS).agg(F.count(F.lit(1)).alias("row_count"))


def _drop_emptied(spark: SparkSession, path: str, wanted: set[int | None], written: set[int | None]) -> None:
    for year in wanted - written:
        system, target = hadoop_path(spark, f"{path}/{_partition(year)}")
        if system.exists(target):
            system.delete(target, True)


def refresh(spark: SparkSession, annual_root: str, root: str, arrived: Iterable[int] | None = None) -> DataFrame:
    """Brings the panels below `root` up to date with the annual dataset; returns the years that were rewritten.

    With `arrived` only the annual files of these years count as there, otherwise all of them.

    `reason` is `changed` for a year that still has rows, `emptied` for one that has none any more.
    """
    before, states = _ledger(spark, root), _states(spark, annual_root, arrived)
    changed = {y for y in before.keys() | states.keys() if y not in before or before[y][0] != states.get(y)}
    if not changed:
        return spark.createDataFrame([], CHANGES)
    there = changed & states.keys()
    now = {y: years for y, (_, years) in before.items() if y in states} | (_row_years(spark, annual_root, there) if there else {})
    touched: set[int | None] = set().union(*(now.get(y, set()) for y in changed), *(before[y][1] for y in changed & before.keys()))
    sources = sorted(y for y, years in now.items() if years & touched)

    def rows() -> DataFrame:
        test = F.col("file_year").isin(sources) & _among(touched)
        parts = [canonical(era_rows.where(test), era) for era, era_rows in _eras(spark, annual_root)]
        return loan_years_geo(reduce(DataFrame.unionByName, parts), spark).select(*panels.ROW_COLUMNS)

    filled = set().union(*now.values()) & touched
    if filled:
        # Stored once for the five tables, for the touched years only; an unfinished one is written over by nobody.
        narrow = spark.read.parquet(write_version(rows(), f"{root}/_rows", lambda frame, path: frame.write.option("compression", "zstd").parquet(path)))
        cells = spark.read.parquet(write_version(county_cells(narrow), f"{root}/_rows/cells", lambda frame, path: frame.write.parquet(path)))
    schemas = []
    for name, build in PANELS.items():
        path, written = f"{root}/{name}", set()
        if filled:
            seen = Observation()
            panel = build(narrow, cells) if name in COUNTED else build(narrow)
            schemas.append((name, panel.schema.json()))
            panel = panel.observe(seen, F.collect_set(F.struct("activity_year")).alias("years"))
            writer = panel.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            with unsorted_partitions(spark):
                writer.partitionBy("activity_year").parquet(path)
            written = {r["activity_year"] for r in seen.get["years"]}
        _drop_emptied(spark, path, touched, written)
    system, target = hadoop_path(spark, f"{root}/_rows")
    system.delete(target, True)
    if schemas:
        write_version(spark.createDataFrame(schemas, SCHEMAS).coalesce(1), f"{root}/_schemas", lambda frame, path: frame.write.json(path))
    ledger = spark.createDataFrame([(y, states[y], sorted(years, key=lambda x: (x is None, x))) for y, years in now.items()], LEDGER)
    write_version(ledger.coalesce(1), _ledger_path(root), lambda frame, path: frame.write.parquet(path))
    return spark.createDataFrame([(y, "changed" if y in filled else "emptied") for y in touched], CHANGES)


def read_panel(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A refreshed panel, with the columns of the panel built at once; a year's rows are a partition."""
    schemas = current(spark, f"{root}/_schemas")
    found = None if schemas is None else spark.read.schema(SCHEMAS).json(schemas).where(F.col("name") == name).first()
    if found is None:
        raise FileNotFoundError(f"{name} has not been refreshed below {root}")
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    return spark.read.schema(schema).parquet(f"{root}/{name}").select(*schema.names)
