"""Schema and catalog scans: metadata as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countyloom.sources.files import dataset_files, uniform_groups

SCHEMA_ROWS = "activity_year int, column_name string, column_type string, nullable boolean, part int"

OBJECT_ROWS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("table_type", T.StringType()),
        T.StructField("column_names", T.ArrayType(T.StringType())),
    ]
)


def _filled(rows: DataFrame) -> DataFrame:
    """(activity_year, column_name, non_null_rows) for all columns of an era, in one pass over its rows."""
    columns = [c for c in rows.columns if c != "file_year"]
    counts = rows.groupBy("file_year").agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns])
    long = counts.unpivot(["file_year"], [F.col(f"`{c}`") for c in columns], "column_name", "non_null_rows")
    return long.withColumnRenamed("file_year", "activity_year")


def schema_rows(spark: SparkSession, root: str, file_years: Iterable[int]) -> DataFrame:
    """(activity_year, column_name, column_type, nullable, non_null_rows) of every annual file.

    A column that some files of a year store as one type and others as another has a row for each type. Names and types come
    from footers, read in tasks; counts of values from one pass over the files of each distinct schema, read as they are.
    """
    years = set(file_years)
    by_year: dict[int, list[str]] = {}
    for r in dataset_files(spark, root).orderBy("path").collect():  # metadata: a row a file
        if r["file_year"] in years:
            by_year.setdefault(r["file_year"], []).append(r["path"])
    parts: dict[str, tuple[int, T.StructType, list[str]]] = {}
    rows = []
    for year, paths in sorted(by_year.items()):
        for schema, group in uniform_groups(spark, root, paths):
            number, _, files = parts.setdefault(schema.json(), (len(parts), schema, []))
            files += group
            rows += [(year, f.name, f.dataType.simpleString(), f.nullable, number) for f in schema.fields if f.name != "file_year"]
    filled = [
        _filled(spark.read.option("basePath", root).schema(schema).parquet(*files)).withColumn("part", F.lit(number))
        for number, schema, files in parts.values()
    ]
    found = spark.createDataFrame(rows, SCHEMA_ROWS).distinct()
    if filled:
        found = found.join(reduce(DataFrame.unionByName, filled), ["activity_year", "column_name", "part"], "left")
    else:
        found = found.withColumn("non_null_rows", F.lit(None).cast("long"))
    return found.groupBy("activity_year", "column_name", "column_type").agg(
        F.bool_or("nullable").alias("nullable"), F.sum("non_null_rows").alias("non_null_rows")
    )


def catalog_objects(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """Tables and views known to the session, with their columns, optionally limited to some names."""
    wanted = {n.lower() for n in names} if names is not None else None
    rows = [
        (t.name, "VIEW" if t.tableType in ("TEMPORARY", "VIEW") else "BASE TABLE", spark.table(t.name).columns)
        for t in spark.catalog.listTables()
        if wanted is None or t.name.lower() in wanted
    ]
    return spark.createDataFrame(rows, OBJECT_ROWS)
