"""Published tables: ordered exports, the year-stratified sample, and the manifest of what was written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from countyloom.operators.stratified import first_per_group
from countyloom.plans.panels import COUNTY_KEYS, LENDER_KEYS
from countyloom.schemas import EXPORT_MANIFEST
from countyloom.sources.dimensions import state_crosswalk
from countyloom.sources.files import CSV_OPTIONS, path_exists, stored_bytes

SAMPLE_ROWS = 100_000
CSV_WRITE = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def with_state_name(panel: DataFrame, spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    """Put the state's name after its code. The crosswalk is 56 constant rows, so it is broadcast."""
    names = F.broadcast(state_crosswalk(spark).select(F.col("state_fips").alias("state_fips_2"), "state_name"))
    first = [c for k in keys for c in ([k, "state_name"] if k == "state_fips_2" else [k])]
    named = panel.join(names, "state_fips_2", "left")
    return named.select(*first, *[c for c in panel.columns if c not in keys])


def in_key_order(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted by the table's own unique keys, so range partitioning splits even the largest year or county."""
    return table.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def county_export(county: DataFrame, spark: SparkSession) -> DataFrame:
    return in_key_order(with_state_name(county, spark, COUNTY_KEYS), COUNTY_KEYS)


def lender_export(lender: DataFrame, spark: SparkSession) -> DataFrame:
    return in_key_order(with_state_name(lender, spark, LENDER_KEYS), LENDER_KEYS)


def lender_sample(lender: DataFrame, spark: SparkSession, total: int = SAMPLE_ROWS) -> DataFrame:
    """The first ceil(total / years) panel rows of every year in key order, `total` rows in all.

    The last year in order gives up the rows by which rounding up overshoots.
    """
    n_years = lender.agg(F.count_distinct("activity_year")).scalar()
    quota = F.ceil(F.lit(float(total)) / n_years)
    sample = first_per_group(lender, "activity_year", ["state_fips_2", "county_fips_5"], "lender_id", quota)
    return in_key_order(with_state_name(sample, spark, LENDER_KEYS), LENDER_KEYS).limit(total)


@dataclass(frozen=True)
class Export:
    label: str
    table_name: str
    frame: DataFrame
    path: str
    format: str

    @property
    def compression(self) -> str:
        return "gzip" if self.format == "csv.gz" else ""


def county_csv(spark: SparkSession, county: DataFrame, root: str) -> Export:
    return Export("county_year_lending_csv", "county_year_lending", county_export(county, spark), f"{root}/county_year_lending_csv", "csv")


def lender_parquet(spark: SparkSession, lender: DataFrame, root: str) -> Export:
    return Export("lender_county_year_parquet", "lender_county_year", lender_export(lender, spark), f"{root}/lender_county_year_parquet", "parquet")


def sample_csv(spark: SparkSession, lender: DataFrame, root: str) -> Export:
    return Export("lender_county_year_sample_csv", "lender_county_year", lender_sample(lender, spark), f"{root}/lender_county_year_sample_csv", "csv")


def planned_exports(
    spark: SparkSession, county: DataFrame, lender: DataFrame, root: str, include_large_csv: bool = False
) -> list[Export]:
    plan = [county_csv(spark, county, root), lender_parquet(spark, lender, root), sample_csv(spark, lender, root)]
    if include_large_csv:
        plan.append(Export("lender_county_year_csv_gz", "lender_county_year", plan[1].frame, f"{root}/lender_county_year_csv_gz", "csv.gz"))
    return plan


def _write(export: Export, frame: DataFrame) -> None:
    writer = frame.write.mode("overwrite")
    if export.format == "parquet":
        writer.option("compression", "zstd").parquet(export.path)
    elif export.format in ("csv", "csv.gz"):
        compression = export.compression or "none"
        writer.options(**CSV_WRITE).option("compression", compression).csv(export.path)
    else:
        raise ValueError(f"unsupported output format: {export.format}")


def _existing_rows(spark: SparkSession, export: Export) -> int | None:
    """Rows of a finished output, or None. A folder without the success marker is unfinished."""
    if not path_exists(spark, f"{export.path}/_SUCCESS"):
        return None
    if export.format == "parquet":
        return spark.read.parquet(export.path).count()
    return spark.read.options(**CSV_OPTIONS).csv(export.path).count()


def _now() -> datetime:
    return datetime.now(timezone.utc)


def run_export(spark: SparkSession, export: Export, force: bool = False) -> dict:
    """Write one output and describe the result. Rows are counted while they are written."""
    row = {
        "label": export.label,
        "table_name": export.table_name,
        "output_path": export.path,
        "format": export.format,
        "compression": export.compression,
        "started_at": None,
        "row_count": None,
        "file_size_bytes": None,
        "error": "",
    }
    existing = None if force else _existing_rows(spark, export)
    if existing is not None:
        return {
            **row,
            "status": "skipped_existing",
            "row_count": existing,
            "file_size_bytes": stored_bytes(spark, export.path),
            "finished_at": _now(),
        }
    row["started_at"] = _now()
    try:
        seen = Observation()
        _write(export, export.frame.observe(seen, F.count(F.lit(1)).alias("rows")))
        row.update(status="exported", row_count=seen.get["rows"], file_size_bytes=stored_bytes(spark, export.path))
    except Exception as error:  # one failed output must not hide the others
        row.update(status="failed", error=str(error))
    return {**row, "finished_at": _now()}


def run_exports(spark: SparkSession, exports: Sequence[Export], root: str, force: bool = False) -> DataFrame:
    """Run the exports and publish the manifest next to them."""
    manifest = spark.createDataFrame([run_export(spark, e, force) for e in exports], EXPORT_MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").options(**CSV_WRITE).csv(f"{root}/export_manifest")
    return manifest
