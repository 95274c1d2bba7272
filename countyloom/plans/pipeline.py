"""A run over one annual dataset: lazy views, stored tables, and the build log.

Loan rows stay lazy. Tables that several reports read are written once to the shared folder and read back,
which also cuts their lineage: a lost executor costs a re-read, not a rebuild.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.operators.geography import code_cells, loan_years_geo, normalize_codes
from countyloom.plans import canonical, exports, panels, readiness, schema_audit
from countyloom.schemas import KEY_VALUE
from countyloom.sources.catalog import schema_rows
from countyloom.sources.files import AnnualSource, dataset_tag, read_published_csv
from countyloom.sources.storage import shared_folder
from countyloom.sources.versions import current, write_version
from countyloom.streaming.arrivals import ingest, stored_ledger


class Run:
    """Views and tables of one annual dataset. Nothing is computed before it is asked for."""

    def __init__(
        self,
        spark: SparkSession,
        annual_root: str,
        work_root: str | None = None,
        sources: Sequence[AnnualSource] = (),
    ):
        self.spark = spark
        self.annual_root = annual_root
        self.root = work_root or shared_folder(spark)
        self.sources = list(sources)
        self._stored: dict[str, str] = {}

    @property
    def file_years(self) -> list[int]:
        return [s.file_year for s in self.sources]

    # views

    @property
    def loan_years(self) -> DataFrame:
        return canonical.loan_years(self.spark, self.annual_root)

    @property
    def loan_years_geo(self) -> DataFrame:
        return loan_years_geo(self.loan_years, self.spark)

    @property
    def ledger(self) -> DataFrame:
        return stored_ledger(self.spark, self.annual_root)

    # stored tables

    @cached_property
    def tag(self) -> str:
        """The state of the annual dataset when this run first looked; stored tables of another state are not taken."""
        return dataset_tag(self.spark, self.annual_root)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table written on first use. Another process with the same folders finds it, as long as the dataset is the same."""
        if name not in self._stored:
            found = current(self.spark, f"{self.root}/{name}", self.tag)
            self._stored[name] = found or self._write(name, build())
        return self.spark.read.parquet(self._stored[name])

    def stored_or_planned(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table as it is stored, or its plan, which is not run, if it is not stored yet."""
        path = self._stored.get(name) or current(self.spark, f"{self.root}/{name}", self.tag)
        return build() if path is None else self.spark.read.parquet(path)

    def stored_path(self, name: str) -> str:
        return self._stored[name]

    def rebuild(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Replaces a stored table. If the build or the write fails, the former version stays the table."""
        self._stored[name] = self._write(name, build())
        return self.spark.read.parquet(self._stored[name])

    def _write(self, name: str, frame: DataFrame) -> str:
        def write(rows: DataFrame, path: str) -> None:
            rows.write.option("compression", "zstd").parquet(path)

        return write_version(frame, f"{self.root}/{name}", write, self.tag)

    @property
    def code_cells(self) -> DataFrame:
        return self.stored("code_cells", lambda: code_cells(self.loan_years))

    @property
    def geo_cells(self) -> DataFrame:
        return normalize_codes(self.code_cells, self.spark)

    @property
    def panel_rows(self) -> DataFrame:
        """Loan rows reduced to the columns that panels read, with geography; stored once for all of them."""
        return self.stored("panel_rows", lambda: self.loan_years_geo.select(*panels.ROW_COLUMNS))

    @property
    def county_year_lending(self) -> DataFrame:
        return self.stored("county_year_lending", lambda: panels.county_year_lending(self.panel_rows, self.geo_cells))

    @property
    def county_missing_geo(self) -> DataFrame:
        return self.stored("county_missing_geo", lambda: panels.county_year_missing_geo(self.panel_rows))

    @property
    def lender_county_year(self) -> DataFrame:
        return self.stored("lender_county_year", lambda: panels.lender_county_year(self.panel_rows, self.geo_cells))

    @property
    def lender_sets(self) -> DataFrame:
        return self.stored("lender_sets", lambda: panels.lender_sets(self.panel_rows))

    @property
    def lender_missing_lender(self) -> DataFrame:
        return self.stored("lender_missing_lender", lambda: panels.lender_panel_missing_lender(self.panel_rows))

    @property
    def lender_missing_geo(self) -> DataFrame:
        return self.stored("lender_missing_geo", lambda: panels.lender_panel_missing_geo(self.panel_rows))

    @property
    def year_summary(self) -> DataFrame:
        return self.stored("year_summary", lambda: canonical.year_summary(self.loan_years, self.code_cells))

    @property
    def schema_rows(self) -> DataFrame:
        return self.stored("schema_rows", lambda: schema_rows(self.spark, self.annual_root, self.file_years))

    @property
    def column_metadata(self) -> DataFrame:
        return readiness.column_metadata(self.spark, self.loan_years, self.ledger)

    # published files

    def audit(self) -> str:
        """Folder of the audit document, written on first use."""
        folder = f"{self.root}/audit"
        if "audit" not in self._stored:
            schema_audit.write_audit(self.spark, self.schema_rows, self.ledger, self.column_metadata, folder)
            self._stored["audit"] = folder
        return folder

    def publish(self, folder: str | None = None, force: bool = False, include_large_csv: bool = False) -> DataFrame:
        root = folder or f"{self.root}/published"
        plan = exports.planned_exports(
            self.spark, self.county_year_lending, self.lender_county_year, root, include_large_csv
        )
        return exports.run_exports(self.spark, plan, root, force)

    def published_path(self, label: str) -> str:
        """Folder of a published table, exported on first use; the other tables are neither built nor exported for it."""
        root = f"{self.root}/published"
        if f"published/{label}" not in self._stored:
            if label == "county_year_lending_csv":
                export = exports.county_csv(self.spark, self.county_year_lending, root)
            else:
                planned = {"lender_county_year_parquet": exports.lender_parquet, "lender_county_year_sample_csv": exports.sample_csv}
                export = planned[label](self.spark, self.lender_county_year, root)
            done = exports.run_export(self.spark, export)
            if done["status"] == "failed":
                raise RuntimeError(f"export of {label} failed: {done['error']}")
            self._stored[f"published/{label}"] = export.path
        return self._stored[f"published/{label}"]

    def published(self, label: str) -> DataFrame:
        return read_published_csv(self.spark, self.published_path(label))

    def register_views(self, stored: bool = True) -> None:
        """Make the two lazy relations and the stored tables available to SQL.

        Without `stored`, tables that are not stored yet are views of their plans, so that a query that needs few of their columns,
        or just their rows' number, doesn't build them.
        """
        tables = ("county_year_lending", "lender_county_year", "year_summary")
        planned = {} if stored else {name: self.stored_or_planned(name, build) for name, build in self._plans().items()}
        for name in ("loan_years", "loan_years_geo", *tables):
            (planned[name] if name in planned else getattr(self, name)).createOrReplaceTempView(name)

    def _plans(self) -> dict[str, Callable[[], DataFrame]]:
        rows = self.stored_or_planned("panel_rows", lambda: self.loan_years_geo.select(*panels.ROW_COLUMNS))
        return {
            "county_year_lending": lambda: panels.county_year_lending(rows, self.geo_cells),
            "lender_county_year": lambda: panels.lender_county_year(rows, self.geo_cells),
            "year_summary": lambda: canonical.year_summary(self.loan_years, self.code_cells),
        }


def start(spark: SparkSession, sources: Sequence[AnnualSource], work_root: str | None = None) -> Run:
    """Ingest annual files and open a run over them."""
    root = work_root or shared_folder(spark)
    run = Run(spark, f"{root}/annual", f"{root}/tables", sources)
    ledger = ingest(spark, run.sources, run.annual_root)
    broken = ledger.where(F.col("error").isNotNull()).select("year", "error").first()
    if broken is not None:
        raise RuntimeError(f"ingest of {broken['year']} failed: {broken['error']}")
    return run


VOLATILE_LOG_KEYS = ("database_path", "started_at", "finished_at", "source_parquet_files")


def build_log(run: Run) -> DataFrame:
    """Key/value log of a build, also stored with the run; lists are JSON text.

    The two totals come from the year summary.
    """
    started = datetime.now(timezone.utc).isoformat(timespec="seconds")
    totals = run.year_summary.agg(
        F.count(F.lit(1)).alias("years"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")
    ).first()
    log = {
        "database_path": run.root,
        "started_at": started,
        "finished_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "years": json.dumps(run.file_years),
        "source_parquet_files": json.dumps([r["parquet_output_path"] for r in run.ledger.collect()]),
        "objects_created": json.dumps(["loan_years", "column_metadata", "year_summary", "build_log"]),
        "loan_years_kind": "VIEW",
        "year_summary_years": str(totals["years"]),
        "year_summary_total_rows": str(totals["rows"]),
        "notes": json.dumps(["loan_years is a view over the annual dataset."]),
    }
    frame = run.spark.createDataFrame(list(log.items()), KEY_VALUE)
    frame.coalesce(1).write.mode("overwrite").json(f"{run.root}/build_log")
    return frame
