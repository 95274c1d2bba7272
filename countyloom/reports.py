"""Every report by name, as a function of a run; and runs over annual files derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.operators.ordering import order_check
from countyloom.plans import canonical, exports, panels, profile, quality, readiness, schema_audit
from countyloom.plans import geography_reports as geography
from countyloom.plans.ingest import validation_report

from countyloom.plans.panels import COUNTY_KEYS, LENDER_KEYS
from countyloom.plans.pipeline import VOLATILE_LOG_KEYS, Run, build_log, start
from countyloom.plans.refresh import read_panel, refresh
from countyloom.sources.catalog import catalog_objects, schema_rows
from countyloom.sources.derived import write_raw_files
from countyloom.sources.dimensions import action_metadata, state_crosswalk
from countyloom.sources.drifted import write_drifted
from countyloom.sources.files import CORRUPT, AnnualSource, hadoop_path, path_exists, read_published_csv
from countyloom.sources.storage import shared_folder
from countyloom.streaming.arrivals import ingest, revalidate
from countyloom.streaming.file_stream import convert_arrived, converted_rows, read_converted

# A sample smaller than the panel at any size of the test tables, and with a remainder for the last year.
SMALL_SAMPLE = 703

_open_runs: dict[tuple[str, str], Run] = {}


def file_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Years the derived files cover (a handful of values)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return [r[0] for r in orders.select(F.year("o_orderdate") + 20).distinct().orderBy(1).collect()]


def open_run(spark: SparkSession, sf_dir: str) -> Run:
    """Derive raw annual files from the test tables and ingest them, once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open_runs:
        root = shared_folder(spark)
        raw = write_raw_files(spark, sf_dir, f"{root}/raw")
        sources = [AnnualSource(y, f"{raw}/file_year={y}") for y in file_years(spark, sf_dir)]
        _open_runs[key] = start(spark, sources, root)
    return _open_runs[key]


def _schema(run: Run) -> DataFrame:
    return run.schema_rows


def _ingest_incremental(run: Run) -> DataFrame:
    """Ingest the even years, then all years into the same dataset: the second ledger shows what was skipped.

    Done once a run, and its ledger kept, so that asking again leaves no further copy.
    """

    def twice() -> DataFrame:
        root = f"{run.root}/incremental"
        ingest(run.spark, [s for s in run.sources if s.file_year % 2 == 0], root)
        return ingest(run.spark, run.sources, root)

    return run.stored("incremental_ledger", twice).select("year", "source_era", "conversion_status", "row_count")


def _arrivals(run: Run) -> str:
    """Raw files converted as a stream, in three runs: the early years, all years, and once more with nothing new."""
    root = f"{run.root}/streamed"
    if not path_exists(run.spark, f"{root}/done"):
        raw = f"{run.root.rpartition('/')[0]}/raw"
        for arrived in (run.file_years[:3], run.file_years, run.file_years):
            convert_arrived(run.spark, raw, f"{root}/rows", f"{root}/checkpoints", arrived)
        run.spark.range(1).write.mode("overwrite").parquet(f"{root}/done")
    return f"{root}/rows"


def _ingest_validation(run: Run) -> DataFrame:
    return validation_report(revalidate(run.spark, run.sources, run.annual_root))


def _objects(run: Run) -> DataFrame:
    """Objects and their rows: panels that are not stored are counted without building them, and `loan_years_geo`, whose
    geography hangs on the codes alone, in the code cells."""
    run.register_views(stored=False)
    objects = catalog_objects(
        run.spark, ["loan_years", "loan_years_geo", "county_year_lending", "lender_county_year", "year_summary"]
    )
    names = [r["table_name"] for r in objects.select("table_name").collect()]
    rows = F.count(F.lit(1))
    counts = {n: run.spark.table(n).agg(rows.alias("row_count")) for n in names}
    counts["loan_years_geo"] = run.geo_cells.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
    sizes = [counted.select(F.lit(n).alias("table_name"), "row_count") for n, counted in counts.items()]
    return quality.object_report(objects, reduce(DataFrame.unionByName, sizes))


def _manifest(run: Run) -> DataFrame:
    """Export everything once a run; paths, sizes and times are left to the stored manifest."""
    manifest = run.stored("full_manifest", lambda: run.publish(f"{run.root}/published_all", include_large_csv=True))
    return manifest.select("label", "table_name", "format", "compression", "status", "row_count", "error")


def _drifted_root(run: Run) -> str:
    """A copy of the dataset in which columns change their type between and inside years; written once a run."""
    root = f"{run.root}/drifted"
    if not path_exists(run.spark, f"{root}-done/_SUCCESS"):
        system, target = hadoop_path(run.spark, root)
        system.delete(target, True)  # what a run that broke may have left
        write_drifted(run.spark, run.annual_root, root, run.file_years)
        run.spark.range(1).write.mode("overwrite").parquet(f"{root}-done")
    return root


def _drifted_schema(run: Run) -> DataFrame:
    return run.stored("drifted_schema_rows", lambda: schema_rows(run.spark, _drifted_root(run), run.file_years))


def _refreshed(run: Run) -> str:
    """Panels that were built without the last two annual files and refreshed when these arrived; done once a run."""
    root = f"{run.root}/refreshed"

    def grow() -> DataFrame:
        refresh(run.spark, run.annual_root, root, run.file_years[:-2])
        return refresh(run.spark, run.annual_root, root)

    run.stored("refreshed_years", grow)
    return root


def _refreshed_panel(name: str) -> Callable[[Run], DataFrame]:
    return lambda run: read_panel(run.spark, _refreshed(run), name)


def _refreshed_years(run: Run) -> DataFrame:
    """The years that the arrival of the last two files rewrote, and the rows they now have."""
    counts = read_panel(run.spark, _refreshed(run), "county_year_lending").groupBy("activity_year").agg(F.count(F.lit(1)).alias("panel_rows"))
    rewritten = run.spark.read.parquet(run.stored_path("refreshed_years"))
    return rewritten.join(counts, rewritten["activity_year"].eqNullSafe(counts["activity_year"]), "left").select(
        rewritten["activity_year"], "reason", "panel_rows"
    )


def _export_order(run: Run) -> DataFrame:
    """Rows out of order in each published table, as its files stand."""
    tables = [
        ("county_year_lending_csv", run.published("county_year_lending_csv"), COUNTY_KEYS),
        ("lender_county_year_parquet", run.spark.read.parquet(run.published_path("lender_county_year_parquet")), LENDER_KEYS),
        ("lender_county_year_sample_csv", run.published("lender_county_year_sample_csv"), LENDER_KEYS),
    ]
    checks = [order_check(rows, keys).select(F.lit(label).alias("label"), "rows", "inversions") for label, rows, keys in tables]
    return reduce(DataFrame.unionByName, checks)


def _typed_counties(run: Run) -> DataFrame:
    return profile.typed_county_rows(run.spark, run.published_path("county_year_lending_csv"))


def _spoiled_counties(run: Run) -> DataFrame:
    """A copy of the published county panel in which a number of some rows is no number any more; written once a run."""
    path = f"{run.root}/spoiled_county_csv"
    if not path_exists(run.spark, f"{path}/_SUCCESS"):
        rows = run.published("county_year_lending_csv")
        bad = F.col("lender_count").cast("int") % 7 == 3
        spoiled = rows.withColumn("denied_applications", F.when(bad, F.concat(F.lit("x"), F.col("denied_applications"))).otherwise(F.col("denied_applications")))
        spoiled.write.mode("overwrite").options(**exports.CSV_WRITE).csv(path)
    return profile.typed_county_rows(run.spark, path)


def _small_sample_coverage(run: Run) -> DataFrame:
    """Rows of each year in a sample that is cut, read back from its CSV file."""
    path = f"{run.root}/small_sample_csv"
    if not path_exists(run.spark, f"{path}/_SUCCESS"):
        exports.lender_sample(run.lender_county_year, run.spark, SMALL_SAMPLE).write.mode("overwrite").options(**exports.CSV_WRITE).csv(path)
    return profile.sample_coverage(read_published_csv(run.spark, path))


def _published_counties(run: Run) -> DataFrame:
    return profile.county_rows(run.published("county_year_lending_csv"))


REPORTS: dict[str, Callable[[Run], DataFrame]] = {
    # ingest and canonical rows
    "ingest_annual": lambda r: canonical.annual_rows(r.spark, r.annual_root),
    "ingest_incremental": _ingest_incremental,
    "ingest_stream": lambda r: converted_rows(r.spark, _arrivals(r)),
    "ingest_stream_rows": lambda r: read_converted(r.spark, _arrivals(r)).drop("batch"),
    "ingest_validation": _ingest_validation,
    "loan_years": lambda r: r.loan_years,
    "column_metadata": lambda r: readiness.column_metadata_usage(r.column_metadata, r.loan_years),
    "year_summary": lambda r: canonical.year_summary(r.loan_years, r.code_cells),
    "build_log": lambda r: build_log(r).where(~F.col("key").isin(*VOLATILE_LOG_KEYS)),
    # geography
    "state_fips_crosswalk": lambda r: readiness.crosswalk_usage(state_crosswalk(r.spark), r.geo_cells),
    "loan_years_geo": lambda r: r.loan_years_geo,
    "geo_raw_formats": lambda r: geography.raw_formats(r.code_cells),
    "geo_validation_by_year": lambda r: geography.validation_by_year(r.geo_cells),
    "geo_validation_totals": lambda r: geography.validation_totals(r.geo_cells),
    "geo_unmapped_examples": lambda r: geography.unmapped_examples(r.geo_cells),
    "geo_sample_mappings": lambda r: geography.sample_mappings(r.geo_cells),
    "geo_source_flags": lambda r: geography.source_flags(r.geo_cells),
    # panels and exclusion tables
    "county_year_lending": lambda r: panels.county_year_lending(r.panel_rows, r.geo_cells),
    "county_year_missing_geo_qa": lambda r: panels.county_year_missing_geo(r.panel_rows),
    "action_taken_metadata": lambda r: readiness.action_metadata_usage(action_metadata(r.spark), r.loan_years),
    "county_panel_summary": lambda r: panels.county_panel_summary(r.county_year_lending),
    "county_panel_by_year": lambda r: panels.county_panel_by_year(r.county_year_lending),
    "county_panel_geo_consistency": lambda r: panels.county_panel_geo_consistency(r.county_year_lending),
    "lender_county_year": lambda r: panels.lender_county_year(r.panel_rows, r.geo_cells),
    "lender_panel_missing_lender_qa": lambda r: panels.lender_panel_missing_lender(r.panel_rows),
    "lender_panel_missing_geo_qa": lambda r: panels.lender_panel_missing_geo(r.panel_rows),
    "lender_panel_summary": lambda r: panels.lender_panel_summary(r.lender_county_year),
    "lender_panel_by_year": lambda r: panels.lender_panel_by_year(r.lender_county_year),
    "lender_panel_key_checks": lambda r: quality.lender_key_checks(r.lender_county_year),
    "lender_panel_duplicates": lambda r: quality.lender_duplicates(r.lender_county_year),
    "lender_panel_reconciliation": lambda r: quality.lender_panel_reconciliation(
        r.panel_rows, r.lender_county_year, r.lender_missing_lender, r.lender_missing_geo
    ),
    "lender_panel_missing_lender_by_year": lambda r: panels.missing_lender_by_year(r.lender_missing_lender),
    "lender_counts_by_year": lambda r: panels.lender_counts_by_year(r.lender_sets),
    "lender_counts_by_state": lambda r: panels.lender_counts_by_state(r.lender_sets),
    "refreshed_county_year_lending": _refreshed_panel("county_year_lending"),
    "refreshed_county_missing_geo": _refreshed_panel("county_missing_geo"),
    "refreshed_lender_county_year": _refreshed_panel("lender_county_year"),
    "refreshed_years": _refreshed_years,
    # quality of the loan rows
    "qa_row_reconciliation": lambda r: quality.row_reconciliation(r.code_cells, r.ledger),
    "qa_invalid_years": lambda r: quality.invalid_years(r.code_cells),
    "qa_missing_key_fields": lambda r: quality.missing_key_fields(r.loan_years),
    "qa_county_patterns": lambda r: quality.county_patterns(r.code_cells),
    "qa_state_patterns": lambda r: quality.state_patterns(r.code_cells),
    "qa_county_other_samples": lambda r: quality.county_other_samples(r.code_cells),
    "qa_state_other_samples": lambda r: quality.state_other_samples(r.code_cells),
    "qa_objects": _objects,
    # readiness
    "ready_county_summary": lambda r: readiness.county_summary(r.county_year_lending),
    "ready_county_by_year": lambda r: panels.county_panel_by_year(r.county_year_lending),
    "ready_county_nulls": lambda r: quality.county_key_nulls(r.county_year_lending),
    "ready_county_duplicates": lambda r: quality.county_duplicates(r.county_year_lending),
    "ready_reconciliation_by_year": lambda r: quality.county_reconciliation_by_year(
        r.panel_rows, r.county_year_lending, r.county_missing_geo
    ),
    "ready_reconciliation_total": lambda r: quality.county_reconciliation_total(
        r.panel_rows, r.county_year_lending, r.county_missing_geo
    ),
    "ready_lender_coverage": lambda r: readiness.lender_coverage(r.loan_years),
    "ready_lender_id_types": lambda r: readiness.lender_id_types(r.loan_years),
    "ready_raw_source_keys": lambda r: readiness.name_report(r.spark, r.loan_years, r.loan_years_geo.columns),
    "ready_source_keys_by_era": lambda r: readiness.source_keys_by_era(r.loan_years),
    "ready_action_counts": lambda r: readiness.action_counts(r.loan_years),
    # schema audit
    "schema_by_year": _schema,
    "schema_years_for_column": lambda r: schema_audit.years_for_column(_schema(r)),
    "schema_column_counts": lambda r: schema_audit.column_counts(_schema(r)),
    "schema_common_columns": lambda r: schema_audit.common_columns(_schema(r)),
    "schema_era_only_columns": lambda r: schema_audit.era_only_columns(_schema(r)),
    "schema_type_differences": lambda r: schema_audit.type_differences(_schema(r)),
    "schema_key_field_availability": lambda r: schema_audit.key_field_availability(r.spark, _schema(r)),
    "schema_audit_tables": lambda r: schema_audit.read_audit(r.spark, r.audit()),
    "drift_loan_years": lambda r: canonical.mixed_loan_years(r.spark, _drifted_root(r)).drop("raw_source_columns"),
    "drift_schema_by_year": _drifted_schema,
    "drift_years_for_column": lambda r: schema_audit.years_for_column(_drifted_schema(r)),
    "drift_column_counts": lambda r: schema_audit.column_counts(_drifted_schema(r)),
    "drift_common_columns": lambda r: schema_audit.common_columns(_drifted_schema(r)),
    "drift_era_only_columns": lambda r: schema_audit.era_only_columns(_drifted_schema(r)),
    "drift_type_differences": lambda r: schema_audit.type_differences(_drifted_schema(r)),
    "drift_key_field_availability": lambda r: schema_audit.key_field_availability(r.spark, _drifted_schema(r)),
    "schema_ledger_summary": lambda r: schema_audit.ledger_summary(r.ledger),
    # exports and their profile
    "export_county_panel": lambda r: exports.county_export(r.county_year_lending, r.spark),
    "export_lender_panel": lambda r: exports.lender_export(r.lender_county_year, r.spark),
    "export_lender_sample_small": lambda r: exports.lender_sample(r.lender_county_year, r.spark, SMALL_SAMPLE),
    "county_medians_by_histogram": lambda r: panels.county_medians(r.panel_rows),
    "export_lender_sample": lambda r: exports.lender_sample(r.lender_county_year, r.spark),
    "export_manifest": _manifest,
    "profile_by_year": lambda r: profile.by_year(_published_counties(r)),
    "profile_top_counties": lambda r: profile.top_counties(_published_counties(r)),
    "profile_top_lender_counts": lambda r: profile.top_lender_counts(_published_counties(r)),
    "export_order": _export_order,
    "typed_profile_by_year": lambda r: profile.by_year(_typed_counties(r).where(F.col(CORRUPT).isNull())),
    "typed_profile_top_counties": lambda r: profile.top_counties(_typed_counties(r)),
    "typed_parse_counts": lambda r: profile.parse_counts(_spoiled_counties(r)),
    "profile_small_sample_coverage": _small_sample_coverage,
    "profile_formatted_by_year": lambda r: profile.formatted_by_year(_published_counties(r)),
    "profile_sample_coverage": lambda r: profile.sample_coverage(r.published("lender_county_year_sample_csv")),
}
