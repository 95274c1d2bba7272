"""Time the headline jobs over the derived annual files and print one JSON line.

BENCH_SF_DIR names the test tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
Every job is written in full: to the shared folder where it is an export, else to a sink that discards rows. The three
exports are also timed on panels of the published sizes (58,006 and BENCH_PANEL_ROWS, default 8,923,506 rows), which are
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.plans import exports
from countyloom.reports import REPORTS, open_run
from countyloom.sources.storage import shared_folder
from countyloom.streaming.arrivals import ingest

REPORT_JOBS = [
    "loan_years",
    "loan_years_geo",
    "year_summary",
    "county_year_lending",
    "lender_county_year",
    "county_year_missing_geo_qa",
    "lender_panel_missing_geo_qa",
    "lender_panel_missing_lender_qa",
    "geo_validation_by_year",
    "geo_source_flags",
    "qa_county_patterns",
    "lender_panel_by_year",
    "lender_panel_reconciliation",
    "ready_reconciliation_total",
    "ready_lender_coverage",
    "export_lender_sample",
    "profile_by_year",
]


PUBLISHED = {
    "county_year_lending_csv": 0.260,
    "lender_county_year_parquet": 13.288,
    "lender_county_year_sample_csv": 50.257,
}


def panel_of(spark: SparkSession, like: DataFrame, rows: int, counties: int) -> DataFrame:
    """A panel with the columns of `like` and `rows` rows over 18 years; unique by its keys."""
    n = F.col("id")
    county = (F.floor(n / 18) % counties).cast("int")
    keys: dict[str, Column] = {
        "activity_year": (n % 18 + 2007).cast("int"),
        "state_fips_2": F.lpad((county % 56 + 1).cast("string"), 2, "0"),
        "county_fips_5": F.concat(F.lpad((county % 56 + 1).cast("string"), 2, "0"), F.lpad(F.floor(county / 56).cast("string"), 3, "0")),
        "lender_id": F.concat(F.lit("LEI"), F.lpad(F.floor(n / (18 * counties)).cast("string"), 17, "0")),
    }
    made = [
        keys.get(c, (F.xxhash64(F.lit(c), "id") % 1000 + 1000).cast(kind) if kind != "string" else F.lit("lei")).alias(c)
        for c, kind in like.dtypes
    ]
    return spark.range(rows).select(*made)


def discard(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}

    def timed(name, job) -> None:
        begun = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - begun, 3)

    timed("open_run", lambda: open_run(spark, sf_dir))
    run = open_run(spark, sf_dir)
    timed("ingest_annual", lambda: ingest(spark, run.sources, f"{shared_folder(spark)}/annual"))
    timed("store_code_cells", lambda: run.code_cells)
    timed("store_panel_rows", lambda: run.panel_rows)
    timed("store_county_panel", lambda: run.county_year_lending)
    timed("store_lender_panel", lambda: run.lender_county_year)
    timed("store_exclusions", lambda: (run.county_missing_geo, run.lender_missing_geo, run.lender_missing_lender))
    timed("publish_all", run.publish)
    for name in REPORT_JOBS:
        timed(name, lambda report=name: discard(REPORTS[report](run)))
    for export in exports.planned_exports(spark, run.county_year_lending, run.lender_county_year, f"{shared_folder(spark)}/published"):
        timed(f"write_{export.label}", lambda e=export: exports.run_export(spark, e))
    large = f"{shared_folder(spark)}/large"
    panels = {"county": (run.county_year_lending, 58_006), "lender": (run.lender_county_year, int(os.environ.get("BENCH_PANEL_ROWS", "8923506")))}
    for name, (like, size) in panels.items():
        panel_of(spark, like, size, 3_223).write.parquet(f"{large}/{name}")
    stored = [spark.read.parquet(f"{large}/{name}") for name in panels]
    ratios = {}
    for export in exports.planned_exports(spark, *stored, f"{large}/published"):
        timed(f"published_size_{export.label}", lambda e=export: exports.run_export(spark, e))
        ratios[export.label] = round(seconds[f"published_size_{export.label}"] / PUBLISHED[export.label], 2)
    county_rows = run.county_year_lending.count()
    rows = run.loan_years.count()
    lender_rows = run.lender_county_year.count()
    jobs = sum(v for k, v in seconds.items() if k != "open_run" and not k.startswith("published_size_"))
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(jobs, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "loan_rows": rows,
                "county_panel_rows": county_rows,
                "lender_panel_rows": lender_rows,
                "ratios": ratios,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
