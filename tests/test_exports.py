"""Published files: read-back, ledger statuses, and the profile of what was published."""

from countyloom.plans import exports, profile
from countyloom.plans.pipeline import Run
from countyloom.sources.files import read_published_csv


def by_label(manifest):
    return {r["label"]: r for r in manifest.collect()}


def test_outputs_read_back_equal_to_their_tables(run, tmp_path):
    root = str(tmp_path / "out")
    manifest = by_label(run.publish(root, include_large_csv=True))
    assert {r["status"] for r in manifest.values()} == {"exported"}
    lender = exports.lender_export(run.lender_county_year, run.spark)
    stored = run.spark.read.parquet(f"{root}/lender_county_year_parquet")
    assert stored.columns == lender.columns and len(stored.columns) == 28
    assert stored.exceptAll(lender).isEmpty() and lender.exceptAll(stored).isEmpty()
    county = exports.county_export(run.county_year_lending, run.spark)
    text = read_published_csv(run.spark, f"{root}/county_year_lending_csv")
    assert text.columns == county.columns and len(text.columns) == 14
    typed = text.select(*[text[c].cast(t) for c, t in county.dtypes])
    assert typed.exceptAll(county).isEmpty() and typed.count() == county.count()
    assert manifest["lender_county_year_parquet"]["row_count"] == lender.count()
    assert manifest["lender_county_year_csv_gz"]["compression"] == "gzip"
    assert all(r["file_size_bytes"] > 0 and r["finished_at"] >= r["started_at"] for r in manifest.values())
    listed = read_published_csv(run.spark, f"{root}/export_manifest")
    assert listed.columns == ["label", "table_name", "output_path", "format", "compression", "status", "row_count", "file_size_bytes", "started_at", "finished_at", "error"]


def test_existing_outputs_are_skipped_unless_forced(run, tmp_path):
    root = str(tmp_path / "out")
    first = by_label(run.publish(root))
    again = by_label(run.publish(root))
    assert {r["status"] for r in again.values()} == {"skipped_existing"}
    assert {k: r["row_count"] for k, r in again.items()} == {k: r["row_count"] for k, r in first.items()}
    assert {r["started_at"] for r in again.values()} == {None}
    assert {r["status"] for r in by_label(run.publish(root, force=True)).values()} == {"exported"}


def test_unfinished_outputs_are_written_again(run, tmp_path):
    begun = tmp_path / "out" / "county_year_lending_csv"
    begun.mkdir(parents=True)
    (begun / "part-00000.csv").write_text("activity_year\n2010\n")
    first = by_label(run.publish(str(tmp_path / "out")))
    assert first["county_year_lending_csv"]["status"] == "exported"
    assert first["county_year_lending_csv"]["row_count"] == run.county_year_lending.count()


def test_a_failed_output_is_recorded_and_the_rest_go_on(run, tmp_path):
    county = run.county_year_lending
    plan = [
        exports.Export("bad", "t", county, str(tmp_path / "bad"), "xlsx"),
        exports.Export("broken", "t", county.selectExpr("assert_true(false, 'no') AS x"), str(tmp_path / "broken"), "csv"),
        exports.Export("good", "t", county, str(tmp_path / "good"), "parquet"),
    ]
    found = by_label(exports.run_exports(run.spark, plan, str(tmp_path)))
    assert [found[k]["status"] for k in ("bad", "broken", "good")] == ["failed", "failed", "exported"]
    assert "xlsx" in found["bad"]["error"] and found["bad"]["row_count"] is None


def test_exports_are_in_key_order(run):
    rows = exports.lender_export(run.lender_county_year, run.spark).select("activity_year", "state_fips_2", "county_fips_5", "lender_id").collect()
    order = [tuple((v is None, v) for v in r) for r in rows]
    assert order == sorted(order)


def test_profile_of_an_older_layout(spark):
    published = spark.createDataFrame(
        [("2010", "06037", "10", "5", "2", "1500.5", "3"), ("2010", "06039", "30", "9", "1", "", "8"), ("2011", "06037", "4", "0", "0", "8", "1")],
        "activity_year string, county_fips_5 string, total_applications string, originated_loans string, denied_applications string, total_loan_amount string, lender_count string",
    )
    rows = profile.county_rows(published)
    found = {r["activity_year"]: r for r in profile.by_year(rows).collect()}
    assert (found[2010]["county_count"], found[2010]["total_records"]) == (2, 40)
    assert (found[2010]["origination_share"], found[2010]["denial_share"], found[2010]["other_action_share"]) == (0.35, 0.075, 0.575)
    assert found[2010]["average_record_amount"] == 37 and found[2010]["median_lender_count"] == 8
    assert found[2011]["median_lender_count"] == 1
    text = profile.formatted_by_year(rows).first()
    assert (text["origination_share"], text["average_record_amount"]) == ("0.350", "37")
    assert [tuple(r) for r in profile.top_counties(rows, 2).collect()] == [(30, 2010, "06039", 9, 1, 8), (10, 2010, "06037", 5, 2, 3)]


def test_blank_record_counts_fall_back(spark):
    published = spark.createDataFrame(
        [("2010", "06037", "", "10", "5", "2", "1", "3"), ("2010", "06039", "7", "10", "5", "2", "1", "3")],
        "activity_year string, county_fips_5 string, total_records string, total_applications string, originated_loans string, denied_applications string, total_loan_amount string, lender_count string",
    )
    assert sorted(r["total_records"] for r in profile.county_rows(published).collect()) == [7, 10]


def test_a_published_table_is_exported_without_the_others(spark, run, tmp_path):
    alone = Run(spark, run.annual_root, str(tmp_path), run.sources)
    assert alone.published("county_year_lending_csv").count() == run.county_year_lending.count()
    assert not (tmp_path / "lender_county_year").exists()
    assert [p.name for p in (tmp_path / "published").iterdir()] == ["county_year_lending_csv"]
