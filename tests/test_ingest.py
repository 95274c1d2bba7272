"""Annual files: layouts, archives, restart and failure."""

import gzip
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from countyloom.plans.canonical import annual_rows, loan_years, with_prefix
from countyloom.plans.pipeline import start
from countyloom.plans.readiness import column_metadata
from countyloom.plans.schema_audit import common_columns, era_only_columns, type_differences, write_audit
from countyloom.sources.catalog import schema_rows
from countyloom.sources.files import AnnualSource, leaf, read_ledger, read_raw, read_year
from countyloom.streaming.arrivals import ingest, revalidate, stored_ledger

PRE_HEADER = (
    "as_of_year,respondent_id,state_code,county_code,census_tract_number,loan_amount_000s,loan_type,loan_purpose,"
    "owner_occupancy,action_taken,applicant_income_000s,applicant_race_1,msamd"
)
POST_HEADER = (
    "activity_year,lei,derived_msa-md,state_code,county_code,census_tract,loan_amount,loan_type,loan_purpose,"
    "occupancy_type,action_taken,income,applicant_race-1"
)
PRE_STORED = ["activity_year", "source_era", "lei_or_respondent_id", *PRE_HEADER.split(",")]
POST_STORED = ["activity_year", "source_era", "lei_or_respondent_id", "raw_activity_year", *POST_HEADER.split(",")[1:]]


def pre_text(year, n=3):
    return PRE_HEADER + "\n" + "".join(f"{year},{i:010d},06,037,12.00,{100 + i},1,1,1,1,NA,5,\n" for i in range(n))


def post_text(year, n=3):
    return POST_HEADER + "\n" + "".join(f"{year},LEI{i},31080,CA,06037,,{5000 * i}.0,1,31,1,3,80,5\n" for i in range(n))


@pytest.fixture
def files(tmp_path):
    def csv(year, text):
        path = tmp_path / f"loans_{year}.csv"
        path.write_text(text, encoding="utf-8")
        return AnnualSource(year, str(path))

    def archive(year, members):
        path = tmp_path / f"loans_{year}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
            for name, data in members.items():
                out.writestr(name, data)
        return AnnualSource(year, str(path))

    csv.archive = archive
    csv.root = str(tmp_path / "annual")
    return csv


def statuses(ledger):
    return [tuple(r) for r in ledger.orderBy("year").select("year", "conversion_status", "row_count").collect()]


def test_clashing_raw_names_are_kept_under_another_name(spark, files):
    raw, _ = read_raw(spark, files(2018, post_text(2018)))
    out = with_prefix(raw, "post_2018")
    assert out.columns == POST_STORED
    assert out.columns[:4] == ["activity_year", "source_era", "lei_or_respondent_id", "raw_activity_year"]
    assert dict(out.dtypes)["activity_year"] == "int" and dict(out.dtypes)["raw_activity_year"] == "string"
    assert "derived_msa-md" in out.columns and out.first()["applicant_race-1"] == "5"


def test_archive_and_plain_file_give_the_same_rows(spark, files):
    text = pre_text(2010, 50)
    plain, _ = read_raw(spark, files(2010, text))
    packed, member = read_raw(spark, files.archive(2010, {"readme.txt": b"x", "data/loans.CSV": text.encode()}))
    assert member == "data/loans.CSV"
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, packed.collect()), key=repr)
    assert plain.first()["state_code"] == "06" and plain.first()["msamd"] is None


def test_archive_values_with_quotes_newlines_and_bad_bytes(spark, files):
    data = b'as_of_year,respondent_id,state_code,county_code\n2010,"a ""b"", c","line\nbreak",\xff1\n2010,,"",2\n'
    rows, _ = read_raw(spark, files.archive(2010, {"l.csv": data}))
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(
        [("2010", 'a "b", c', "line\nbreak", "�1"), ("2010", None, None, "2")], key=repr
    )


def test_quotes_in_csv_files(spark, files):
    source = files(2018, 'activity_year,lei,state_code,county_code\n2018,"x ""q"" y",,""\n')
    rows, _ = read_raw(spark, source)
    row = rows.first()
    assert row["lei"] == 'x "q" y' and row["state_code"] is None and row["county_code"] in (None, "")


def test_gzip_files_are_read_directly(spark, tmp_path, files):
    path = tmp_path / "loans_2019.csv.gz"
    path.write_bytes(gzip.compress(post_text(2019).encode()))
    assert read_raw(spark, AnnualSource(2019, str(path)))[0].count() == 3


def test_years_outside_the_range_are_refused(spark, files):
    with pytest.raises(ValueError):
        ingest(spark, [AnnualSource(2006, "x.csv")], files.root)


def test_run_skips_valid_years_and_rewrites_a_broken_one(spark, files):
    sources = [
        files.archive(2016, {"l.csv": pre_text(2016, 4).encode()}),
        files(2017, pre_text(2017, 5)),
        files(2018, post_text(2018, 6)),
    ]
    assert statuses(ingest(spark, sources, files.root)) == [(2016, "converted", 4), (2017, "converted", 5), (2018, "converted", 6)]
    before = {y: {p.name for p in Path(leaf(files.root, y)).glob("*.parquet")} for y in (2016, 2017, 2018)}
    for part in Path(leaf(files.root, 2017)).glob("*.parquet"):
        part.write_bytes(b"not parquet")
    assert statuses(ingest(spark, sources, files.root)) == [
        (2016, "skipped_existing", 4), (2017, "converted", 5), (2018, "skipped_existing", 6)
    ]
    after = {y: {p.name for p in Path(leaf(files.root, y)).glob("*.parquet")} for y in (2016, 2017, 2018)}
    assert before[2016] == after[2016] and before[2018] == after[2018] and before[2017] != after[2017]
    assert read_year(spark, files.root, 2017).count() == 5
    assert statuses(ingest(spark, sources, files.root, force=True)) == [(2016, "converted", 4), (2017, "converted", 5), (2018, "converted", 6)]
    assert annual_rows(spark, files.root).count() == 15


def test_run_stops_at_the_first_failure_and_can_be_resumed(spark, files):
    good, late = files(2016, pre_text(2016)), files(2018, post_text(2018))
    two = files.archive(2017, {"a.csv": b"x\n1\n", "b.csv": b"x\n1\n"})
    ledger = ingest(spark, [good, two, late], files.root)
    assert statuses(ledger) == [(2016, "converted", 3), (2017, "failed", None)]
    assert "exactly one CSV" in ledger.where("year = 2017").first()["error"]
    assert statuses(stored_ledger(spark, files.root)) == statuses(ledger)
    fixed = files(2017, pre_text(2017))
    assert statuses(ingest(spark, [good, fixed, late], files.root)) == [
        (2016, "skipped_existing", 3), (2017, "converted", 3), (2018, "converted", 3)
    ]


def test_malformed_rows_fail_the_year(spark, files):
    text = post_text(2018) + "2018,too,few\n"
    assert statuses(ingest(spark, [files(2018, text)], files.root)) == [(2018, "failed", None)]


def test_empty_file_fails_validation(spark, files):
    ledger = ingest(spark, [files(2018, POST_HEADER + "\n")], files.root)
    assert [r["conversion_status"] for r in ledger.collect()] in (["validation_failed"], ["failed"])


def test_revalidation_checks_every_year(spark, files):
    sources = [files(2017, pre_text(2017)), files(2018, post_text(2018))]
    ingest(spark, sources[1:], files.root)
    assert [r[1] for r in statuses(revalidate(spark, sources, files.root))] == ["failed", "converted"]


def test_era_follows_the_file_not_the_row(spark, files):
    text = pre_text(2016) + "2019,7,06,037,12.00,1,1,1,1,1,NA,5,\nx,8,06,037,12.00,1,1,1,1,1,NA,5,\n"
    run = start(spark, [files(2016, text)], files.root)
    found = {(r["activity_year"], r["source_era"]) for r in run.loan_years.collect()}
    assert found == {(2016, "pre_2018"), (2019, "pre_2018"), (None, "pre_2018")}


def test_columns_may_come_in_another_order(spark, files):
    header = POST_HEADER.split(",")
    swapped = ",".join(reversed(header)) + "\n" + ",".join(reversed("2019,LEI9,1,CA,06037,,7.0,1,31,1,3,80,5".split(","))) + "\n"
    ingest(spark, [files(2018, post_text(2018)), files(2019, swapped)], files.root)
    rows = loan_years(spark, files.root).where("activity_year = 2019").collect()
    assert [(r["lender_id"], r["loan_amount"]) for r in rows] == [("LEI9", 7.0)]


def test_schema_sets_over_both_layouts(spark, files, tmp_path):
    ingest(spark, [files(2016, pre_text(2016)), files(2017, pre_text(2017)), files(2018, post_text(2018))], files.root)
    schema = schema_rows(spark, files.root, [2016, 2017, 2018])
    pre, post = set(PRE_STORED), set(POST_STORED)
    assert {r[0] for r in common_columns(schema).collect()} == pre & post
    only = era_only_columns(schema)
    assert {r["column_name"] for r in only.where(F.col("source_era") == "pre_2018").collect()} == pre - post
    assert {r["column_name"] for r in only.where(F.col("source_era") == "post_2018").collect()} == post - pre
    ledger = stored_ledger(spark, files.root)
    write_audit(spark, schema, ledger, column_metadata(spark, loan_years(spark, files.root), ledger), str(tmp_path / "audit"))
    summary = spark.read.json(str(tmp_path / "audit" / "ledger_summary")).first()
    assert (summary["records"], summary["total_rows"], summary["statuses"]) == (3, 9, "converted")
    race = spark.read.json(str(tmp_path / "audit" / "key_field_availability")).where("logical_field = 'race_fields'")
    assert {(r["activity_year"], r["columns"]) for r in race.collect()} == {
        (2016, "applicant_race_1"), (2017, "applicant_race_1"), (2018, "applicant_race-1")
    }


def test_columns_of_mixed_type_are_reported(spark):
    rows = [(2017, "a", "int", True, 1), (2018, "a", "string", True, 2), (2019, "a", "string", True, 3), (2018, "b", "int", True, 4)]
    schema = spark.createDataFrame(rows, "activity_year int, column_name string, column_type string, nullable boolean, non_null_rows long")
    assert {tuple(r) for r in type_differences(schema).collect()} == {("a", "int", "2017", 1), ("a", "string", "2018,2019", 5)}


def test_archive_years_equal_plain_years(spark, files):
    """Years from archives, written by one job, give the rows that plain files give."""
    years = (2014, 2015, 2016, 2017)
    packed = [files.archive(y, {"l.csv": pre_text(y, 5 + y % 3).encode()}) for y in years]
    plain = [files(y, pre_text(y, 5 + y % 3)) for y in years]
    found = []
    for sources, name in ((packed, "zip"), (plain, "csv")):
        assert statuses(ingest(spark, sources, f"{files.root}-{name}")) == [(y, "converted", 5 + y % 3) for y in years]
        found.append(sorted(map(str, loan_years(spark, f"{files.root}-{name}").collect())))
    assert found[0] == found[1]


def test_a_bad_year_does_not_take_its_neighbours_along(spark, files):
    """One job writes three years; when it fails, the years before the bad one are converted and the run ends there."""
    sources = [files(2018, post_text(2018)), files(2019, post_text(2019) + "2019,too,few\n"), files(2020, post_text(2020))]
    assert statuses(ingest(spark, sources, files.root)) == [(2018, "converted", 3), (2019, "failed", None)]


def test_a_second_file_with_other_columns_is_seen(spark, files):
    ingest(spark, [files(2018, post_text(2018))], files.root)
    extra = spark.createDataFrame([(2018, "LEI9", "x")], "activity_year int, lei_or_respondent_id string, extra string")
    extra.write.mode("append").parquet(leaf(files.root, 2018))
    schema = {r["column_name"]: r["non_null_rows"] for r in schema_rows(spark, files.root, [2018]).collect()}
    assert schema["extra"] == 1 and schema["lei_or_respondent_id"] == 4


def test_files_of_alternating_writers_are_told_apart_in_few_merges(spark, tmp_path, monkeypatch):
    from countyloom.sources import files

    root = str(tmp_path / "drifted")
    for kind in ("int", "string"):
        rows = spark.range(0, 160, 1, 16).select(F.col("id").cast(kind).alias("x"), F.lit(2015).alias("file_year"))
        rows.write.mode("append").partitionBy("file_year").parquet(root)
    paths = [r["path"] for r in files.dataset_files(spark, root).orderBy("path").collect()]
    calls, whole = [], files._uniform
    monkeypatch.setattr(files, "_uniform", lambda *a: calls.append(1) or whole(*a))
    groups = files.uniform_groups(spark, root, paths)
    assert len(paths) == 32 and len(groups) == 2 and len(calls) == 3
    assert sorted(p for _, some in groups for p in some) == sorted(paths)


def test_writers_stay_open_only_while_a_table_is_written(spark):
    from countyloom.sources import storage

    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), storage.unsorted_partitions(spark):
        assert spark.conf.get(key) == str(storage.OPEN_WRITERS)
        raise ValueError
    assert spark.conf.get(key) == before
