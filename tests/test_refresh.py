"""Panels refreshed by year, against panels built at once; and tables that are replaced safely."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from countyloom.plans import canonical, panels, refresh
from countyloom.operators.geography import loan_years_geo
from countyloom.plans.pipeline import Run
from countyloom.sources import versions
from countyloom.sources.files import AnnualSource
from countyloom.streaming import arrivals
from countyloom.streaming.arrivals import ingest, stored_ledger

PRE = "as_of_year,respondent_id,state_code,county_code,census_tract_number,loan_amount_000s,loan_type,loan_purpose,owner_occupancy,action_taken,applicant_income_000s"
POST = "activity_year,lei,state_code,county_code,census_tract,loan_amount,loan_type,loan_purpose,occupancy_type,action_taken,income"


def text(year, row_years, amount=100):
    rows = []
    for i, y in enumerate(row_years):
        place = ("06", "037") if i % 3 else ("NA", "NA")
        if year <= 2017:
            rows.append(f"{y},{i % 4:010d},{place[0]},{place[1]},1.00,{amount + i},1,1,1,{i % 8 + 1},NA")
        else:
            rows.append(f"{y},LEI{i % 4},CA,{'06037' if i % 3 else 'NA'},06037000100,{amount + i}.0,1,31,1,{i % 8 + 1},NA")
    return "\n".join([PRE if year <= 2017 else POST, *rows]) + "\n"


@pytest.fixture
def world(spark, tmp_path):
    class World:
        annual, root = str(tmp_path / "annual"), str(tmp_path / "panels")
        files: dict[int, str] = {}

        def put(self, year, row_years, **more):
            path = tmp_path / f"{year}.csv"
            path.write_text(text(year, row_years, **more))
            self.files[year] = str(path)
            ingest(spark, [AnnualSource(year, str(path))], self.annual, force=True)

        def refresh(self):
            return {r.activity_year: r.reason for r in refresh.refresh(spark, self.annual, self.root).collect()}

        def stored(self, name="county_year_lending"):
            return {p.relative_to(self.root).parts[1]: (p.name, p.stat().st_mtime_ns) for p in Path(self.root, name).rglob("*.parquet")}

        def check(self):
            rows = loan_years_geo(canonical.loan_years(spark, self.annual), spark).select(*panels.ROW_COLUMNS)
            for name, build in refresh.PANELS.items():
                whole, kept = build(rows), refresh.read_panel(spark, self.root, name)
                assert whole.columns == kept.columns and whole.dtypes == kept.dtypes
                assert sorted(map(str, whole.collect())) == sorted(map(str, kept.collect())), name

    world = World()
    world.files = {}
    return world


def test_a_file_rewrites_the_years_of_its_rows_only(world):
    world.put(2015, [2015] * 9 + [""] * 2)
    world.put(2016, [2016] * 8 + [2017])
    world.put(2018, [2018] * 7)
    assert world.refresh() == dict.fromkeys([2015, 2016, 2017, 2018, None], "changed")
    world.check()
    assert world.refresh() == {}
    before = world.stored()
    world.put(2019, [2019] * 6 + [2018, ""])
    assert world.refresh() == dict.fromkeys([2018, 2019, None], "changed")
    world.check()
    after = world.stored()
    assert {y for y in after if after[y] != before.get(y)} == {"activity_year=2018", "activity_year=2019", "activity_year=__HIVE_DEFAULT_PARTITION__"}


def test_rows_that_leave_a_year_are_taken_out(world):
    world.put(2016, [2016] * 8 + [2031, 2031])
    world.put(2017, [2017] * 5)
    world.refresh()
    world.put(2016, [2016] * 6, amount=500)
    assert world.refresh() == {2016: "changed", 2031: "emptied"}
    world.check()
    assert "activity_year=2031" not in world.stored()
    shutil.rmtree(Path(world.annual, "source_era=pre_2018", "file_year=2017"))
    assert world.refresh() == {2017: "emptied"}
    world.check()


def test_a_refresh_that_breaks_is_done_again(world, monkeypatch):
    world.put(2016, [2016] * 8)
    world.refresh()
    world.put(2017, [2017] * 5 + [2016])
    monkeypatch.setitem(refresh.PANELS, "lender_missing_geo", lambda rows: rows.select("activity_year", F.raise_error("lost").cast("int").alias("x")))
    with pytest.raises(Exception, match="lost"):
        world.refresh()
    monkeypatch.undo()
    assert world.refresh() == {2016: "changed", 2017: "changed"}
    world.check()


def _parquet(frame, path):
    frame.write.parquet(path)


def test_a_failed_write_leaves_the_former_version(spark, tmp_path):
    folder = str(tmp_path / "table")
    assert versions.current(spark, folder) is None
    first = versions.write_version(spark.range(3), folder, _parquet, "a")
    with pytest.raises(Exception, match="lost"):
        versions.write_version(spark.range(2).select(F.raise_error("lost").cast("int")), folder, _parquet, "b")
    assert versions.current(spark, folder).endswith(first.rpartition("/")[2]) and versions.current(spark, folder, "b") is None
    (tmp_path / "table" / "v000000009-b-unfinished").mkdir()
    second = versions.write_version(spark.range(5), folder, _parquet, "b")
    assert spark.read.parquet(versions.current(spark, folder, "b")).count() == 5
    assert versions.drop_old(spark, folder, keep=1) == 1 and not Path(first).exists() and Path(second).exists()


def test_another_run_finds_the_stored_tables(spark, tmp_path, world):
    world.put(2017, [2017] * 5)
    one = Run(spark, world.annual, str(tmp_path / "tables"))
    wanted = one.county_year_lending.collect()
    two = Run(spark, world.annual, str(tmp_path / "tables"))
    two.__dict__["panel_rows"] = None  # not to be asked for

    def never():
        raise AssertionError("built again")

    assert two.stored("county_year_lending", never).collect() == wanted
    with pytest.raises(ValueError):
        two.rebuild("county_year_lending", lambda: (_ for _ in ()).throw(ValueError("no rows")))
    with pytest.raises(Exception, match="lost"):
        two.rebuild("county_year_lending", lambda: spark.range(1).select(F.raise_error("lost").cast("int").alias("x")))
    assert Run(spark, world.annual, str(tmp_path / "tables")).stored("county_year_lending", never).collect() == wanted
    world.put(2017, [2017] * 6)
    assert Run(spark, world.annual, str(tmp_path / "tables")).stored("county_year_lending", lambda: spark.range(1)).count() == 1


def test_a_ledger_survives_a_failed_flush(spark, tmp_path, world, monkeypatch):
    world.put(2017, [2017] * 5)
    before = stored_ledger(spark, world.annual).collect()
    assert [r.year for r in before] == [2017]
    monkeypatch.setattr(arrivals, "ledger_frame", lambda spark, rows: spark.range(1).select(F.raise_error("lost").cast("int").alias("year")))
    with pytest.raises(Exception, match="lost"):
        ingest(spark, [AnnualSource(2017, world.files[2017])], world.annual)
    monkeypatch.undo()
    assert stored_ledger(spark, world.annual).collect() == before


def test_files_that_have_not_arrived_wait_for_the_next_refresh(spark, world):
    for year in (2016, 2017, 2018):
        world.put(year, [year, year, year + 1, ""])
    first = {r.activity_year for r in refresh.refresh(spark, world.annual, world.root, arrived=[2016, 2017]).collect()}
    assert first == {None, 2016, 2017, 2018}
    assert world.refresh() == {None: "changed", 2018: "changed", 2019: "changed"}
    world.check()
