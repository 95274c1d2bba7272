"""Files that arrive as a stream: cut off, started again, and added to."""

import pytest
from pyspark.sql import functions as F

from countyloom.streaming import file_stream
from countyloom.streaming.file_stream import convert_arrived, converted_rows, read_converted

PRE = "as_of_year,respondent_id,state_code,county_code,census_tract_number,loan_amount_000s,loan_type,loan_purpose,owner_occupancy,action_taken,applicant_income_000s"
POST = "activity_year,lei,state_code,county_code,census_tract,loan_amount,loan_type,loan_purpose,occupancy_type,action_taken,income"


@pytest.fixture
def arrivals(spark, tmp_path):
    class Arrivals:
        def put(self, year, n, name="part.csv", header=None):
            folder = tmp_path / "raw" / f"file_year={year}"
            folder.mkdir(parents=True, exist_ok=True)
            header = header or (PRE if year <= 2017 else POST)
            rows = [f"{year},{name}{i},06,037,,{i},1,1,1,1,NA" for i in range(n)]
            (folder / name).write_text("\n".join([header, *rows]) + "\n")

        def convert(self, root="rows"):
            return convert_arrived(spark, str(tmp_path / "raw"), str(tmp_path / root), str(tmp_path / f"{root}-checkpoints"))

        def rows(self, root="rows"):
            return sorted(map(str, read_converted(spark, str(tmp_path / root)).drop("batch").collect()))

        def counts(self, root="rows"):
            return {r.year: (r.row_count, r.batches) for r in converted_rows(spark, str(tmp_path / root)).collect()}

    return Arrivals()


def test_new_files_are_converted_once(arrivals):
    assert arrivals.convert() == []
    arrivals.put(2016, 5)
    assert arrivals.convert() == ["pre_2018"]
    arrivals.put(2017, 4)
    arrivals.put(2018, 3)
    arrivals.put(2016, 2, "late.csv")
    assert arrivals.convert() == ["pre_2018", "post_2018"]
    assert arrivals.convert() == ["pre_2018", "post_2018"]
    assert arrivals.counts() == {2016: (7, 2), 2017: (4, 1), 2018: (3, 1)}


def test_a_batch_that_was_cut_off_is_replaced(arrivals, monkeypatch):
    for year in (2015, 2016, 2018, 2019):
        arrivals.put(year, year - 2000)
    whole = file_stream.write_batch

    def cut_off(rows, batch, root):
        whole(rows.where(F.col("file_year") % 2 == 0), batch, root)
        raise RuntimeError("lost")

    monkeypatch.setattr(file_stream, "write_batch", cut_off)
    with pytest.raises(Exception, match="lost"):
        arrivals.convert()
    assert arrivals.counts() == {2016: (16, 1)}

    def after_writing(rows, batch, root):
        whole(rows, batch, root)
        if arrivals.counts().keys() >= {2018}:
            raise RuntimeError("lost again")

    monkeypatch.setattr(file_stream, "write_batch", after_writing)
    with pytest.raises(Exception, match="lost again"):
        arrivals.convert()
    monkeypatch.undo()
    arrivals.convert()
    arrivals.convert("clean")
    assert arrivals.counts() == {y: (y - 2000, 1) for y in (2015, 2016, 2018, 2019)}
    assert arrivals.rows() == arrivals.rows("clean")


def test_another_header_fails_its_batch(arrivals):
    arrivals.put(2016, 2)
    arrivals.put(2017, 2, header=PRE.replace("loan_type", "kind"))
    with pytest.raises(Exception, match="header"):
        arrivals.convert()
