"""Restartable ingest of annual files.

A run skips years that are already valid and rewrites missing or invalid ones. Neighbouring years of one layout are written
by one job, so that a cluster reads their files side by side. The ledger is flushed after every job and the run stops at
the first year that fails, so it can simply be started again.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession

from countyloom.plans.ingest import Opened, ledger_frame, ledger_rows, open_source, write_years, year_exists
from countyloom.sources.files import AnnualSource, read_ledger
from countyloom.sources.versions import current, write_version


def ledger_path(root: str) -> str:
    """Folder of the ledger's versions. The underscore keeps it out of reads of the dataset itself."""
    return f"{root}/_ledger"


def stored_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The ledger as it was last flushed; empty before the first time."""
    path = current(spark, ledger_path(root))
    return ledger_frame(spark, []) if path is None else read_ledger(spark, path)


def _flush(spark: SparkSession, rows: list[dict], root: str) -> None:
    """The ledger so far as a new version; until it is whole, the former one counts."""
    write_version(ledger_frame(spark, rows).coalesce(1), ledger_path(root), lambda frame, path: frame.write.json(path))


def _written(files: list[Opened], root: str) -> list[Opened]:
    """The files as they were written; if their common job fails, one by one up to the first that fails by itself."""
    if len(files) > 1:
        try:
            write_years(files, root)
            return files
        except Exception:  # found out below, file by file
            pass
    done = []
    for f in files:
        try:
            write_years([f], root)
            done.append(f)
        except Exception as error:
            return [*done, Opened(f.source, error=str(error))]
    return done


def ingest(spark: SparkSession, sources: Iterable[AnnualSource], root: str, force: bool = False) -> DataFrame:
    """Ingest annual files in the given order; returns the ledger (at most one row per year).

    A year whose file cannot be opened, read or validated ends the ledger. Years that the same job had already written
    after it stay stored, and the next run finds them.
    """
    sources = list(sources)
    for source in sources:
        _ = source.era  # a file year outside the supported range is an error, not a ledger row
    opened = [open_source(spark, s) for s in sources]
    there = [f for f in opened if not force and f.error is None and year_exists(spark, root, f.source.file_year)]
    valid = {
        r["year"]: {**r, "conversion_status": "skipped_existing"}
        for r in ledger_rows(spark, root, there)
        if r["error"] is None
    }
    rows: list[dict] = []
    for (skipped, _), files in groupby(opened, lambda f: (f.source.file_year in valid, f.layout)):
        files = list(files)
        if skipped:
            rows += [valid[f.source.file_year] for f in files]
        else:
            rows += ledger_rows(spark, root, files if files[0].error else _written(files, root))
        broken = next((i for i, r in enumerate(rows) if r["error"] is not None), None)
        rows = rows if broken is None else rows[: broken + 1]
        _flush(spark, rows, root)
        if broken is not None:
            break
    return ledger_frame(spark, rows)


def revalidate(spark: SparkSession, sources: Iterable[AnnualSource], root: str) -> DataFrame:
    """Validate written years without converting anything; refreshes the ledger and checks every year."""
    rows = ledger_rows(spark, root, [open_source(spark, s) for s in sources])
    _flush(spark, rows, root)
    return ledger_frame(spark, rows)
