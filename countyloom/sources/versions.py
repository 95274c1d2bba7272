"""Tables that are replaced as a whole, safely: a new version is a folder of its own, and counts from its success marker on.

A reader takes the latest finished version. A write that fails, or a process that dies, leaves the former version as it was;
what it left behind has no marker and is written over by nobody.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from countyloom.sources.files import hadoop_path


def versions(spark: SparkSession, folder: str) -> list[tuple[int, str, str]]:
    """(number, tag, path) of the finished versions below a folder, oldest first. One listing, and one look for each."""
    system, target = hadoop_path(spark, folder)
    if not system.exists(target):
        return []
    found = []
    for status in system.listStatus(target):
        path = status.getPath()
        number, _, rest = path.getName().partition("-")
        if number.startswith("v") and number[1:].isdigit() and system.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            found.append((int(number[1:]), rest.rpartition("-")[0], path.toString()))
    return sorted(found)


def current(spark: SparkSession, folder: str, tag: str | None = None) -> str | None:
    """Path of the latest finished version; None if there is none, or if it doesn't carry the wanted tag."""
    found = versions(spark, folder)
    if not found or (tag is not None and found[-1][1] != tag):
        return None
    return found[-1][2]


def write_version(frame: DataFrame, folder: str, write: Callable[[DataFrame, str], None], tag: str = "") -> str:
    """Writes the next version by `write(frame, path)` and returns its path. The tag says what it was made from."""
    spark = frame.sparkSession
    latest = max((n for n, _, _ in versions(spark, folder)), default=0)
    path = f"{folder}/v{latest + 1:09d}-{tag}-{uuid.uuid4().hex[:8]}"
    write(frame, path)
    return path


def drop_old(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Deletes finished versions but the latest `keep`; returns how many. Readers of those must be done."""
    old = versions(spark, folder)[:-keep] if keep > 0 else []
    for _, _, path in old:
        system, target = hadoop_path(spark, path)
        system.delete(target, True)
    return len(old)
