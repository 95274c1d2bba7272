"""Compare a Spark result with the SQL twin, ignoring row and column order."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _sorted(rows, order):
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows], key=repr)


def differences(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return [f"columns differ: {sorted(frame.columns)} / {sorted(names)}"]
    ours = [tuple(r) for r in frame.collect()]
    by_name = sorted(names)
    out = []
    expected = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in frame.dtypes:
        if expected.get(kind) != types[name]:
            out.append(f"type of {name}: {kind} / {types[name]}")
    a = _sorted(ours, [frame.columns.index(n) for n in by_name])
    b = _sorted(theirs, [names.index(n) for n in by_name])
    if len(a) != len(b):
        out.append(f"rows: {len(a)} / {len(b)}")
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        out.append(f"values {by_name}: {only_a} / {only_b}")
    return out
