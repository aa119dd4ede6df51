"""Run a query in Spark and its SQL twin in DuckDB, and compare the rows."""

import glob
import os

import duckdb


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _normal(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.9g}"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    kept = [tuple(_normal(row[i]) for i in order) for row in rows]
    return sorted(kept, key=repr)


def differences(frame, connection, sql):
    """Empty when names, types of numbers and rows agree."""
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    expected = _rows(names, found.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    if len(expected) != len(actual):
        return [f"{len(actual)} rows against {len(expected)}"]
    pairs = [(a, e) for a, e in zip(actual, expected) if repr(a) != repr(e)]
    return [f"{len(pairs)} rows differ, first {pairs[0]}"] if pairs else []
