"""Tables of an SQLite file, read only, in ranges of row numbers."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Spark types by the letters a declared type holds; all else is text. Fixed by SQLite's rules of affinity.
AFFINITY = (("INT", "long"), ("CHAR", "string"), ("CLOB", "string"), ("TEXT", "string"), ("BLOB", "binary"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double"))
ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
ROWS = 2000


def connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"{Path(path).resolve().as_uri()}?mode=ro", uri=True)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sqlite_table(spark: SparkSession, path: str, name: str, rows_a_task: int = 1_000_000) -> DataFrame:
    """All rows of a table whose file every executor can open; a task reads a range of row numbers.

    Values are cast to their column's declared type; a table without row numbers is refused, an empty one gives no rows."""
    with closing(connect(path)) as db:
        columns = [(c[1], next((t for mark, t in AFFINITY if mark in (c[2] or "").upper()), "string")) for c in db.execute(f"PRAGMA table_info({quoted(name)})")]
        if not columns:
            raise ValueError(f"no table {name} in {path}")
        low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(name)}").fetchone()
    ranges = [] if low is None else [(a, min(a + rows_a_task - 1, high)) for a in range(low, high + 1, rows_a_task)]
    cast = {"long": "INTEGER", "string": "TEXT", "binary": "BLOB", "double": "REAL"}
    wanted = ", ".join(f"CAST({quoted(c)} AS {cast[t]})" for c, t in columns)
    types = pa.schema([(c, ARROW[t]) for c, t in columns])
    text = f"SELECT {wanted} FROM {quoted(name)} WHERE rowid BETWEEN ? AND ? ORDER BY rowid"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with closing(connect(path)) as db:
                    found = db.execute(text, (r["a"], r["b"]))
                    while rows := found.fetchmany(ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types.types, strict=True)], schema=types)

    plan = spark.createDataFrame(ranges, "a long, b long").repartition(max(1, len(ranges)))
    return plan.mapInArrow(read, ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in columns))
