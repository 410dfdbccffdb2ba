"""Tables of SQLite files as DataFrames, read in ranges of rowids side by side. The file's path must be the same on the driver and all executors."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rowids of a range, and rows of an Arrow batch.
RANGE, BATCH = 200_000, 10_000
KINDS = {"bigint": (pa.int64(), int), "double": (pa.float64(), float), "string": (pa.string(), str)}


def connect(path: str) -> sqlite3.Connection:
    """Read-only; a missing file raises FileNotFoundError."""
    try:
        return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)
    except sqlite3.OperationalError as e:
        raise FileNotFoundError(path) from e


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def kind_of(declared: str) -> str:
    """The column type by SQLite's affinity rules; decimals, blobs and all others are text."""
    d = declared.upper()
    return "bigint" if "INT" in d else "double" if any(x in d for x in ("REAL", "FLOA", "DOUB", "NUM")) else "string"


def list_tables(path: str) -> list[str]:
    with closing(connect(path)) as con:
        return [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type IN ('table', 'view') AND name NOT LIKE 'sqlite_%' ORDER BY name")]


def table_schema(path: str, table: str) -> list[tuple[str, str]]:
    with closing(connect(path)) as con:
        return [(r[1], kind_of(r[2])) for r in con.execute(f"PRAGMA table_info({quoted(table)})")]


def value(v, make):
    """v as the column's type; what can't be read as it becomes null."""
    if v is None or type(v) is make:
        return v
    try:
        return v.decode("utf-8", "replace") if isinstance(v, bytes) else make(v)
    except (TypeError, ValueError, OverflowError):
        return None


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table whole. Views and tables without rowids are read by one task, in batches."""
    columns = table_schema(path, table)
    if not columns:
        raise ValueError(f"no table {table!r} in {path}")
    with closing(connect(path)) as con:
        try:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(table)}").fetchone()
        except sqlite3.OperationalError:
            low = high = None
    select = f"SELECT {', '.join(quoted(c) for c, _ in columns)} FROM {quoted(table)}"
    by_range = isinstance(low, int)
    schema = pa.schema([(c, KINDS[k][0]) for c, k in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                with closing(connect(path)) as con:
                    rows = con.execute(select + " WHERE rowid >= ? AND rowid < ?", (start, start + RANGE)) if by_range else con.execute(select)
                    while part := rows.fetchmany(BATCH):
                        arrays = [pa.array([value(v, KINDS[k][1]) for v in vs], KINDS[k][0]) for vs, (_, k) in zip(zip(*part, strict=True), columns, strict=True)]
                        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    n_ranges = (high - low) // RANGE + 1 if by_range else 1
    starts = spark.range(low, low + n_ranges * RANGE, RANGE, numPartitions=min(n_ranges, 10_000)) if by_range else spark.range(1)
    return starts.mapInArrow(run, ", ".join(f"`{c.replace('`', '``')}` {k}" for c, k in columns))


def register(spark: SparkSession, path: str) -> list[str]:
    """Every table as a temporary view, so that spark.sql() can join them."""
    names = list_tables(path)
    for name in names:
        read_table(spark, path, name).createOrReplaceTempView(name)
    return names
