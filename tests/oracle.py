"""Side-by-side comparison of a Spark result with DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    if pa.types.is_timestamp(kind):
        return "timestamp"
    return str(kind).replace("decimal128", "decimal")


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr) if columns else []


def difference(df, con, sql: str) -> str | None:
    """What differs between the two results, or None."""
    ours = df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"
    for name in ours.column_names:
        a, b = _kind(ours.schema.field(name).type), _kind(theirs.schema.field(name).type)
        if a != b:
            return f"type of {name}: {a} != {b}"
    left, right = _rows(ours), _rows(theirs)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"row {a} != {b}"
    return None
