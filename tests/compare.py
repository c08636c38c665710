"""Compare a Spark result with DuckDB on the same tables, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb

# Result types that count as the same in both engines.
FAMILIES = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int",
    "bigint": "long", "float": "double", "double": "double", "string": "text",
    "varchar": "text", "boolean": "boolean", "date": "date", "binary": "blob", "blob": "blob",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp",
    "timestamp_s": "timestamp", "timestamp_ns": "timestamp",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (bytearray, bytes)):
        return bytes(value).hex()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value + 0.0)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def check(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]).lower() for d in cursor.description}
    want = normal_rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    for field in df.schema:
        mine = FAMILIES.get(field.dataType.simpleString())
        theirs = FAMILIES.get(kinds[field.name])
        if mine is None or mine != theirs:
            return f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}"
    got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None
