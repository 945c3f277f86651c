"""Compares a query with its SQL on DuckDB: names, types, and rows in any order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
import pyarrow as pa


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string_view(t):
        return "string"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_type(t.value_type)}>"
    return str(t)


def _plain(value):
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(table: pa.Table) -> tuple[list[tuple[str, str]], Counter]:
    names = sorted(table.column_names)
    schema = [(n, _type(table.schema.field(n).type)) for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    return schema, Counter(tuple(_plain(v) for v in row) for row in zip(*columns))


def differences(got: pa.Table, want: pa.Table) -> list[str]:
    got_schema, got_rows = rows_of(got)
    want_schema, want_rows = rows_of(want)
    out = []
    if got_schema != want_schema:
        out.append(f"schema {got_schema} != {want_schema}")
    if got.num_rows != want.num_rows:
        out.append(f"row count {got.num_rows} != {want.num_rows}")
    if got_rows != want_rows:
        extra, missing = got_rows - want_rows, want_rows - got_rows
        out.append(f"extra {list(extra)[:2]} missing {list(missing)[:2]}")
    return out
