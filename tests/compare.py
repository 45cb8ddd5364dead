"""Run a registered query and its SQL oracle on the same tables and compare them."""

from __future__ import annotations

import glob
import math
import os
import re

import duckdb

_NAMES = {"long": "bigint", "string": "varchar", "timestamp_ntz": "timestamp"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences in column names, types, row count and values; empty when equal."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]).lower() for d in found.description}
    expected = found.fetchall()
    got = [tuple(row) for row in df.collect()]
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema:
        ours = _NAMES.get(field.dataType.typeName(), field.dataType.typeName())
        if ours != re.sub(r"\(.*", "", types[field.name]):
            problems.append(f"type of {field.name}: {ours} != {types[field.name]}")
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    ours, theirs = _rows(df.columns, got), _rows(names, expected)
    if ours != theirs:
        wrong = [(a, b) for a, b in zip(ours, theirs) if a != b][:3]
        problems.append(f"values differ, e.g. {wrong}")
    if not expected:
        problems.append("no rows")
    return problems
