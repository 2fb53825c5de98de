"""Runs a registered query and its SQL and compares rows, names and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf) / name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0 if value else 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "boolean": {"BOOLEAN"},
}


def compare(con, df, sql) -> list[str]:
    """What differs; empty if nothing."""
    rel = con.sql(sql)
    problems = []
    want = dict(zip(rel.columns, [str(t) for t in rel.types]))
    have = dict(df.dtypes)
    if sorted(want) != sorted(have):
        return [f"columns {sorted(have)} against {sorted(want)}"]
    for name, kind in have.items():
        if want[name] not in SAME_TYPE.get(kind, {want[name]}):
            problems.append(f"type of {name}: {kind} against {want[name]}")
    left = bag(df.columns, [tuple(r) for r in df.collect()])
    right = bag(rel.columns, rel.fetchall())
    if len(left) != len(right):
        problems.append(f"rows {len(left)} against {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        problems.append(f"values {only_left} against {only_right}")
    return problems
