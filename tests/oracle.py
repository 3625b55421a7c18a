"""Run a registered query on Spark and its SQL on DuckDB, compare as multisets."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


_SAME = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "SMALLINT": "smallint",
}


def compare(spark, con, fn, sql, sf_dir):
    """Returns a list of differences, empty when both agree."""
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, df.collect())
    rel = con.sql(sql)
    want_cols, want = rows_of(rel.columns, rel.fetchall())
    problems = []
    if got_cols != want_cols:
        return [f"columns {got_cols} != {want_cols}"]
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for name, t in df.dtypes:
        w = _SAME.get(types[name], types[name].lower())
        if t != w:
            problems.append(f"type of {name}: spark {t}, sql {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        for g, w in zip(got, want):
            if g != w:
                problems.append(f"first difference spark {g} sql {w}")
                break
    if not got:
        problems.append("no rows")
    return problems
