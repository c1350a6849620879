"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from opinara.plans.tables import TABLES

KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimal result")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def differences(df, con, sql: str) -> str | None:
    """None when names, types and values agree."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    kinds = {c: (k, theirs[c]) for c, k in df.dtypes if KINDS.get(k) != theirs[c]}
    if kinds:
        return f"types {kinds}"
    got = rows([tuple(r) for r in df.collect()], df.columns)
    want = rows(relation.fetchall(), relation.columns)
    if got != want:
        wrong = [(g, w) for g, w in zip(got, want) if g != w][:3]
        return f"{len(got)} rows vs {len(want)}; first differences {str(wrong)[:900]}"
    return None
