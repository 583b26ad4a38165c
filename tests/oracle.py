"""Run a driver query and its SQL on the same tables and compare columns, types and rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(TESTDATA, sf, name)}.parquet')")
    return con


def kind(type_name: str) -> str:
    name = str(type_name).lower()
    for marks, label in (
        (("decimal",), name.replace(" ", "").replace("type", "")),
        (("bigint", "long"), "bigint"),
        (("varchar", "string"), "string"),
        (("timestamp",), "timestamp"),
        (("int",), "int"),
    ):
        if any(name.startswith(m) for m in marks):
            return label
    return name


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(plain(row[n]) for n in order) for row in rows), key=repr)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Row count, and what differs first."""
    relation = con.sql(sql)
    ours = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {c: kind(t) for c, t in zip(relation.columns, relation.types)}
    if ours != theirs:
        return 0, f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    left = rows_of(df.columns, df.collect())
    right = rows_of(relation.columns, relation.fetchall())
    if len(left) != len(right):
        extra = [r for r in left if r not in set(right)][:2], [r for r in right if r not in set(left)][:2]
        return len(left), f"rows: {len(left)} against {len(right)}, e.g. {extra}"
    for a, b in zip(left, right):
        if a != b:
            return len(left), f"row: {a} against {b}"
    return len(left), None
