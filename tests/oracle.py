"""Run a registered query and its SQL statement over the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, (bool, int)):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return 0.0 if f == 0 else float(f"{f:.13g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def kind_of(type_name: str) -> str:
    t = type_name.lower()
    if t in ("bigint", "int", "integer", "smallint", "tinyint", "long"):
        return "int"
    if t.startswith(("double", "float", "real")):
        return "float"
    if t.startswith(("varchar", "string")):
        return "text"
    return t


def spark_result(df):
    names = sorted(df.columns)
    types = {n: kind_of(t) for n, t in df.dtypes}
    rows = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    return names, types, rows


def sql_result(con, sql: str):
    cur = con.execute(sql)
    described = [(d[0], kind_of(str(d[1]))) for d in cur.description]
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    return [described[i][0] for i in order], dict(described), rows


def differences(con, sql: str, df) -> list[str]:
    names, types, got = spark_result(df)
    want_names, want_types, want = sql_result(con, sql)
    out = []
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    bad_types = {n: (types[n], want_types[n]) for n in names if types[n] != want_types[n]}
    if bad_types:
        out.append(f"types (query, sql): {bad_types}")
    if got != want:
        out.append(f"rows {sum(got.values())} vs {sum(want.values())}")
        out.append(f"only in query: {list((got - want).items())[:3]}")
        out.append(f"only in sql: {list((want - got).items())[:3]}")
        out.append(f"columns: {names}")
    return out
