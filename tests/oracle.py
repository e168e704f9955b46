"""Compare a Spark result with its SQL oracle on the same Parquet files."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _kind(v):
    return type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(spark_df.columns) != sorted(want_cols):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_cols)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for c in want_cols:
        a = {_kind(r[spark_df.columns.index(c)]) for r in got} - {"NoneType"}
        b = {_kind(r[want_cols.index(c)]) for r in want} - {"NoneType"}
        if a != b:
            return f"type of {c}: {a} != {b}"
    mine, theirs = rows_of(spark_df.columns, got), rows_of(want_cols, want)
    bad = [(m, t) for m, t in zip(mine, theirs) if m != t]
    return f"{len(bad)} differ, first {bad[0]}" if bad else None
