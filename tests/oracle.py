"""Compare a query with its SQL, row for row and bit for bit."""

from __future__ import annotations

import math
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, folder, run, sql) -> tuple[str, float]:
    """('' if equal else what differs, seconds Spark took)"""
    start = time.time()
    df = run(spark, folder)
    got_rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    got_columns, got = _rows(df.columns, got_rows)
    found = con.execute(sql)
    want_columns, want = _rows([c[0] for c in found.description], found.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}", took
    if got != want:
        extra, lacking = list((got - want).items()), list((want - got).items())
        return (f"{sum(got.values())} vs {sum(want.values())} rows; {len(extra)} only in Spark, e.g. {extra[:2]}; "
                f"{len(lacking)} only in SQL, e.g. {lacking[:2]}"), took
    return "" if got else "both empty", took
