"""Compare a Spark result with the DuckDB result of its SQL counterpart."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    raise TypeError(f"use text, integers or doubles in results, not {type(value)}")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def check(df, con, sql, may_be_empty=False):
    """None when equal, else what differs."""
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    odd = {c: (t, types[c]) for c, t in df.dtypes if KINDS.get(t) != types[c]}
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if not got and not may_be_empty:
        return "no rows"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(names)}: {x} != {y}"
    return None
