"""Spark vs DuckDB comparison used by the tests and by hand (python -m tests.oracle_util)."""
from __future__ import annotations

import math
import sys

import duckdb
import pandas as pd

from vitrine.sources.tables import TABLES

DEC = 6
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, DEC) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def canon(rows: list[tuple], cols: list[str]):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, qfn, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = qfn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    d_types = {c: str(t) for c, t in zip(d_cols, res.types)}
    if s_types != d_types:
        diff = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
        return False, f"column types differ: {diff}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = canon(s_rows, s_cols), canon(d_rows, d_cols)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({len(s_rows)} rows): {diffs}"
    return True, f"{len(s_rows)} rows"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from vitrine.session import build_session
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.01"
    names = sys.argv[1:] or list(E.oracle_sql())
    spark = build_session()
    q, s = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, q[n], s[n], sf)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("OK  " if ok else "FAIL"), n, msg, flush=True)
    print("failures:", bad)
