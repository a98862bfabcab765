"""Spark-vs-DuckDB comparison used by tests and ``check_oracle.py``.

Mirrors what the driver does: same column names, same row count, and an
order-insensitive comparison of values.
"""

from __future__ import annotations

import math
import os

STRICT = os.environ.get("ORACLE_STRICT") == "1"  # exact float equality, no rounding

import duckdb
import pandas as pd

from shipwise.sources.tables import TABLES


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return v if STRICT else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows_of(pdf: pd.DataFrame) -> list:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    rs, rd = rows_of(s), rows_of(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first differing row:\n spark {a}\n duck  {b}"
    return True, f"{len(s)} rows equal"
