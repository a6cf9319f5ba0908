"""Compare a Spark result with a DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x).__name__), "" if x is None else x) for x in row)


# Spark type -> DuckDB type name, for the types the registered queries return.
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
          "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = list(spark_df.columns)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    type_diff = {c: (t, d_types[c]) for c, t in spark_df.dtypes if _TYPES.get(t, t) != d_types[c]}
    if type_diff:
        return False, f"column types differ (spark, oracle): {type_diff}"
    order = sorted(s_cols)
    s_rows = [tuple(_norm(r[c]) for c in order) for r in spark_df.collect()]
    d_idx = [d_cols.index(c) for c in order]
    d_rows = [tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall()]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(d_rows)}"
    s_sorted = sorted(s_rows, key=_key)
    d_sorted = sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first differing row: spark={a} oracle={b} cols={order}"
    return True, f"{len(s_rows)} rows"
