"""Spark result vs DuckDB oracle: row count, column names/types and values, order-free."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (1, str(v))
    if hasattr(v, "item"):
        v = v.item()
        return _norm(v)
    return (1, str(v))


def _rows(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark_df, con, sql: str, max_diff: int = 5) -> dict:
    s_cols = spark_df.columns
    s_rows = [r.asDict() for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = [dict(zip(d_cols, r)) for r in rel.fetchall()]
    out = {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": sorted(s_cols), "oracle_columns": sorted(d_cols),
        "oracle_types": dict(zip(d_cols, d_types)),
        "spark_types": dict(spark_df.dtypes),
    }
    if not out["columns_match"]:
        out["ok"] = False
        return out
    cols = sorted(s_cols)
    a, b = _rows(s_rows, cols), _rows(d_rows, cols)
    diffs = []
    if a != b:
        sa, sb = set(a), set(b)
        only_s = [x for x in a if x not in sb][:max_diff]
        only_d = [x for x in b if x not in sa][:max_diff]
        diffs = [("spark_only", dict(zip(cols, x))) for x in only_s] + \
                [("oracle_only", dict(zip(cols, x))) for x in only_d]
    out["values_match"] = a == b
    out["diffs"] = diffs
    out["ok"] = out["values_match"] and len(s_rows) == len(d_rows)
    return out


SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}


def type_mismatches(result: dict) -> dict:
    bad = {}
    for c, st in result["spark_types"].items():
        dt = result["oracle_types"].get(c)
        if SPARK_TO_DUCK.get(st) != dt:
            bad[c] = (st, dt)
    return bad
