"""Check a Spark result against its DuckDB oracle (tests and local runs).

Both results are brought to pandas, columns sorted by name, rows sorted, and
compared value by value (exact; NaN equals NaN).  Only used on small test
scales; production code never collects data.
"""

from __future__ import annotations

import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, (list, tuple, dict, str)) and pd.isna(v)):
            return (0, "")
    except (TypeError, ValueError):
        pass
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "nan")
        if v == int(v) and abs(v) < 2 ** 53:
            return (2, repr(float(v)))
        return (2, repr(v))
    if isinstance(v, int):
        return (2, repr(float(v)))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (3, str(v))


def rows_of(pdf) -> list[tuple]:
    cols = sorted(pdf.columns)
    return sorted(tuple(_norm(v) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None))


def compare(spark_df, sql: str, con) -> dict:
    left = spark_df.toPandas()
    right = con.execute(sql).df()
    out = {"spark_rows": len(left), "oracle_rows": len(right),
           "spark_cols": sorted(left.columns), "oracle_cols": sorted(right.columns)}
    out["columns_match"] = out["spark_cols"] == out["oracle_cols"]
    if not out["columns_match"]:
        out["match"] = False
        return out
    a, b = rows_of(left), rows_of(right)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_oracle"] = [r for r in b if r not in sa][:3]
    return out
