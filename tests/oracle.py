"""Side-by-side check of a registered query against its DuckDB SQL twin."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(pdf), cols, h


def compare(spark, con, name: str, fn, sql: str, sf_dir: str):
    sp = fn(spark, sf_dir).toPandas()
    dk = con.execute(sql).df()
    a, b = digest(sp), digest(dk)
    ok = a == b
    detail = ""
    if not ok:
        detail = f"spark rows={a[0]} cols={a[1]} | duck rows={b[0]} cols={b[1]}"
        if a[1] == b[1]:
            cols = a[1]
            sa = {"|".join(_norm(r[c]) for c in cols) for r in sp[cols].to_dict("records")}
            sb = {"|".join(_norm(r[c]) for c in cols) for r in dk[cols].to_dict("records")}
            detail += f"\n  only spark: {list(sa - sb)[:3]}\n  only duck: {list(sb - sa)[:3]}"
    return ok, detail
