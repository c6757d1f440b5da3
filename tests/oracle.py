"""Run a registered Spark query and its SQL twin; compare the results.

Mirrors the driver's check: same row count, same column names, and the same
multiset of rows (order-insensitive), after sorting columns by name.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark_df, con, sql: str):
    pdf = spark_df.toPandas()
    odf = con.execute(sql).df()
    problems = []
    if len(pdf) != len(odf):
        problems.append(f"rows {len(pdf)} vs {len(odf)}")
    if sorted(pdf.columns) != sorted(odf.columns):
        problems.append(f"columns {sorted(pdf.columns)} vs {sorted(odf.columns)}")
        return problems
    cols = sorted(pdf.columns)

    def rows(df):
        out = []
        for r in df[cols].itertuples(index=False):
            out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) else x)
                             if not hasattr(x, "item") else _norm(x.item()) for x in r))
        return sorted(out, key=repr)

    a, b = rows(pdf), rows(odf)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems
