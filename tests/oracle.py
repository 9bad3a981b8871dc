"""Compares a registered query with its SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

_FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "double",
    "INTEGER": "int", "BIGINT": "int", "DOUBLE": "double", "double": "double",
    "VARCHAR": "string", "string": "string", "BOOLEAN": "boolean", "boolean": "boolean",
    "DATE": "date", "date": "date",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else float(f"{v:.12g}")
    return v


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when names, type families and the rows as a multiset agree."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    spark_types = {n: _FAMILY.get(t, t) for n, t in df.dtypes}
    duck_types = {n: _FAMILY.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    if spark_types != duck_types:
        return f"types {spark_types} != {duck_types}"
    mine = _rows([tuple(r) for r in df.collect()], df.columns)
    theirs = _rows(rel.fetchall(), rel.columns)
    if mine == theirs:
        return None
    extra, missing = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; only here"
        f" {list(extra.items())[:3]}; only there {list(missing.items())[:3]}"
    )
