"""Side-by-side check of a registered query against its DuckDB SQL.

Both results are reduced to sorted tuples over name-sorted columns and
compared exactly, the way an order-insensitive value hash would see them.
Only for small scale factors: it brings both results to the caller.
"""

from __future__ import annotations

import datetime as _dt
import math
from dataclasses import dataclass

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass
class Outcome:
    name: str
    spark_rows: int
    oracle_rows: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.columns_match and self.values_match and self.spark_rows == self.oracle_rows


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> Outcome:
    con = con or duckdb_connection(sf_dir)
    df = query(spark, sf_dir)
    s_cols, s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    o_cols_raw = [d[0] for d in rel.description]
    o_cols, o_rows = _rows(o_cols_raw, rel.fetchall())
    cols_ok = s_cols == o_cols
    vals_ok = cols_ok and s_rows == o_rows
    detail = ""
    if not cols_ok:
        detail = f"columns spark={s_cols} oracle={o_cols}"
    elif not vals_ok:
        diff = [(a, b) for a, b in zip(s_rows, o_rows) if a != b][:3]
        detail = f"first differences: {diff}"
    return Outcome(name, len(s_rows), len(o_rows), cols_ok, vals_ok, detail)
