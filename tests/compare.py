"""Compare a query's rows with those of its SQL in DuckDB, in any order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sql: str, sf: str) -> list[dict]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return [dict(zip(names, r, strict=True)) for r in got.fetchall()]


def key(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.5g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    return f"{float(v):.5g}" if isinstance(v, (int,)) is False and hasattr(v, "as_tuple") else str(v)


def same(spark_rows: list[dict], oracle_rows: list[dict]) -> str:
    """What differs, or an empty string."""
    if len(spark_rows) != len(oracle_rows):
        return f"{len(spark_rows)} rows, the SQL has {len(oracle_rows)}"
    if spark_rows and set(spark_rows[0]) != set(oracle_rows[0]):
        return f"columns {sorted(spark_rows[0])}, the SQL has {sorted(oracle_rows[0])}"
    a, b = (sorted(tuple(key(r[c]) for c in sorted(r)) for r in rows) for rows in (spark_rows, oracle_rows))
    return next((f"{x} and {y}" for x, y in zip(a, b, strict=True) if x != y), "")
