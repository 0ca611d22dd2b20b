"""Compare a registered query with its DuckDB oracle (row count, column names, values)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math


def _norm(v) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return _norm(list(v))
    return repr(v)


def digest(cols: list[str], rows: list) -> tuple[str, list[str]]:
    """Order-insensitive digest; columns are taken in name order."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def duckdb_connection(sf_dir: str):
    import duckdb

    from tidemark.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, build, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = build(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    if sorted(df.columns) != sorted(ocols):
        return False, f"columns {sorted(df.columns)} vs {sorted(ocols)}"
    if len(rows) != len(orows):
        return False, f"rows {len(rows)} vs {len(orows)}"
    if h1 != h2:
        only = [x for x in l1 if x not in set(l2)][:2]
        return False, f"values differ, e.g. {only}"
    return True, f"{len(rows)} rows"
