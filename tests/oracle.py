"""Compare registered queries with their SQL in DuckDB: row count, columns and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, name, fn, sql, sf_dir, con) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    rel = con.execute(sql)
    want_cols = [c[0] for c in rel.description]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    want_kinds = {c[0]: str(c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    kinds = {c: (KINDS.get(t, t), want_kinds[c]) for c, t in df.dtypes if KINDS.get(t, t) != want_kinds[c]}
    if kinds:
        return f"types {kinds}"
    rel = con.execute(sql)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want = canonical(want_cols, rel.fetchall())
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if not got:
        return "empty"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry

    from tremorlake.session import local_session

    sf_dir = sys.argv[1]
    only = set(sys.argv[2:])
    spark, con = local_session(), connect(sf_dir)
    sql, failed = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            if name in sql:
                msg = compare(spark, name, fn, sql[name], sf_dir, con)
            else:
                n = len(fn(spark, sf_dir).collect())
                msg = None if n else "empty"
                name += f" (rows only: {n})"
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{time.time() - t:6.1f}s {name}: {msg or 'ok'}", flush=True)
        if msg:
            failed.append(name)
    print("FAILED", failed)
    from tremorlake.plans import clear_scratch

    clear_scratch(spark)
