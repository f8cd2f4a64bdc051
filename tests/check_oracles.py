"""Run registered queries against their SQL: ``python tests/check_oracles.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return "None" if v is None else str(v)


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when equal."""
    cur = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = normal([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = normal(df.columns, df.collect())
    out = []
    if got_cols != want_cols:
        return [f"columns {set(got_cols) ^ set(want_cols)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            out.append(f"type of {name}: {kind} / {kinds[name]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} / {len(want)}")
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        out.append(f"values differ: {len(a)} / {len(b)}")
        for x, y in list(zip(sorted(a), sorted(b)))[:2]:
            out.append(str([(c, p, q) for c, p, q in zip(got_cols, x, y) if p != q]))
    return out


def main() -> None:
    import __spark_entry__ as e
    from session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = local_session()
    con = duck(f"/root/testdata/sf{sf}")
    names = sys.argv[2:] or list(e.queries())
    bad = 0
    for name in names:
        t = time.time()
        try:
            df = e.queries()[name](spark, f"/root/testdata/sf{sf}")
            if name in e.oracle_sql():
                issues = compare(df, con, e.oracle_sql()[name])
                print(f"{'OK  ' if not issues else 'DIFF'} {name} {time.time() - t:.1f}s", *issues, sep="\n     " if issues else " ")
                bad += bool(issues)
            else:
                print(f"ROWS {name} {df.count()} {time.time() - t:.1f}s")
        except Exception as ex:  # report and go on
            bad += 1
            print(f"FAIL {name} {time.time() - t:.1f}s {type(ex).__name__}: {str(ex)[:600]}")
        sys.stdout.flush()
    print("not equal:", bad)


if __name__ == "__main__":
    main()
