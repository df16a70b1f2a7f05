"""Compare registered queries with their SQL counterparts.

usage: python tools/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from cardwarden.catalog import ORACLES, QUERIES  # noqa: E402
from cardwarden.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v + 0.0:.6f}" if v else "0.000000"
    return str(v)


def canonical(rows, columns) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, db, sf_dir: str, name: str) -> str:
    """Empty when both sides agree, else the first difference."""
    df = QUERIES[name](spark, sf_dir)
    got_columns, got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        return "" if got else "no rows"
    cursor = db.execute(ORACLES[name])
    want_columns, want = canonical(cursor.fetchall(), [d[0] for d in cursor.description])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0][0]} != {bad[0][1]}" if bad else ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracles", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, sf_dir, name)
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        kind = "sql " if name in ORACLES else "rows"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
