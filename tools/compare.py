"""Run registered queries and their check SQL side by side: compare.py [folder] [name ...]."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sellerbooks import checks, queries  # noqa: E402
from sellerbooks.session import local_session  # noqa: E402
from sellerbooks.sources.fixtures import TABLES  # noqa: E402


def plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def bag(rows, order):
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    frame = queries.registered()[name](spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    took = time.time() - started
    cursor = con.execute(checks.check_sql(name))
    expected_columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(frame.columns) != sorted(expected_columns):
        return False, f"columns {frame.columns} / {expected_columns}"
    left = bag(rows, [frame.columns.index(c) for c in sorted(frame.columns)])
    right = bag(expected, [expected_columns.index(c) for c in sorted(expected_columns)])
    if left == right:
        return True, f"{len(rows)} rows, {took:.1f} s"
    only_left, only_right = list((left - right).items())[:2], list((right - left).items())[:2]
    return False, f"{len(rows)} / {len(expected)} rows, {sum((left - right).values())} differ\n  {sorted(frame.columns)}\n  ours {only_left}\n  check {only_right}"


def views(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or queries.names()
    spark, con = local_session(8), views(folder)
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for name in chosen:
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as e:
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            failed.append(name)
    print(len(chosen) - len(failed), "of", len(chosen), "equal; failed:", failed)
    sys.exit(bool(failed))
