"""Compare registered queries with their SQL twins: ``python check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

from catalograph.session import build_session
from workload import load


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (round(value, 6) + 0.0)
    if isinstance(value, bool):
        return value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def ordered(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(r[i]) for i in places) for r in rows]
    return [columns[i] for i in places], sorted(table, key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    names, got = ordered(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    expected_names, expected = ordered(list(relation.columns), relation.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = [(n, str(x)[:200], str(y)[:200], type(x).__name__, type(y).__name__)
                   for n, x, y in zip(names, a, b) if x != y or type(x) is not type(y)]
            return f"differs: {bad}"
    return None


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    queries, oracles = load()
    spark = build_session("local[8]", 8, "8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = "equal" if problem is None else problem
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = note = f"error {type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        if problem is not None or len(args) or name not in oracles:
            print(f"{name:28s} {time.time() - start:6.1f}s {note}", flush=True)
    print(f"{len(args or queries)} checked, {failed} failed", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
