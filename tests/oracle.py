"""Run trial queries beside their SQL and compare schema, row count and values.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

import tidemark.trials as trials


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("null", "")
    if isinstance(v, float):
        return ("float", f"{v:.9e}")
    return (type(v).__name__, str(v))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[int, list[str]]:
    """Row count of the Spark result and the differences found."""
    con = con or connect(sf_dir)
    df = trials.QUERIES[name](spark, sf_dir)
    names = df.columns
    got = _rows(names, [tuple(r) for r in df.collect()])
    if name not in trials.ORACLES:
        return len(got), []
    cursor = con.execute(trials.ORACLES[name])
    wanted_names = [d[0] for d in cursor.description]
    want = _rows(wanted_names, cursor.fetchall())
    problems = []
    if sorted(names) != sorted(wanted_names):
        problems.append(f"columns {sorted(names)} != {sorted(wanted_names)}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not problems and got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return len(got), problems


def main() -> None:
    from tests.session import test_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = test_session()
    trials.load_all()
    con = connect(sf_dir)
    wanted = sys.argv[2:]
    names = [n for n in trials.QUERIES if not wanted or any(n.startswith(w) for w in wanted)]
    failed = 0
    for name in names:
        started = time.time()
        try:
            n, problems = compare(spark, sf_dir, name, con)
        except Exception as problem:  # noqa: BLE001 - report and go on
            n, problems = -1, [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        failed += bool(problems)
        kind = "sql " if name in trials.ORACLES else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name} rows={n} {time.time() - started:.1f}s {' '.join(problems)}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
