"""Compare every registered query with its SQL: ``python check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from deskmill.plans import CHECKS, JOBS
from deskmill.session import TABLES, build_session


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        frame[column] = frame[column].map(lambda v: "NULL" if v is None or v is pd.NaT or v != v else str(_plain(v)))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, pd.Timestamp):
        return value.isoformat(sep=" ")
    if isinstance(value, float) and value == int(value):
        return int(value)
    return value


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(JOBS)
    spark = build_session()
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = JOBS[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in CHECKS:
                print(f"rows  {name:28} {len(got):8} {took:6.1f}s", flush=True)
                continue
            want = db.sql(CHECKS[name]).df()
            a, b = canonical(got), canonical(want)
            same = list(a.columns) == list(b.columns) and a.shape == b.shape and a.equals(b)
            print(f"{'ok   ' if same else 'DIFF '} {name:28} {len(got):8} {took:6.1f}s", flush=True)
            if not same:
                bad += 1
                print("  ", list(a.columns), a.shape, "|", list(b.columns), b.shape)
                if a.shape == b.shape and list(a.columns) == list(b.columns):
                    rows = (a != b).any(axis=1)
                    print(a[rows].head(3).to_string(max_colwidth=80), "\n", b[rows].head(3).to_string(max_colwidth=80))
                else:
                    print(a.head(3).to_string(max_colwidth=60), "\n", b.head(3).to_string(max_colwidth=60))
        except Exception as error:
            bad += 1
            print(f"FAIL  {name}: {str(error)[:1500]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
