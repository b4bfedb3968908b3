"""Run queries next to their SQL and report where they differ.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    return v


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(_cell(t[i]) for i in order) for t in tuples]
    return sorted(columns), sorted(found, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when columns, types (kind) and rows agree, else what differs."""
    left_names, left = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    right_names, right = _rows([d[0] for d in cur.description], cur.fetchall())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}"
    if left and [type(v) for v in left[0]] != [type(v) for v in right[0]]:
        return f"types differ: {left[0]} and {right[0]}"
    return None


if __name__ == "__main__":
    from riskframe.oracle import all_oracles
    from riskframe.queries import all_queries
    from riskframe.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    con = connect(sf)
    todo = sys.argv[2:] or list(all_queries())
    oracles = all_oracles()
    bad = 0
    for name in todo:
        start = time.time()
        try:
            df = all_queries()[name](spark, sf)
            if name in oracles:
                result = difference(df, con, oracles[name])
            else:
                result = None
                rows = df.collect()
                print(f"      {len(rows)} rows, first {rows[0] if rows else None}")
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += result is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok  ' if result is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {result or ''}", flush=True)
    print("failures:", bad)
