"""Compare every catalogue query with its SQL counterpart: python tests/check_oracles.py [sf] [name…]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    return sorted(
        (tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r)
         for r in frame.itertuples(index=False, name=None)),
        key=repr,
    )


def difference(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None where both give the same rows."""
    got, want = run(spark, sf_dir).toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return None
    in_a, in_b = set(a), set(b)
    only_a, only_b = [r for r in a if r not in in_b], [r for r in b if r not in in_a]
    return f"rows {len(a)} / {len(b)}, only Spark {only_a[:3]}, only SQL {only_b[:3]}"


if __name__ == "__main__":
    from bench import session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(oracle_sql())
    spark, con, bad = session(), duck(sf_dir), 0
    print("without SQL:", sorted(set(queries()) - set(oracle_sql())))
    for name in names:
        t = time.time()
        try:
            diff = difference(spark, con, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{name:24s} {time.time() - t:6.2f}s {'ok' if diff is None else 'DIFF ' + diff[:900]}", flush=True)
    sys.exit(bad > 0)
