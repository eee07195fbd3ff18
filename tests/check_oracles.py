"""Compare registered queries with their SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(value)
    return str(value)


def _loose(value):
    """Integers and equal floats alike, for the first diagnosis of a mismatch."""
    return repr(round(float(value), 9)) if isinstance(value, (int, float)) and not isinstance(value, bool) else _norm(value)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    cols = sorted(spark_df.columns)
    got = sorted(tuple(_norm(v) for v in r) for r in spark_df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} != {sorted(rel.columns)}"
    order = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    if got == want:
        return None
    g, w = set(got), set(want)
    return f"rows {len(got)} vs {len(want)}; only spark {sorted(g - w)[:2]}; only sql {sorted(w - g)[:2]}"


def main() -> None:
    from runlens import plans
    from runlens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(plans.all_queries())
    spark = local_session(8)
    con = duck(sf_dir)
    oracles = plans.all_oracles()
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = plans.all_queries()[name](spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else f"no SQL; {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
