"""Run registered queries next to their SQL in DuckDB and compare the rows.

``python tests/compare.py [--sf 0.01] [--only a,b] [--module flags]``
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from trialspark.plans.registry import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def _key(row):
    return tuple((v is None, round(float(v), 3) if isinstance(v, (int, float)) else str(v)) for v in row)


def _same(a, b) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-7)
    return a == b


def differences(df, con, sql: str) -> tuple[int, list[str]]:
    """Number of rows, and what differs (nothing when both agree)."""
    names = sorted(df.columns)
    got = [tuple(_cell(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != names:
        return len(got), [f"columns {names} != {sorted(columns)}"]
    at = [columns.index(n) for n in names]
    want = [tuple(_cell(r[i]) for i in at) for r in cur.fetchall()]
    out = []
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    # floats are matched loosely when sorting, so sort by the other columns first
    exact = [i for i in range(len(names)) if not any(isinstance(r[i], float) for r in got[:500] + want[:500])]
    order = exact + [i for i in range(len(names)) if i not in exact]
    got.sort(key=lambda r: _key([r[i] for i in order]))
    want.sort(key=lambda r: _key([r[i] for i in order]))
    bad = 0
    for g, w in zip(got, want):
        if not all(_same(x, y) for x, y in zip(g, w)):
            bad += 1
            if bad <= 3:
                out.append(f"  {dict(zip(names, g))}\n  {dict(zip(names, w))}")
    if bad:
        out.insert(0, f"{bad} rows differ")
    types = {}
    for i, n in enumerate(names):
        kinds_g = {type(r[i]).__name__ for r in got if r[i] is not None}
        kinds_w = {type(r[i]).__name__ for r in want if r[i] is not None}
        if kinds_g and kinds_w and kinds_g != kinds_w:
            types[n] = (kinds_g, kinds_w)
    if types:
        out.append(f"types differ: {types}")
    return len(got), out


def main() -> None:
    from trialspark.plans import load_all
    from trialspark.session import build_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--only", default="")
    ap.add_argument("--module", default="")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session("local[8]", 8, driver_memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    plans = load_all()
    wanted = [n for n in args.only.split(",") if n]
    failed = []
    for name, p in plans.items():
        if wanted and name not in wanted:
            continue
        if args.module and p.build.__module__.rsplit(".", 1)[-1] not in args.module.split(","):
            continue
        start = time.time()
        try:
            df = p(spark, folder)
            if p.sql:
                n, diff = differences(df, con, p.sql)
            else:
                n, diff = len(df.collect()), []
            state = "ok" if not diff else "DIFF"
            if n == 0:
                state = "EMPTY " + state
        except Exception as e:  # report and go on with the next query
            n, diff, state = -1, [f"{type(e).__name__}: {str(e)[:1500]}"], "ERROR"
        if state != "ok":
            failed.append(name)
        print(f"{state:6} {name:40} rows={n:<8} {time.time() - start:6.1f}s {'' if p.sql else '(rows only)'}", flush=True)
        for d in diff:
            print("   ", d, flush=True)
    print(f"{len(failed)} not ok: {failed}")


if __name__ == "__main__":
    main()
