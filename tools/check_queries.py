"""Run registered queries next to their SQL and compare whole results.

usage: python tools/check_queries.py [--sf DIR] [--only a,b] [--groups joins,quality]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from nestmetrics import catalog  # noqa: E402
from nestmetrics.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is None else "", repr(v)) for v in row)


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, bool) or v is None:
        return v
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def compare(spark_df, con, sql: str) -> str:
    names = sorted(spark_df.columns)
    got = [tuple(_plain(v) for v in row) for row in spark_df.select(*names).collect()]
    cursor = con.execute(sql)
    order = [d[0] for d in cursor.description]
    if sorted(order) != names:
        return f"COLUMNS spark={names} sql={sorted(order)}"
    index = [order.index(n) for n in names]
    want = [tuple(_plain(row[i]) for i in index) for row in cursor.fetchall()]
    if len(got) != len(want):
        return f"ROWS spark={len(got)} sql={len(want)}"
    got.sort(key=_key)
    want.sort(key=_key)
    if got == want:
        types = {(type(a).__name__, type(b).__name__) for g, w in zip(got, want) for a, b in zip(g, w) if type(a) is not type(b)}
        return f"ok {len(got)} rows" + (f" TYPES {types}" if types else "")
    near = all(
        a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))
        for g, w in zip(got, want)
        for a, b in zip(g, w)
    )
    first = next((g, w) for g, w in zip(got, want) if g != w)
    return f"{'NEAR' if near else 'VALUES'} {names} spark={first[0]} sql={first[1]}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--skip", default="")
    args = parser.parse_args()
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    wanted = [w for w in args.only.split(",") if w]
    skipped = set(args.skip.split(","))
    oracles, bad = catalog.oracle_sql(), 0
    for name, build in catalog.queries().items():
        if (wanted and name not in wanted) or name in skipped:
            continue
        started = time.time()
        try:
            df = build(spark, args.sf)
            verdict = compare(df, con, oracles[name]) if name in oracles else f"rows-only {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += not verdict.startswith(("ok", "rows-only"))
        print(f"{name:32s} {time.time() - started:6.2f}s  {verdict}", flush=True)
    print("problems:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
