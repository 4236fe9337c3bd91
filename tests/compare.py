"""Run registered queries against their SQL restatement in DuckDB.

    python tests/compare.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "as_tuple"):
        return round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple(("" if x is None else "v", str(x)) for x in t))


KIND = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
    "FLOAT": "float", "TIMESTAMP": "timestamp_ntz",
}


def compare(spark, con, name, fn, oracle, sf_dir):
    df = fn(spark, sf_dir)
    got_c, got = rows(df.columns, [tuple(x) for x in df.collect()])
    if oracle is None:
        return len(got), None, ""
    rel = con.execute(oracle)
    want_c, want = rows([d[0] for d in rel.description], rel.fetchall())
    kinds = {d[0]: KIND.get(str(d[1]), str(d[1])) for d in rel.description}
    note = ""
    mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = {c: (mine.get(c), kinds[c]) for c in kinds if mine.get(c) != kinds[c]}
    if odd:
        note = f"types {odd}"
    if got_c != want_c:
        return len(got), False, f"columns {got_c} vs {want_c}"
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return len(got), False, f"{len(got)} vs {len(want)} rows; {diff} {note}"
    return len(got), True, note


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as entry
    from zoneday.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if args.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in args.names):
            continue
        t = time.time()
        try:
            n, ok, note = compare(spark, con, name, fn, oracles.get(name), args.sf)
        except Exception as e:  # noqa: BLE001
            n, ok, note = -1, False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += ok is False
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'FAIL'} {name:32s} {n:8d} rows {time.time()-t:6.2f}s {note}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
