"""Run queries on Spark and their SQL on DuckDB, and compare row by row.

    python -m checks.compare [--dir DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import sys
import time
import traceback

import duckdb

from checks import REGISTRY
from checks.base import Tables
from siteplan.session import build_session


def plain(v):
    """One spelling for equal values of both engines."""
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        if math.isnan(f):
            return "nan"
        return repr(f + 0.0)
    return str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session("compare", cpus=8, shuffle_partitions=8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for p in glob.glob(f"{a.dir}/*.parquet"):
        con.execute(f"create view {p.rsplit('/', 1)[1][:-8]} as select * from '{p}'")
    bad = []
    for name, q in REGISTRY.items():
        if a.names and not any(name == n or name.startswith(n + "_") for n in a.names):
            continue
        t0 = time.time()
        try:
            df = q.run(Tables(spark, a.dir))
            got = table(df.columns, [tuple(r) for r in df.collect()])
            t1 = time.time()
            if q.sql is None:
                print(f"rows  {name:34s} {len(got[1]):7d} rows {t1 - t0:6.1f}s", got[1][:3] if len(a.names) else "", flush=True)
                continue
            rel = con.sql(q.sql)
            want = table(rel.columns, rel.fetchall())
            ok = got == want
            print(f"{'ok   ' if ok else 'DIFF '} {name:34s} {len(got[1]):7d} rows {t1 - t0:6.1f}s  sql {time.time() - t1:5.1f}s", flush=True)
            if not ok:
                bad.append(name)
                print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
                n = 0
                for x, y in zip(got[1], want[1], strict=False):
                    if x != y:
                        print("   spark", x, "\n   sql  ", y)
                        n += 1
                        if n == 3:
                            break
        except Exception:  # noqa: BLE001 - report and go on with the next query
            bad.append(name)
            print(f"FAIL  {name}", flush=True)
            print("   ", "\n    ".join(traceback.format_exc().strip().splitlines()[-12:])[:2500], flush=True)
    print("not equal:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
