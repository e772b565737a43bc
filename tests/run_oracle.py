"""CLI: run every registered query against its oracle at one scale factor."""

import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from lexicarve.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session("local[8]", 8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in sqls:
            n = fn(spark, sf).count()
            print(f"ROWS  {name}: {n} rows ({time.time() - t:.1f}s)", flush=True)
            continue
        try:
            ok, detail = compare(spark, con, name, fn, sqls[name], sf)
        except Exception as e:  # report and go on
            ok, detail = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name} ({time.time() - t:.1f}s) {detail}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
