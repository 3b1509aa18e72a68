"""Run every registered query against its DuckDB oracle (like the driver's gate).

usage: python tests/run_oracle.py [sf_dir] [name ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from ridegrid.session import build_session  # noqa: E402


T_START = time.time()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session()
    # optional: prove the results do not depend on the session's zone / ANSI mode
    if os.environ.get("ORACLE_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    if os.environ.get("ORACLE_ANSI"):
        spark.conf.set("spark.sql.ansi.enabled", os.environ["ORACLE_ANSI"])
    con = duck(sf)
    oracle = E.oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = E.queries()[n](spark, sf)
            if n in oracle:
                ok, msg = compare(df, con, oracle[n])
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:32s} {time.time() - t0:6.1f}s {msg}  "
              f"[{time.time() - T_START:.0f}s]", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok  (wall {time.time() - T_START:.1f}s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
