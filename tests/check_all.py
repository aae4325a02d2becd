"""Run registered queries against their oracle: ``python tests/check_all.py [name ...]``."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402

from closepass.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracle = entry.oracle_sql()
    wanted = sys.argv[1:] or list(entry.queries())
    failed = []
    for name in wanted:
        start = time.time()
        try:
            found = differences(entry.queries()[name](spark, sf), con, oracle[name])
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        if found:
            failed.append(name)
        print(f"{name:26s} {time.time() - start:6.2f}s  {found or 'ok'}", flush=True)
    print(f"{len(wanted) - len(failed)} ok, failed: {failed}")
