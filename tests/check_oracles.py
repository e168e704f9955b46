"""Run every catalogued query against its oracle: ``python tests/check_oracles.py [sf_dir] [name…]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402
from cardwarden.session import build_session  # noqa: E402
from tests import oracle  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("oracles", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    sql = entry_points.oracle_sql()
    bad = 0
    for name, fn in entry_points.queries().items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                verdict = oracle.compare(df, con, sql[name]) or "ok"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            verdict = f"ERROR {type(e).__name__}: {' '.join(str(e).split())[:300]}"
        bad += not verdict.startswith(("ok", "rows"))
        print(f"{name:40s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
