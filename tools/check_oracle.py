"""Compare every registered query with its oracle SQL.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settlebook.oracle.compare import compare, duckdb_connection  # noqa: E402
from settlebook.oracle.queries import oracle_sql  # noqa: E402
from settlebook.queries import queries  # noqa: E402
from settlebook.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", 8)
    con = duckdb_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(json.dumps({"name": name, "oracle": "none"}))
            continue
        t0 = time.time()
        try:
            r = compare(spark, name, fn, sqls[name], sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": repr(e)[:500]}
        r["sec"] = round(time.time() - t0, 2)
        bad += not r["ok"]
        print(json.dumps(r, default=str))
    print(json.dumps({"failed": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
