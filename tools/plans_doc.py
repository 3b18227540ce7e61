"""Write PLANS.md: the physical plan tree of each settlement step, with the
pushed filters and read schema of every scan.

usage: python tools/plans_doc.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settlebook.queries import queries  # noqa: E402
from settlebook.session import build_session  # noqa: E402

STEPS = ("itemized_net_sales", "history_net_sales", "payout_snapshot", "payout_buckets", "charge_buckets",
         "multi_processor_events")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    qs = queries()
    print("# Physical plans\n")
    print(f"Generated by `tools/plans_doc.py` on `{sf_dir}` before execution (AQE may still turn "
          "sort-merge joins into broadcast joins at runtime when it measures a side as small). "
          "`WindowGroupLimit`/partial aggregates before an `Exchange` are the map-side reductions; "
          "scans list the filters pushed into parquet and the columns read.\n")
    for name in STEPS:
        text = formatted(qs[name](spark, sf_dir))
        main_part = text.split("===== Subqueries =====")[0]
        tree = main_part.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        scans = []
        for block in main_part.split("\n\n")[1:]:
            if re.match(r"\(\d+\) Scan parquet", block.strip()):
                head = block.strip().splitlines()[0]
                pushed = re.search(r"PushedFilters: (.*)", block)
                schema = re.search(r"ReadSchema: (.*)", block)
                scans.append(f"- `{head}` pushed `{pushed.group(1) if pushed else '[]'}` "
                             f"read `{schema.group(1) if schema else ''}`")
        exchanges = len(re.findall(r"^\(\d+\) Exchange", main_part, re.M))
        print(f"## {name}\n\n{exchanges} exchanges before AQE.\n\n```\n{tree.strip()}\n```\n")
        print("\n".join(scans) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
