"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py sf_dir name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settlebook.queries import queries  # noqa: E402
from settlebook.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", 8)
    qs = queries()
    for n in names:
        print(f"===== {n}")
        qs[n](spark, sf_dir).explain("formatted")
