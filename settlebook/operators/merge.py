"""Full-outer merges and distinct unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_merge(left: DataFrame, right: DataFrame, on: Sequence[str],
               columns: Sequence[tuple[str, str]], add: Sequence[str] = ()) -> DataFrame:
    """Full outer join on ``on`` (NULL keys never match) and merge both sides.

    ``columns``: ``(name, first)`` pairs, ``first`` in {"left", "right"}; the
    output is ``coalesce(first.name, other.name)``, or the one side's column
    when only one side has it.
    ``add``: numeric columns merged as ``coalesce(l, 0) + coalesce(r, 0)``.
    """
    l, r = left.alias("_l"), right.alias("_r")
    cond = reduce(lambda a, b: a & b, [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in on])
    j = l.join(r, cond, "full_outer")
    out = []
    for name, first in columns:
        a, b = ("_l", "_r") if first == "left" else ("_r", "_l")
        if name in left.columns and name in right.columns:
            out.append(F.coalesce(F.col(f"{a}.{name}"), F.col(f"{b}.{name}")).alias(name))
        else:
            out.append(F.col(f"{'_l' if name in left.columns else '_r'}.{name}").alias(name))
    for name in add:
        out.append((F.coalesce(F.col(f"_l.{name}"), F.lit(0)) + F.coalesce(F.col(f"_r.{name}"), F.lit(0))).alias(name))
    return j.select(*out)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SQL ``UNION`` (distinct) by column name. Left-associative nesting gives
    the same rows as one distinct over the concatenation."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()
