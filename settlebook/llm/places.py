"""Places of rows in a sorted group of any size, without one task per group.

Rows are dealt by ranges of (group, order), so a group that holds most of the
table lies in many partitions. Within a partition places are counted by a
window; what lies in earlier partitions is a sum over at most one row per
partition and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settlebook.llm.scratch import Scratch

PART, ROW = "_part", "_row"


def places(df: DataFrame, scratch: Scratch, name: str, group: list[str], order: list[str], out: str = "place", total: str = "n") -> DataFrame:
    """``df`` with the place of each row in its group (long, from 0, by
    ``order``, ascending, nulls first) and the group's number of rows.

    ``group`` columns must not be null. Rows that tie in ``order`` get places
    in any order, and are spread over partitions as others are. ``df`` should
    be a written table: it is read once for the ranges' bounds and once more.
    """
    keys = [F.col(c) for c in (*group, *order, ROW)]
    dealt = df.withColumn(ROW, F.monotonically_increasing_id()).repartitionByRange(*keys).withColumn(PART, F.spark_partition_id())
    dealt = scratch.save(dealt, f"{name}-dealt")
    own = dealt.withColumn(out, F.row_number().over(Window.partitionBy(PART, *group).orderBy(*order, ROW)).cast("long") - 1)
    counts = dealt.groupBy(PART, *group).agg(F.count(F.lit(1)).alias("_m"))
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(PART, *group, F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_start"),
                           F.sum("_m").over(Window.partitionBy(*group)).alias(total))
    return own.join(starts, [PART, *group]).withColumn(out, F.col(out) + F.col("_start")).drop(PART, ROW, "_start")
