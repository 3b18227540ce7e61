"""Tables partitioned by the day of a time column.

A log of 100 TB that is stored by day need not be listed and opened whole for a
cutoff: ``changed < t`` implies ``changed_day <= date(t)``. The cutoff helpers
(``functions.timez``) add that bound when they are told the day column, and the
plans tell them whenever an input has one. A day column holds the UTC date of
its time (NULL where that is NULL), so the added bound never changes a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.functions.timez import DAY

def with_day(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column + DAY, F.to_date(column))


def write_by_day(df: DataFrame, path: str, column: str, files_per_day: int = 8, mode: str = "overwrite") -> None:
    """Write ``df`` partitioned by the UTC day of ``column``, at most
    ``files_per_day`` files to a day: rows are dealt by day and a hash of the
    row, so a busy day is not one task's work and a quiet one not many files."""
    day = column + DAY
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_day))
    with_day(df, column).repartition(F.col(day), salt).sortWithinPartitions(day, column).write.mode(mode).partitionBy(day).parquet(path)


def misplaced(df: DataFrame, column: str) -> DataFrame:
    """Rows whose day column is not the date of ``column``: they would be missed
    by a pruned scan. Empty for a sound table."""
    return df.where(~F.to_date(column).eqNullSafe(F.col(column + DAY)))
