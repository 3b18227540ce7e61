"""Balance owed per event-level row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.plans import rules as R


def balance(event_level: DataFrame) -> DataFrame:
    """OP11: ``round(sum of coalesce(term, 0), 2) AS balance`` followed by
    every event-level column."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(t), F.lit(0)) for t in R.BALANCE_TERMS])
    return event_level.select(F.round(total, 2).alias("balance"), *[F.col(c) for c in event_level.columns])
