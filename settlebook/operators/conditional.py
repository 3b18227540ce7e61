"""Rule-driven conditional sums: one pass, many buckets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    """``sign * SUM(CASE WHEN predicate THEN value [ELSE 0] END) AS name``."""
    name: str
    predicate: Column
    sign: int = 1
    else_zero: bool = True


def bucket_sum(b: Bucket, value: Column) -> Column:
    e = F.when(b.predicate, value)
    if b.else_zero:
        e = e.otherwise(F.lit(0))
    s = F.sum(e)
    return (-s if b.sign < 0 else s).alias(b.name)


def conditional_sums(buckets: Sequence[Bucket], value: Column) -> list[Column]:
    """Aggregate expressions for all buckets, for one ``agg(...)`` call."""
    return [bucket_sum(b, value) for b in buckets]


def partial_bucket_sums(buckets: Sequence[Bucket], value: Column) -> list[Column]:
    """Unsigned bucket sums, for pre-aggregating the many side of a join; the
    sign is applied when the partial sums are combined (:func:`combine_bucket_sums`)."""
    out = []
    for b in buckets:
        e = F.when(b.predicate, value)
        if b.else_zero:
            e = e.otherwise(F.lit(0))
        out.append(F.sum(e).alias(b.name))
    return out


def combine_bucket_sums(buckets: Sequence[Bucket], matched: Column) -> list[Column]:
    """Re-aggregate partial sums after a join. Rows without a match contribute
    what the one all-NULL joined row contributes in the direct form: 0 for
    ``ELSE 0`` buckets, NULL otherwise."""
    out = []
    for b in buckets:
        v = F.col(b.name)
        if b.else_zero:
            v = F.when(matched, v).otherwise(F.lit(0))
        s = F.sum(v)
        out.append((-s if b.sign < 0 else s).alias(b.name))
    return out
