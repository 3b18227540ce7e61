"""Latest version per key from a change-log table (as-of snapshot)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_latest_rank"


def _desc(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last()


def latest_as_of(df: DataFrame, keys: Sequence[str], newest_first: Sequence,
                 where: Column | None = None, then: Column | None = None) -> DataFrame:
    """Keep, per ``keys``, the newest row among those passing ``where``; then
    apply ``then`` to the survivors.

    ``newest_first`` lists ordering columns, all descending (NULLs last), e.g.
    ``["changed", "log_position"]``; give a total order so ties cannot pick
    rows arbitrarily.

    ``where`` is applied before ranking and ``then`` after it: a version that
    fails ``then`` removes its key, it does not expose an older version.

    Plan: ``row_number() = 1`` lets the planner insert a partial
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
    one row per key. A key holding a large share of the rows is therefore cut
    down map-side, like a partial aggregate, before it reaches a single task.
    """
    if where is not None:
        df = df.where(where)
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in newest_first])
    out = df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1)
    if then is not None:
        out = out.where(then)
    return out.drop(_RANK)


def newest(order: Sequence[str], payload: Sequence[str], among: Column | None = None) -> Column:
    """Aggregate expression: the newest row as a struct of ``order`` columns
    followed by ``payload`` columns, optionally only among rows where
    ``among`` holds (NULL when no row qualifies).

    ``max`` over the struct compares the order columns first (NULLs lowest,
    i.e. last in a descending ranking) and the payload only to break exact
    ties, so the pick is deterministic. As an aggregate it is combined
    map-side before any shuffle, and several variants (different ``among``)
    come out of one pass over the data.
    """
    v = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])
    return F.max(v if among is None else F.when(among, v))
