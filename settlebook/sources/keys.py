"""Verified keys: current-state tables have one row per id.

The net-sales and payout plans aggregate first and look attributes up last,
which equals the direct form only while ``events``, ``users`` and ``orders`` hold
one row per id, and the join of a log to a key set only while the set's keys are
as distinct as they are said to be. A warehouse table that breaks this gives
wrong money without an error, so a close checks it first: one pass over the id
columns of all tables together.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.sources.adapters import SettlementInputs

# Input -> the column that tells its rows apart.
KEYS = {"events": "id", "users": "id", "orders": "id", "transfer_orders": "order_id"}


class RepeatedKeys(ValueError):
    """A table that must have one row per id has several for some."""


@dataclass(frozen=True)
class Repeated:
    table: str
    key: str
    keys: int  # ids with several rows
    rows: int  # their rows
    first: int
    last: int

    def __str__(self) -> str:
        return f"{self.table}: {self.keys} values of {self.key} have {self.rows} rows (the least is {self.first}, the greatest {self.last})"


def repeated_keys(inputs: SettlementInputs, keys: dict[str, str] | None = None) -> list[Repeated]:
    """The tables whose key is not unique, by one job: ids are counted with a
    partial aggregate (an id that holds much of a table is folded where it lies),
    and a row per offending table comes to the driver. NULL ids take part in no
    join and are not counted."""
    keys = KEYS if keys is None else keys
    ids = reduce(lambda a, b: a.unionAll(b), [
        getattr(inputs, t).select(F.lit(t).alias("table"), F.col(k).cast("bigint").alias("id")) for t, k in keys.items()])
    found = (ids.where(F.col("id").isNotNull()).groupBy("table", "id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                .groupBy("table").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"), F.min("id").alias("first"), F.max("id").alias("last")))
    return [Repeated(r["table"], keys[r["table"]], r["keys"], r["rows"], r["first"], r["last"]) for r in found.orderBy("table").collect()]


def split_repeated(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with one row per ``key`` -- of several the greatest, compared column
    by column -- and the other rows. Rows without a key stay."""
    row = F.struct(*df.columns)
    folded = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(row).alias("_kept"), F.count(F.lit(1)).alias("_n"))
    kept = folded.select("_kept.*").unionByName(df.where(F.col(key).isNull()))
    several = folded.where("_n > 1").select("_key", "_kept")
    # of equal rows all but one are left over: numbered within the few ids that repeat
    rows = df.join(several, F.col(key) == F.col("_key")).groupBy(*df.columns, "_kept").agg(F.count(F.lit(1)).alias("_m"))
    extra = rows.withColumn("_m", F.when(F.struct(*df.columns).eqNullSafe(F.col("_kept")), F.col("_m") - 1).otherwise(F.col("_m"))).where("_m > 0")
    left = extra.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m")))).drop("col")
    return kept, left


def verified(inputs: SettlementInputs, mode: str = "raise", keys: dict[str, str] | None = None) -> tuple[SettlementInputs, dict[str, DataFrame]]:
    """The inputs to go on with, and per table the rows set aside.

    ``mode``: ``raise`` stops with :class:`RepeatedKeys`, which names tables,
    numbers and sample ids; ``quarantine`` keeps one row of each repeated id (see
    :func:`split_repeated`) and returns the others; ``off`` checks nothing.
    """
    if mode not in ("raise", "quarantine", "off"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "off":
        return inputs, {}
    keys = KEYS if keys is None else keys
    found = repeated_keys(inputs, keys)
    if found and mode == "raise":
        raise RepeatedKeys("keys that must be unique are not:\n  " + "\n  ".join(map(str, found)))
    aside, fixed = {}, {}
    for r in found:
        fixed[r.table], aside[r.table] = split_repeated(getattr(inputs, r.table), r.key)
    assert set(fixed) <= {f.name for f in fields(inputs)}
    return replace(inputs, **fixed), aside
