"""Invoice-charge snapshot and charge buckets per payout-level row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.functions.timez import DAY, day_of, local_at_or_after, local_before
from settlebook.operators import Bucket, KeySet, exists_flag, latest_as_of, partial_bucket_sums, set_facts
from settlebook.plans import rules as R
from settlebook.plans.period import Period

_SETTLED = "_settled"


def charge_snapshot(charges: DataFrame, period: Period) -> DataFrame:
    """OP9: charges created (local wall clock) before the period cutoff, in a
    supported currency."""
    day = day_of(charges, "created")
    kept = charges.where(local_before("created", period.charges_created_before, period.tz, day)
                         & F.col("currency").isin(*R.CHARGE_CURRENCIES))
    return kept.drop(*(c for c in kept.columns if c.endswith(DAY)))


def charge_snapshot_from_log(history: DataFrame, period: Period, key: str = "invoice_charge_id") -> DataFrame:
    """VAR4: the snapshot from the charges' change log instead of the current
    table: per charge the newest version changed (local wall clock) before the
    cutoff, in a supported currency; ``key`` becomes ``id``."""
    day = day_of(history, "changed")
    kept = latest_as_of(history, [key], ("changed", "log_position"), where=local_before("changed", period.charges_created_before, period.tz, day)
                        & F.col("currency").isin(*R.CHARGE_CURRENCIES))
    return kept.withColumnRenamed(key, "id").drop(*(c for c in kept.columns if c.endswith(DAY)))


def charge_bucket_rules(period: Period) -> list[Bucket]:
    """The charge buckets, in output order (NULL when nothing qualifies,
    except the total). Expects the ``_settled`` column of :func:`with_settled`."""
    tz = period.tz
    ct, processed = F.col("charge_type"), F.col("processed")
    changed_ok = local_before("changed", period.charges_settled_before, tz)
    created_ok = local_before("created", period.charges_settled_before, tz)
    families = (
        ("credit_backup_funding", ct.isin(*R.BACKUP_FUNDING_TYPES) & created_ok),
        ("credit_balance_transfer", (ct == R.CREDIT_BALANCE_TRANSFER) & changed_ok),
        ("charge_balance_transfer", (ct == R.CHARGE_BALANCE_TRANSFER) & changed_ok),
    )
    b = [Bucket(f"{name}_total", cond, else_zero=False) for name, cond in families]
    b += [Bucket(f"{name}_not_applied", cond & (processed == 0), else_zero=False) for name, cond in families]
    b += [Bucket(f"{name}_applied", cond & (processed == 1), else_zero=False) for name, cond in families]
    settled = F.col(_SETTLED)
    b += [Bucket(name, ct.isin(*types) & settled, else_zero=False) for name, types in R.CHARGE_CATEGORIES]
    b.append(Bucket("credits_charges_total", settled | (ct.isin(*R.TOTAL_ALWAYS_TYPES) & changed_ok)))
    assert tuple(x.name for x in b) == R.CHARGE_BUCKETS
    return b


def with_settled(charges: DataFrame, period: Period) -> DataFrame:
    """Compute once per charge whether it settled: applied to a payout inside
    [settled_from, settled_before), or applied before settled_from as its own
    parent."""
    tz = period.tz
    processed = F.col("processed") == 1
    recent = (processed & local_at_or_after("changed", period.charges_settled_from, tz)
              & local_before("changed", period.charges_settled_before, tz) & F.col("payout_id").isNotNull())
    legacy = processed & local_before("changed", period.charges_settled_from, tz) & (F.col("parent_id") == F.col("id"))
    return charges.withColumn(_SETTLED, recent | legacy)


def charge_sums(charges: DataFrame, period: Period) -> DataFrame:
    """The charges summed into buckets per (event_id, currency), with a partial aggregate."""
    return (with_settled(charges, period)
            .groupBy(F.col("event").alias("event_id"), "currency")
            .agg(*partial_bucket_sums(charge_bucket_rules(period), F.col("amount")))
            .withColumn("_matched", F.lit(True)))


def charge_buckets(payout_level: DataFrame, charges: DataFrame | None, wire_ins: DataFrame,
                   period: Period, sums: DataFrame | None = None) -> DataFrame:
    """OP10: payout-level rows (minus events with wire-ins) left-joined with
    their charges on (event, currency) and summed into buckets. ``sums`` are
    those of :func:`charge_sums`, if they are there already.

    Charges are pre-aggregated per (event, currency) and joined once. Since
    payout-level rows are unique on all their columns,
    this equals the direct join-then-group-by-31-columns; a row without
    charges gets NULL buckets and a 0 total, as in the direct form. A
    payout-level key repeated with several organisers receives the same
    charges on each of its rows, as in the direct form."""
    buckets = charge_bucket_rules(period)
    c = charge_sums(charges, period) if sums is None else sums
    c = c.withColumnsRenamed({"event_id": "_c_event", "currency": "_c_currency"})
    j = payout_level.join(c, (F.col("event_id") == F.col("_c_event")) & (F.col("currency") == F.col("_c_currency")), "left")
    # NOT IN on the event commutes with the join, whose sides may lie ready by
    # (event, currency). As a flag it stays above; an anti join would be pushed
    # below, and shuffle by event what lies by both.
    wired = set_facts(wire_ins=KeySet(wire_ins, "event_id"))["wire_ins"]
    if wired.nulls:
        j = j.where(F.lit(False))
    elif wired.rows:
        j = exists_flag(j, "event_id", wire_ins, "_wired_in", "event_id")
        j = j.where(F.col("event_id").isNotNull() & ~F.col("_wired_in"))
    out = [F.col(x) for x in payout_level.columns]
    for b in buckets:
        v = F.col(b.name)
        if b.else_zero:
            v = F.when(F.col("_matched").isNotNull(), v).otherwise(F.lit(0))
        out.append(v.alias(b.name))
    return j.select(*out)
