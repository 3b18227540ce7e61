"""Invariants of the close on the driver data (sf0.01)."""

from pyspark.sql import functions as F

from settlebook.plans import rules as R
from settlebook.queries import inputs, _close

from conftest import SF_CHECK


def test_close_invariants(spark):
    x, _ = inputs(spark, SF_CHECK)
    close = _close(x)
    snap = close.payout_snapshot
    # at most one row per payout for each rule family; current rows once
    per = snap.groupBy("payout_id", "source").count()
    assert per.where((F.col("source") == "payout") & (F.col("count") > 1)).count() == 0
    assert per.where(F.col("count") > 2).count() == 0
    # balance is the sum of its terms
    b = close.balance
    terms = sum((F.coalesce(F.col(t), F.lit(0)) for t in R.BALANCE_TERMS[1:]), F.coalesce(F.col(R.BALANCE_TERMS[0]), F.lit(0)))
    assert b.where(F.col("balance") != F.round(terms, 2)).count() == 0
    # withheld payouts in the file are part of what was confirmed in the file
    withheld = sum((F.col(f"ach_withheld_{k}_in_file") for k, _ in R.WITHHELD_KINDS), F.col("ach_withheld_other_fraud_in_file"))
    assert b.where(withheld > F.col("ach_confirmed_in_file")).count() == 0
    # one event-level row per payout-level row that survives the wire-in filter
    assert b.count() <= close.payout_level.count()
