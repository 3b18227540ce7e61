"""Events paid through more than one payment processor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.plans import rules as R


def payment_type_sets(orders: DataFrame) -> DataFrame:
    """Per event: number of distinct payment types among paid orders with a
    fee, and their sorted comma-joined list.

    One ``collect_set`` feeds both the count and the list: it is a partial
    aggregate whose buffer is bounded by the number of payment types, so an
    event with a huge number of orders is folded map-side."""
    paid = orders.where(~F.col("payment_type").isin(*R.EDGE_EXCLUDED_PAYMENT_TYPES)
                        & (F.col("status") == R.ORDER_STATUS_PAID) & (F.col("mg_fee") > 0))
    g = paid.groupBy("event").agg(F.collect_set("payment_type").alias("_types"))
    return g.select("event", F.size("_types").alias("num_payment_types"),
                    F.array_join(F.array_sort("_types"), ",").alias("payment_types"))


def multi_processor_events(orders: DataFrame, combos=R.EDGE_PROCESSOR_COMBOS) -> DataFrame:
    """OP12: events with more than one processor in one of the listed combinations."""
    s = payment_type_sets(orders)
    return s.where((F.col("num_payment_types") > 1) & F.col("payment_types").isin(*combos)).select(
        "event", "payment_types")
