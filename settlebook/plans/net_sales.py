"""Net sales per (event, currency): itemized, from the order log, merged,
parent-resolved and adjusted by the parent's payment options.

Events and users are current-state tables keyed by ``id``. Their attributes
(status, organiser, end date, account type) are functionally dependent on the
event, so every step below aggregates the large side by ``(event_id,
currency)`` first (partial, map-side aggregation: a popular event is folded
before the shuffle) and only then looks the attributes up on the much
smaller aggregate. Grouping by the attributes as well, as a direct
transcription would, yields the same groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.functions.money import cents_to_units
from settlebook.functions.timez import at_or_after, before, day_of, local_at_or_after, local_before
from settlebook.operators import (
    Facts, KeySet, duplicated_keys, exists_flag, full_merge, latest_as_of, newest, not_in, set_facts,
)
from settlebook.plans import rules as R
from settlebook.plans.period import Period

NEWEST_FIRST = ("changed", "log_position")


def _sum_expr(cols) -> Column:
    # a + b + ... : NULL if any term is NULL (the whole row drops out of SUM).
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols])


def _event_attributes(df: DataFrame, events: DataFrame, users: DataFrame, how: str = "inner",
                      with_account: bool = True) -> DataFrame:
    """Attach status / organiser / end date (and account type) to rows keyed
    by ``event_id``."""
    e = events.select(F.col("id").alias("_e_id"), "current_status", F.col("uid").alias("org_uid"), "end_date")
    out = df.join(e, F.col("event_id") == F.col("_e_id"), how).drop("_e_id")
    if with_account:
        u = users.select(F.col("id").alias("_u_id"), "account_type")
        out = out.join(u, F.col("org_uid") == F.col("_u_id"), "left").drop("_u_id")
    return out


def itemized_net_sales(items: DataFrame, orders: DataFrame, events: DataFrame, users: DataFrame,
                       exclusions: DataFrame, prior_event_level: DataFrame, transfers: DataFrame,
                       period: Period) -> DataFrame:
    """OP1: net sales from line-level itemizations in [itemized_from, itemized_to),
    without transfer orders, excluded events and events duplicated in the
    prior period's output."""
    created, day = "transaction_created", day_of(items, "transaction_created")
    it = items.where(at_or_after(created, period.itemized_from, day) & before(created, period.itemized_to, day))
    # Fold line items per (order, event, currency) first: a partial aggregate,
    # so an order or event with a huge number of lines is reduced map-side.
    # Sums of partial sums equal the sums (NULL rows drop out either way), and
    # a fan-out of the order-key join repeats a partial sum exactly as it would
    # repeat each of its lines.
    per_order = it.groupBy("order_id", "event_id", "currency").agg(
        F.sum(_sum_expr(R.EPP_COMPONENTS)).alias("_epp_cents"),
        F.sum(reduce(lambda a, b: a - b, [F.lit(0)] + [F.col(c) for c in R.OFFLINE_DEDUCTIONS])).alias("_offline_cents"))
    # The NULL and empty cases of all three NOT IN sets: one job, before the plan is built.
    repeated = duplicated_keys(prior_event_level, "event_id")
    only = exclusions.columns[0]
    facts = set_facts(transfers=KeySet(transfers, "order_id"), excluded=KeySet(exclusions, only), repeated=KeySet(repeated, "event_id"))
    per_order = not_in(per_order, "order_id", transfers, "order_id", facts=facts["transfers"])
    # Partitioned by order id once: that serves both the DISTINCT (a subset of
    # its keys) and the join, instead of one shuffle for each.
    order_keys = orders.select(F.col("id").alias("_o_id"), F.col("event").alias("_o_event"),
                               F.col("currency").alias("_o_currency")).repartition("_o_id").distinct()
    j = per_order.join(order_keys, F.col("order_id") == F.col("_o_id"), "left")
    sums = (j.groupBy(F.coalesce("event_id", "_o_event").alias("event_id"),
                      F.coalesce("currency", "_o_currency").alias("currency"))
             .agg(F.sum("_epp_cents").alias("_epp_cents"), F.sum("_offline_cents").alias("_offline_cents")))
    # NOT IN on the event key commutes with grouping by it: filter the aggregate.
    # Both event sets are one: an event is out if it is excluded or counted twice before.
    marks = exclusions.select(F.col(only).alias("event_id"), F.lit(2).alias("_mark")).unionAll(
        prior_event_level.select("event_id", F.lit(1).alias("_mark")))
    out_of = marks.groupBy("event_id").agg(F.sum("_mark").alias("_marks")).where("_marks > 1").select("event_id")
    both = Facts(facts["excluded"].rows + facts["repeated"].rows, facts["excluded"].nulls + facts["repeated"].nulls)
    sums = not_in(sums, "event_id", out_of, keys_unique=True, facts=both)
    out = _event_attributes(sums, events, users, how="left")
    return out.select(
        "event_id", "current_status", "org_uid", "account_type", "currency", "end_date",
        cents_to_units(-F.col("_epp_cents")).alias("epp_net_sales"),
        cents_to_units(-F.col("_offline_cents")).alias("offline_net_sales"),
    )


_VERSION_PAYLOAD = ("status", "event_id", "currency", "gross", "mg_fee", "payment_type")


def _qualifying(history: DataFrame, transfers: DataFrame | None, period: Period, local: bool) -> DataFrame:
    """Log versions that may represent an order: changed on/after
    ``history_from``, a net-sales payment type, a kept status, and changed
    before ``history_split`` unless the order is a transfer. Later versions
    count for transfers alone, so only those of transfer orders (a semi join
    on the later part of the log) go on."""
    c, day = "changed", day_of(history, "changed")
    if local:
        start = local_at_or_after(c, period.history_from, period.tz, day)
        before_split = local_before(c, period.history_split, period.tz, day)
        after_split = local_at_or_after(c, period.history_split, period.tz, day)
    else:
        start = at_or_after(c, period.history_from, day)
        before_split = before(c, period.history_split, day)
        after_split = at_or_after(c, period.history_split, day)
    rows = history.where(start & F.col("payment_type").isin(*R.NET_SALES_PAYMENT_TYPES)
                         & F.col("status").isin(*R.ORDER_STATUSES_KEPT))
    early = rows.where(before_split)
    if transfers is None:
        return early
    t = transfers.select(F.col("order_id").alias("_t_id"))
    return early.unionByName(rows.where(after_split).join(t, F.col("order_id") == F.col("_t_id"), "left_semi"))


def _newest_per_event(rows: DataFrame) -> DataFrame:
    """Versions folded per (order, event) with a partial aggregate: the only
    shuffle at the size of the log; a hot order or event is cut down map-side."""
    return rows.groupBy("order_id", "event_id").agg(newest(NEWEST_FIRST, _VERSION_PAYLOAD).alias("_v"))


def _current_paid(orders: DataFrame, period: Period, local: bool) -> DataFrame:
    c, day = "changed", day_of(orders, "changed")
    before_split = local_before(c, period.history_split, period.tz, day) if local else before(c, period.history_split, day)
    return orders.where((F.col("status") == R.ORDER_STATUS_PAID) & before_split
                        & F.col("payment_type").isin(*R.NET_SALES_PAYMENT_TYPES))


def _is(pt: str) -> Column:
    return F.col("payment_type") == pt


_SALE = ("event_id", "currency", "gross", "mg_fee", "payment_type")


def _log_and_current(history, orders, events, transfers, period, local, measures, dedupe) -> DataFrame:
    """Sums per branch, event and currency (UNION of the branches, so equal
    rows once; both with ``dedupe=False``): what the log says of each order, and current paid orders that
    the log has not taken already.

    An order of the log is summed if its newest qualifying version among those
    of known events is paid; it is taken if its newest qualifying version of
    all is. Current orders join the same per-order aggregate as the log's
    versions, so "already taken" is a property of the order's own row: one
    shuffle by order, with one consumer, and no anti join. SQL's NOT IN keeps
    nothing if a taken order has no id; one scalar subquery over the log's
    rows without an id (a pushed filter) looks for that. Current orders are
    keyed by id; a row without one is never kept.
    """
    per_event = _newest_per_event(_qualifying(history, transfers, period, local))
    per_event = exists_flag(per_event, "event_id", events.select("id"), "_known_event", "id", keys_unique=True)
    sale = "struct<{}>".format(", ".join(f"{c}:{history.schema[c].dataType.simpleString()}" for c in _SALE))
    versions = per_event.select("order_id", "_v", F.when(F.col("_known_event"), F.col("_v")).alias("_ev"), F.lit(None).cast(sale).alias("_cur"))
    current = _current_paid(orders, period, local).where(F.col("id").isNotNull()).withColumn("event_id", F.col("event")).select(
        F.col("id").alias("order_id"), *(F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in ("_v", "_ev")),
        F.struct(*_SALE).cast(sale).alias("_cur"))
    per_order = versions.unionByName(current).groupBy("order_id").agg(
        F.max("_v").alias("_all"), F.max("_ev").alias("_ev"), F.collect_list("_cur").alias("_cur"))
    anonymous = _newest_per_event(_qualifying(history.where(F.col("order_id").isNull()), transfers, period, local))
    taken_without_id = anonymous.agg(F.max("_v").alias("v")).select(
        F.coalesce(F.col("v.status") == R.ORDER_STATUS_PAID, F.lit(False))).scalar()
    taken = F.coalesce(F.col("_all.status") == R.ORDER_STATUS_PAID, F.lit(False))
    none = F.array().cast(f"array<{sale}>")
    logged = F.when(F.col("_ev.status") == R.ORDER_STATUS_PAID, F.array(F.struct(*(F.col(f"_ev.{c}") for c in _SALE)).cast(sale))).otherwise(none)
    fresh = F.when(taken | F.col("_anonymous"), none).otherwise(F.col("_cur"))

    def tagged(tag: str, rows: Column) -> Column:
        return F.transform(rows, lambda r: F.struct(F.lit(tag).alias("branch"), r.alias("s")))

    per_order = per_order.withColumn("_anonymous", taken_without_id)
    sales = per_order.select(F.explode(F.concat(tagged("log", logged), tagged("current", fresh))).alias("x")).select("x.branch", "x.s.*")
    sums = sales.groupBy("branch", "event_id", "currency").agg(*measures).drop("branch")
    return sums.distinct() if dedupe else sums


def history_net_sales(history: DataFrame, orders: DataFrame, events: DataFrame, users: DataFrame,
                      transfers: DataFrame, period: Period, dedupe: bool = True) -> DataFrame:
    """OP2: net sales from the order change log (latest version per order,
    local wall-clock window, plus all transfer orders), unioned with current
    orders the log did not already account for; split into the processor's
    (epp) and offline parts. With ``dedupe=False`` an event whose log and current
    sums are equal counts both (the worksheet's UNION keeps one)."""
    measures = [
        (-F.sum(F.when(_is(R.EPP_PAYMENT_TYPE), F.col("gross") - F.col("mg_fee")).otherwise(0))).alias("epp_net_sales"),
        F.sum(F.when(_is(R.OFFLINE_PAYMENT_TYPE), F.col("mg_fee")).otherwise(0)).alias("offline_net_sales"),
    ]
    both = _log_and_current(history, orders, events, transfers, period, True, measures, dedupe)
    # Attributes are functions of the event, so the distinct union, the
    # non-zero filter and the re-aggregation run on (event_id, currency); one
    # inner lookup at the end also drops current orders of unknown events.
    both = both.where((F.col("epp_net_sales") != 0) | (F.col("offline_net_sales") != 0))
    both = both.groupBy("event_id", "currency").agg(F.round(F.sum("epp_net_sales"), 2).alias("epp_net_sales"),
                                                    F.round(F.sum("offline_net_sales"), 2).alias("offline_net_sales"))
    return _event_attributes(both, events, users).select(
        "event_id", "current_status", "org_uid", "account_type", "currency", "end_date",
        "epp_net_sales", "offline_net_sales")


def combined_net_sales(history: DataFrame, orders: DataFrame, events: DataFrame, period: Period, dedupe: bool = True) -> DataFrame:
    """OP3: one signed net-sales figure per (event, status, organiser,
    currency): raw timestamps, no users, no transfer exception."""
    measure = F.sum(F.when(_is(R.EPP_PAYMENT_TYPE), F.col("gross") - F.col("mg_fee"))
                     .otherwise(-F.col("mg_fee"))).alias("net_sales")
    both = _log_and_current(history, orders, events, None, period, False, [measure], dedupe).where(F.col("net_sales") != 0)
    both = both.groupBy("event_id", "currency").agg(F.sum("net_sales").alias("net_sales"))
    return _event_attributes(both, events, None, with_account=False).select(
        "event_id", "current_status", "org_uid", "currency", "net_sales")


def merge_net_sales(itemized: DataFrame, history: DataFrame) -> DataFrame:
    """OP4: full outer merge of the two sources on (event_id, currency)."""
    return full_merge(
        itemized, history, on=["event_id", "currency"],
        columns=[("event_id", "left"), ("account_type", "right"), ("current_status", "right"),
                 ("org_uid", "right"), ("currency", "right"), ("end_date", "right")],
        add=["epp_net_sales", "offline_net_sales"],
    )


def with_parent(net_sales: DataFrame, events: DataFrame) -> DataFrame:
    """OP5: attach the parent event (itself when it has none); rows whose
    event is unknown are dropped."""
    e = events.select(F.col("id").alias("_e_id"), "event_parent")
    j = net_sales.join(e, F.col("event_id") == F.col("_e_id"), "inner")
    parent = F.when(F.col("event_parent").isNull(), F.col("_e_id")).otherwise(F.col("event_parent"))
    return j.select(*[F.col(c) for c in net_sales.columns], parent.alias("parent"))


def latest_payment_options(options: DataFrame, period: Period) -> DataFrame:
    return latest_as_of(options, ["event_id"], NEWEST_FIRST,
                        where=before("changed", period.options_before, day_of(options, "changed")))


def apply_payment_options(net_sales: DataFrame, options: DataFrame, period: Period) -> DataFrame:
    """OP6: keep offline net sales only where the parent event's latest
    payment options accept the processor and neither PayPal nor Authorize.net
    (NULL flags count as not accepting)."""
    p = latest_payment_options(options, period).select(
        F.col("event_id").alias("_p_event"), R.ACCEPT_PROCESSOR, R.ACCEPT_PROCESSOR_OLD, R.ACCEPT_PAYPAL,
        R.ACCEPT_AUTHNET)
    j = net_sales.join(p, F.col("parent") == F.col("_p_event"), "left")
    keeps = (((F.col(R.ACCEPT_PROCESSOR) == 1) | (F.col(R.ACCEPT_PROCESSOR_OLD) == 1))
             & ((F.col(R.ACCEPT_PAYPAL) != 1) & (F.col(R.ACCEPT_AUTHNET) != 1)))
    return j.select("event_id", "current_status", "account_type", "end_date", "org_uid", "currency",
                    "epp_net_sales",
                    F.when(keeps, F.col("offline_net_sales")).otherwise(0).alias("offline_net_sales"))
