"""Registered queries: one per operator / settlement step, each reading the
driver's tables at ``sf_dir`` in full. Money leaves as DOUBLE (exact decimals
inside, rounded once at the edge) so results compare across engines."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlebook.functions.money import cents_to_units, decimals_to_double
from settlebook.functions.timez import at_or_after, before, effective_before, effective_local, local_at_or_after, local_before, local_ts, ts_lit
from settlebook.operators import (
    KeySet, duplicated_keys, exists_flag, fold, full_merge, latest_as_of, merged, not_in, not_in_split, set_facts, unfolded, union_distinct,
)
from settlebook.plans import FIXTURE, close_period, combined_net_sales, multi_processor_events, payment_type_sets
from settlebook.plans import rules as R
from settlebook.plans.charge_rules import charge_sums_by_rules, rules_table, sparse_charge_sums
from settlebook.plans.charges import charge_buckets, charge_snapshot_from_log
from settlebook.plans.net_sales import history_net_sales
from settlebook.plans.payouts import cutoff_matrix, latam_rule, payout_snapshot
from settlebook.sources import DriverTables, SettlementInputs, settlement_inputs

Query = Callable[[SparkSession, str], DataFrame]
P = FIXTURE
NEWEST_FIRST = ("changed", "log_position")


# Per session (dropped with it): inputs by folder. Lazy DataFrames over the
# files found at first use; a folder rewritten later in the same session needs
# ``spark.catalog.refreshByPath``.
_RESOLVED: WeakKeyDictionary = WeakKeyDictionary()


def inputs(spark: SparkSession, sf_dir: str) -> tuple[SettlementInputs, DriverTables]:
    """The driver tables and the settlement inputs derived from them, resolved
    once per session and folder (the scans run with each query, in full)."""
    known = _RESOLVED.setdefault(spark, {})
    key = sf_dir.rstrip("/")
    if key not in known:
        t = DriverTables(spark, sf_dir)
        known[key] = (settlement_inputs(t), t)
    return known[key]


def _q(fn: Callable[[SettlementInputs, DriverTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        x, t = inputs(spark, sf_dir)
        return decimals_to_double(fn(x, t))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# --- sources, projections -------------------------------------------------

def scan_project_rename(x, t):
    """Scan, rename, constant tag and typed NULL filler (PRJ1-8)."""
    return x.payouts.select(F.col("id").alias("payout_id"), F.col("event").alias("event_id"), "user_id",
                            "currency", "payout_type", "created", "status",
                            F.lit(None).cast("int").alias("status_old"), "amount", F.lit("payout").alias("source"))


# --- filters --------------------------------------------------------------

def filter_half_open_range(x, t):
    c = F.col("transaction_created")
    return x.order_itemizations.where((c >= ts_lit("1999-01-01")) & (c < ts_lit("2000-01-01"))).select(
        "order_id", "event_id", "currency", "transaction_created")


def filter_between_inclusive(x, t):
    return x.orders.where(F.col("changed").between(ts_lit("1996-01-01"), ts_lit("1996-12-31"))).select(
        "id", "changed")


def filter_in_not_in_list(x, t):
    return x.orders.where(F.col("payment_type").isin(R.EPP_PAYMENT_TYPE, R.OFFLINE_PAYMENT_TYPE, "paypal")
                          & ~F.col("status").isin(200, 400)).select("id", "payment_type", "status")


def filter_code_null_logic(x, t):
    c = x.invoice_charges
    cond = (((F.col("processed") == 1) & F.col("payout_id").isNotNull() & (F.col("amount") > 100))
            | ((F.col("processed") == 1) & (F.col("parent_id") == F.col("id"))))
    return c.where(cond).select("id", "charge_type", "processed", "payout_id", "parent_id", "amount")


# --- time -------------------------------------------------------------------

def local_wall_clock(x, t):
    return t.events.select("event_id", "ts", local_ts("ts").alias("local_ts"))


def local_cutoff(x, t):
    return t.events.where(local_at_or_after("ts", "2024-01-10") & local_before("ts", "2024-01-20")).select(
        "event_id", "ts")


def effective_date(x, t):
    h = x.history_payouts
    return h.where(effective_before(["trx_date", "created"], "2024-01-15")).select(
        "log_position", "payout_id", effective_local(["trx_date", "created"]).alias("effective_at"))


def currency_cutoff_matrix(x, t):
    m, l = cutoff_matrix(P), latam_rule(P)
    return x.history_payouts.where(m | l).select(
        "log_position", "payout_id", "currency", "payout_type", "status",
        F.when(m, 1).otherwise(0).alias("in_matrix"), F.when(l, 1).otherwise(0).alias("in_latam"))


# --- joins ------------------------------------------------------------------

def join_inner(x, t):
    e = x.events.select(F.col("id").alias("_e_id"), "current_status", "uid")
    return x.history_orders.join(e, F.col("event_id") == F.col("_e_id"), "inner").select(
        "order_id", "log_position", "event_id", "current_status", "uid")


def join_left_computed_key(x, t):
    # orders are keyed by id, so their keys are distinct as they are (see in_under_or)
    keys = x.orders.select(F.col("id").alias("_o_id"), F.col("event").alias("_o_event"),
                           F.col("currency").alias("_o_currency"))
    j = x.order_itemizations.join(keys, F.col("order_id") == F.col("_o_id"), "left")
    j = j.withColumn("event_key", F.coalesce("event_id", "_o_event"))
    e = x.events.select(F.col("id").alias("_e_id"), "current_status", "end_date")
    j = j.join(e, F.col("event_key") == F.col("_e_id"), "left")
    return j.select("order_id", "event_key", F.coalesce("currency", "_o_currency").alias("currency_key"),
                    "current_status", "end_date", "transaction_created")


def _payout_and_charge_totals(x):
    p = x.history_payouts.groupBy("event_id", "currency").agg(F.sum("amount").alias("payout_amount"))
    c = x.invoice_charges.groupBy(F.col("event").alias("event_id"), "currency").agg(
        F.sum("amount").alias("charge_amount"))
    return p, c


def join_left_two_keys(x, t):
    p, c = _payout_and_charge_totals(x)
    return p.join(c, ["event_id", "currency"], "left").select("event_id", "currency", "payout_amount",
                                                               "charge_amount")


def join_full_outer_merge(x, t):
    p, c = _payout_and_charge_totals(x)
    m = full_merge(p, c, on=["event_id", "currency"],
                   columns=[("event_id", "left"), ("currency", "left"), ("payout_amount", "left"),
                            ("charge_amount", "right")])
    return m.withColumn("net", F.coalesce("payout_amount", F.lit(0)) - F.coalesce("charge_amount", F.lit(0)))


# --- NOT IN / IN ------------------------------------------------------------

def not_in_set(x, t):
    return not_in(x.orders, "event", x.event_exclusions, keys_unique=True).select("id", "event")


def not_in_set_with_null(x, t):
    return not_in(x.orders, "event", x.events.select("event_parent")).select("id", "event")


def not_in_empty_set(x, t):
    return not_in(x.orders, "event", x.events.where(F.col("id") < 0).select("id")).select("id", "event")


def not_in_dup_keys(x, t):
    return not_in(x.events, "id", duplicated_keys(x.prior_event_level, "event_id")).select("id", "current_status")


def _paid_history_orders(x, local_time: bool):
    h = x.history_orders
    c = F.col("changed")
    if local_time:
        window = local_at_or_after(c, P.history_from) & local_before(c, P.history_split)
    else:
        window = (c >= ts_lit(P.history_from)) & (c < ts_lit(P.history_split))
    rows = h.where(window & F.col("payment_type").isin(*R.NET_SALES_PAYMENT_TYPES)
                   & F.col("status").isin(*R.ORDER_STATUSES_KEPT))
    return latest_as_of(rows, ["order_id"], NEWEST_FIRST, then=F.col("status") == R.ORDER_STATUS_PAID)


def not_in_windowed(x, t):
    o = x.orders.where((F.col("status") == 100) & (F.col("changed") < ts_lit(P.history_split))
                       & F.col("payment_type").isin(*R.NET_SALES_PAYMENT_TYPES))
    return not_in(o, "id", _paid_history_orders(x, False).select("order_id")).select("id", "event", "currency")


def not_in_self(x, t):
    h = x.history_payouts
    wired = h.where(F.col("status") == R.WIRE_STATUS).select("payout_id")
    return not_in(h, "payout_id", wired).select("log_position", "payout_id", "status")


def in_under_or(x, t):
    # transfer orders are keyed by id: no DISTINCT between shuffle and join, so AQE can split a hot order
    h = exists_flag(x.history_orders, "order_id", x.transfer_orders, "_transfer", keys_unique=True)
    return h.where((F.col("changed") < ts_lit("1997-01-01")) | F.col("_transfer")).select(
        "order_id", "log_position", "changed")


# --- windows ----------------------------------------------------------------

def latest_row(x, t):
    return latest_as_of(x.history_orders, ["order_id"], NEWEST_FIRST).select(
        "order_id", "log_position", "changed", "status", "event_id")


def latest_as_of_status(x, t):
    return _paid_history_orders(x, False).select("order_id", "log_position", "event_id", "gross")


# --- aggregates ---------------------------------------------------------------

def cents_sum(x, t):
    i = x.order_itemizations
    epp = F.sum(sum((F.col(c) for c in R.EPP_COMPONENTS[1:]), F.col(R.EPP_COMPONENTS[0])))
    off = F.sum(sum((-F.col(c) for c in R.OFFLINE_DEDUCTIONS[1:]), -F.col(R.OFFLINE_DEDUCTIONS[0])))
    g = i.groupBy("event_id", "currency").agg(epp.alias("_e"), off.alias("_o"))
    return g.select("event_id", "currency", cents_to_units(-F.col("_e")).alias("epp_net_sales"),
                    cents_to_units(-F.col("_o")).alias("offline_net_sales"))


def conditional_sum(x, t):
    pt = F.col("payment_type")
    net = F.col("gross") - F.col("mg_fee")
    return x.history_orders.groupBy("event_id", "currency").agg(
        (-F.sum(F.when(pt == R.EPP_PAYMENT_TYPE, net).otherwise(0))).alias("epp_net_sales"),
        F.sum(F.when(pt == "offline", F.col("mg_fee")).otherwise(0)).alias("offline_net_sales"),
        F.sum(F.when(pt == R.EPP_PAYMENT_TYPE, net).otherwise(-F.col("mg_fee"))).alias("net_sales"))


def reaggregate_rounded(x, t):
    per_order = x.history_orders.groupBy("event_id", "currency", "order_id").agg(
        F.sum(F.col("gross") - F.col("mg_fee")).alias("s"))
    return per_order.groupBy("event_id", "currency").agg(F.round(F.sum("s"), 2).alias("net_sales"),
                                                         F.sum("s").alias("net_sales_raw"))


def distinct_rows(x, t):
    return x.orders.select(F.col("id").alias("order_id"), F.col("event").alias("event_id"), "currency").distinct()


def union_distinct_two(x, t):
    return union_distinct(x.orders.select(F.col("event").alias("event_id"), "currency"),
                          x.history_orders.select("event_id", "currency"))


def union_distinct_three(x, t):
    h = x.history_payouts
    return union_distinct(
        h.where(F.col("payout_type") == R.ACH).select("payout_id", "currency", F.lit("history").alias("source")),
        h.where(F.col("status") == R.WIRE_STATUS).select("payout_id", "currency", F.lit("history").alias("source")),
        x.payouts.select(F.col("id").alias("payout_id"), "currency", F.lit("payout").alias("source")))


def count_distinct_list(x, t):
    s = payment_type_sets(x.orders)
    return s.select("event", F.col("num_payment_types").cast("bigint").alias("num_payment_types"), "payment_types")


# --- settlement steps ----------------------------------------------------------

def _close(x: SettlementInputs):
    """The lazy close DAG for a set of inputs (a plan, not a result)."""
    return close_period(x, P)


def q_itemized_net_sales(x, t):
    return _close(x).itemized


def q_history_net_sales(x, t):
    return _close(x).history


def q_combined_net_sales(x, t):
    return combined_net_sales(x.history_orders, x.orders, x.events, P)


def q_merge_net_sales(x, t):
    return _close(x).merged


def q_with_parent(x, t):
    return _close(x).parented


def q_apply_payment_options(x, t):
    return _close(x).net_sales


def q_payout_snapshot(x, t):
    return _close(x).payout_snapshot


def q_payout_buckets(x, t):
    return _close(x).payout_level


def q_charge_snapshot(x, t):
    return _close(x).charge_snapshot


def q_charge_buckets(x, t):
    return _close(x).event_level


def q_balance(x, t):
    return _close(x).balance


def q_multi_processor_events(x, t):
    return multi_processor_events(x.orders)


def latest_payment_options(x, t):
    from settlebook.plans.net_sales import latest_payment_options as latest_options
    return latest_options(x.history_payment_options, P)


def prior_period_duplicates(x, t):
    return duplicated_keys(x.prior_event_level, "event_id")


def settled_charges(x, t):
    from settlebook.plans.charges import with_settled
    return with_settled(x.invoice_charges, P).select(
        "id", "event", "currency", F.when(F.col("_settled"), 1).otherwise(0).alias("settled"))


def net_sales_with_processors(x, t):
    """Order-log net sales annotated with the event's processor combination."""
    n = combined_net_sales(x.history_orders, x.orders, x.events, P)
    p = multi_processor_events(x.orders).select(F.col("event").alias("_p_event"), "payment_types")
    return n.join(p, F.col("event_id") == F.col("_p_event"), "left").drop("_p_event")


def payout_level_duplicates(x, t):
    """Check query: (event, currency) keys that reach the charge join on more
    than one payout-level row (each such row receives the same charges)."""
    pl = _close(x).payout_level
    return pl.groupBy("event_id", "currency").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def not_in_bitmap(x, t):
    """Current payouts that the log never saw, most of them told by a bitmap of the log's ids (JN18)."""
    logged = KeySet(x.history_payouts, "payout_id")
    facts = set_facts(logged=logged)["logged"]
    return not_in_split(x.payouts, "id", x.history_payouts, "payout_id", facts).select("id", "event", "status")


def latest_carried_on(x, t):
    """The newest version per payout before a cutoff: an earlier close's state and the rows since (WIN3)."""
    order, payload = NEWEST_FIRST, ("status", "amount", "currency")
    h = x.history_payouts
    earlier = fold(h.where(before("changed", "2024-01-15")), ["payout_id"], order, payload)
    since = fold(h.where(at_or_after("changed", "2024-01-15") & before("changed", P.wire_before)), ["payout_id"], order, payload)
    return unfolded(merged([earlier, since], ["payout_id"]), ["payout_id"])


def charge_buckets_by_rules(x, t):
    """OP10 with the charge types' buckets as a table of rules (AGG10)."""
    close = _close(x)
    rules = rules_table(x.invoice_charges.sparkSession)
    sums = charge_sums_by_rules(close.charge_snapshot, rules, P)
    return charge_buckets(close.payout_level, None, x.wire_in_events, P, sums=sums)


def charge_rule_sums(x, t):
    """The sparse sums per (event, currency, bucket)."""
    return sparse_charge_sums(_close(x).charge_snapshot, rules_table(x.invoice_charges.sparkSession), P)


def payout_snapshot_filtered(x, t):
    """VAR3: current payouts are left out only if the log has a qualifying version of them."""
    return payout_snapshot(x.history_payouts, x.payouts, x.manual_voids, P, exclude_against="filtered")


def charge_log_snapshot(x, t):
    """VAR4: charges as of the cutoff from a change log (the charges with their
    versions: as created, and as changed)."""
    return charge_snapshot_from_log(history_charges(x), P)


def history_net_sales_all(x, t):
    """OP2 where equal sums of log and current orders both count (A2's flag)."""
    return history_net_sales(x.history_orders, x.orders, x.events, x.users, x.transfer_orders, P, dedupe=False)


def history_charges(x) -> DataFrame:
    """A change log of the charges: version 1 unprocessed when created, version 2 as it is."""
    c = x.invoice_charges.withColumnRenamed("id", "invoice_charge_id")
    first = c.withColumn("changed", F.col("created")).withColumn("processed", F.lit(0)).withColumn("log_position", F.lit(1).cast("bigint"))
    return first.unionByName(c.withColumn("log_position", F.lit(2).cast("bigint")))


_ALL = [
    payout_snapshot_filtered, charge_log_snapshot, history_net_sales_all,
    not_in_bitmap, latest_carried_on, charge_buckets_by_rules, charge_rule_sums,
    scan_project_rename, filter_half_open_range, filter_between_inclusive, filter_in_not_in_list,
    filter_code_null_logic, local_wall_clock, local_cutoff, effective_date, currency_cutoff_matrix,
    join_inner, join_left_computed_key, join_left_two_keys, join_full_outer_merge,
    not_in_set, not_in_set_with_null, not_in_empty_set, not_in_dup_keys, not_in_windowed, not_in_self,
    in_under_or, latest_row, latest_as_of_status, cents_sum, conditional_sum, reaggregate_rounded,
    distinct_rows, union_distinct_two, union_distinct_three, count_distinct_list,
    q_itemized_net_sales, q_history_net_sales, q_combined_net_sales, q_merge_net_sales, q_with_parent,
    q_apply_payment_options, q_payout_snapshot, q_payout_buckets, q_charge_snapshot, q_charge_buckets,
    q_balance, q_multi_processor_events, payout_level_duplicates,
    latest_payment_options, prior_period_duplicates, settled_charges, net_sales_with_processors,
]


def queries() -> dict[str, Query]:
    return {fn.__name__.removeprefix("q_"): _q(fn) for fn in _ALL}
