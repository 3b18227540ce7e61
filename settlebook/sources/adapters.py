"""Settlement-shaped inputs derived from the driver's tables.

The settlement steps read a ticketing warehouse (orders and their change log,
line-level itemizations, payouts and their change log, payment options,
invoice charges, key sets). The driver provides TPC-H-like tables instead, so
each input is derived here by a deterministic, integer-only recipe (see
FIXTURES.md section 3). The same recipes are written in SQL in
``settlebook.oracle.adapters`` for the DuckDB oracle.

Every derivation is a projection/filter (plus one equi-join of line items to
orders), so it scales with the source tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.functions.money import MONEY, dec_lit
from settlebook.functions.timez import ts_lit
from settlebook.plans import rules as R
from settlebook.sources.tables import DriverTables

# Adapter recipe values (test fixtures, not settlement rules).
CURRENCY_CYCLE = ("USD", "AUD", "CAD", "EUR", "GBP", "NZD", "BRL", "ARS", "MXN", "SGD", "HKD")
EVENT_STATUSES = ("live", "started", "ended", "canceled")
ACCOUNT_TYPES = ("self", "enterprise", "partner")
HISTORY_PAYMENT_TYPES = (R.EPP_PAYMENT_TYPE, R.EPP_PAYMENT_TYPE, R.OFFLINE_PAYMENT_TYPE, "paypal")
PAYOUT_STATUS_CYCLE = (0, 1, 2, 3, 4, 5, 5, 5, 5, 5, 6, 7, 8, 10, 11, 12, 13)
STATUS_OLD_CYCLE = (None, 2, 1)
WITHHELD_CYCLE = (None, 1, 2, 4, 5, 3)
REASON_CYCLE = (None, 6, 7, 1)
UNCATEGORISED_CHARGES = ("CHARGE_NEW_PRODUCT", "CREDIT_GOODWILL")
# 20 charge labels: the first label of each category bucket, the funding and
# transfer types, and two labels no bucket knows.
CHARGE_LABELS = (tuple(types[0] for _, types in R.CHARGE_CATEGORIES)
                 + ("CREDIT_BACKUP_FUNDING", "CHARGE_UNDERPAYMENT_REFUND",
                    "CREDIT_BALANCE_TRANSFER", "CHARGE_BALANCE_TRANSFER")
                 + UNCATEGORISED_CHARGES)
RIGHT_ONLY_EVENT_OFFSET = 1_000_000
CURRENT_ONLY_PAYOUT_OFFSET = 5_000_000


def pick(values, index: Column, dtype: str | None = None) -> Column:
    """Element ``index`` (0-based) of a literal list."""
    lits = [F.lit(v) if v is not None else F.lit(None) for v in values]
    if dtype:
        lits = [x.cast(dtype) for x in lits]
    return F.element_at(F.array(*lits), (index + 1).cast("int"))


def currency_of(key: Column) -> Column:
    return pick(CURRENCY_CYCLE, key % len(CURRENCY_CYCLE))


def plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def events(t: DriverTables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    return c.where(k % 97 != 13).select(
        k.alias("id"),
        F.col("c_nationkey").cast("bigint").alias("uid"),
        F.when(k % 3 == 0, k % 100).alias("event_parent"),
        pick(EVENT_STATUSES, k % 4).alias("current_status"),
        plus_days(ts_lit("1994-12-01"), k % 2000).alias("start_date"),
        plus_days(ts_lit("1995-01-01"), k % 2000).alias("end_date"),
    )


def users(t: DriverTables) -> DataFrame:
    n = t.nation
    return n.where(F.col("n_nationkey") % 7 != 3).select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        pick(ACCOUNT_TYPES, F.col("n_regionkey") % 3).alias("account_type"),
    )


def orders(t: DriverTables) -> DataFrame:
    o = t.orders
    key = F.col("o_orderkey")
    gross = F.col("o_totalprice").cast(MONEY)
    prio = F.substring("o_orderpriority", 1, 1)
    return o.select(
        key.alias("id"),
        F.col("o_custkey").alias("event"),
        currency_of(F.col("o_custkey")).alias("currency"),
        gross.alias("gross"),
        F.when(key % 10 == 0, F.lit(0).cast(MONEY))
         .otherwise(F.round(gross * dec_lit("0.05", 3, 2), 2).cast(MONEY)).alias("mg_fee"),
        F.when(prio == "1", R.EPP_PAYMENT_TYPE).when(prio == "2", R.OFFLINE_PAYMENT_TYPE).when(prio == "3", "paypal")
         .when(prio == "4", "google").otherwise("free").alias("payment_type"),
        F.when(F.col("o_orderstatus") == "F", 100)
         .when(F.col("o_orderstatus") == "O", F.when(key % 2 == 0, 100).otherwise(200))
         .when(F.col("o_orderstatus") == "P", 400).cast("int").alias("status"),
        F.col("o_orderdate").alias("changed"),
    )


def _lines_with_orders(t: DriverTables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey")
    return t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def history_orders(t: DriverTables) -> DataFrame:
    lo = _lines_with_orders(t)
    gross = F.col("l_extendedprice").cast(MONEY)
    return lo.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("event_id"),
        gross.alias("gross"),
        F.round(gross * F.col("l_tax").cast(MONEY), 2).cast(MONEY).alias("mg_fee"),
        pick(HISTORY_PAYMENT_TYPES, (F.col("l_orderkey") + F.col("l_linenumber")) % 4).alias("payment_type"),
        currency_of(F.col("o_custkey")).alias("currency"),
        F.when(F.col("l_partkey") % 13 == 0, 500)
         .when(F.col("l_returnflag") == "N", 200)
         .when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") % 2 == 0), 350)
         .otherwise(100).cast("int").alias("status"),
        F.col("l_shipdate").alias("changed"),
        (F.col("l_linenumber").cast("bigint") * 10_000_000 + F.col("l_partkey")).alias("log_position"),
    )


def order_itemizations(t: DriverTables) -> DataFrame:
    lo = _lines_with_orders(t)
    ln = F.col("l_linenumber").cast("bigint")
    no_event = F.col("l_linenumber") % 3 == 0
    ext = F.col("l_extendedprice").cast(MONEY)
    ext_c = (ext * 100).cast("bigint")
    tax_c = (F.round(ext * F.col("l_tax").cast(MONEY), 2) * 100).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return lo.select(
        F.col("l_orderkey").alias("order_id"),
        F.when(~no_event, F.col("o_custkey")).alias("event_id"),
        F.when(~no_event, currency_of(F.col("o_custkey"))).alias("currency"),
        F.col("l_shipdate").alias("transaction_created"),
        F.when(F.col("l_returnflag") == "R", F.floor(ext * 25)).otherwise(zero)
         .cast("bigint").alias("refund__ap_organizer__gts__epp"),
        zero.alias("refund__ap_organizer__org_to_att_tax__epp"),
        ln.alias("refund__ap_organizer__royalty__epp"),
        zero.alias("refund__ap_organizer__transfer__epp"),
        (-ext_c).alias("sale__ap_organizer__gts__epp"),
        (-tax_c).alias("sale__ap_organizer__org_to_att_tax__epp"),
        (-(ln * 7)).alias("sale__ap_organizer__royalty__epp"),
        F.when(F.col("l_partkey") % 50 != 0, zero).alias("sale__ap_organizer__transfer__epp"),
        ((F.col("l_partkey") % 90) * 25).cast("bigint").alias("sale__gtf_esf__offline"),
        (ln * 11).alias("sale__eb_tax__offline"),
        F.when(F.col("l_returnflag") == "R", 50).otherwise(0).cast("bigint").alias("refund__gtf_esf__offline"),
        F.when(F.col("l_suppkey") % 40 != 0, F.lit(3).cast("bigint")).alias("refund__eb_tax__offline"),
    )


def _payout_columns() -> dict[str, Column]:
    eid = F.col("event_id")
    uid = F.col("user_id")
    pid = F.expr("event_id div 3")
    return {
        "payout_id": pid,
        "event_id": F.when(eid % 50 == 0, uid + RIGHT_ONLY_EVENT_OFFSET).otherwise(uid),
        "user_id": eid % 25,
        "currency": currency_of(uid),
        "country": F.substring(currency_of(uid), 1, 2),
        "payout_type": F.when(pid % 4 == 3, R.CHECK).otherwise(R.ACH),
        "trx_date": F.when(pid % 5 != 0, plus_days(F.col("ts"), F.lit(1))),
        "created": F.col("ts"),
        "changed": F.col("ts"),
        "trx_id": eid * 10 + 1,
        "notes": F.col("event_type"),
        "account_type": F.when(eid % 2 == 0, "checking").otherwise("savings"),
        "reason": pick(REASON_CYCLE, F.expr("(event_id div 7) % 4"), "int"),
        "status": pick(PAYOUT_STATUS_CYCLE, (eid * 7 + uid) % len(PAYOUT_STATUS_CYCLE), "int"),
        "status_old": pick(STATUS_OLD_CYCLE, eid % 3, "int"),
        "amount": F.col("value").cast(MONEY),
        "payment_id": eid,
        "withheld_status": pick(WITHHELD_CYCLE, F.expr("(event_id div 5) % 6"), "int"),
        "log_position": eid,
    }


def history_payouts(t: DriverTables) -> DataFrame:
    return t.events.select(*[c.alias(n) for n, c in _payout_columns().items()])


def payouts(t: DriverTables) -> DataFrame:
    """Current-state payouts: every third change-log row; half of them get an
    id the log does not know."""
    ev = t.events.where(F.col("event_id") % 3 == 0)
    cols = _payout_columns()
    pid = cols["payout_id"]
    current_id = pid + F.when(F.col("event_id") % 2 == 0, CURRENT_ONLY_PAYOUT_OFFSET).otherwise(0)
    rest = ("user_id", "currency", "country", "payout_type", "trx_date", "created", "changed", "trx_id",
            "notes", "account_type", "reason", "status", "amount", "payment_id", "withheld_status")
    return ev.select(current_id.alias("id"), cols["event_id"].alias("event"), *[cols[n].alias(n) for n in rest])


def history_payment_options(t: DriverTables) -> DataFrame:
    et = F.col("event_type")
    eid = F.col("event_id")
    return t.events.select(
        F.col("user_id").alias("event_id"),
        F.col("ts").alias("changed"),
        eid.alias("log_position"),
        F.when(et.isin("purchase", "view"), 1).otherwise(0).alias(R.ACCEPT_PROCESSOR),
        F.when(et == "click", 1).otherwise(0).alias(R.ACCEPT_PROCESSOR_OLD),
        F.when(et != "error", (eid % 2).cast("int")).alias(R.ACCEPT_PAYPAL),
        F.when(eid % 3 == 0, 1).otherwise(0).alias(R.ACCEPT_AUTHNET),
    )


def invoice_charges(t: DriverTables) -> DataFrame:
    key = F.col("o_orderkey")
    block = F.expr("o_orderkey div 20")
    return t.orders.select(
        key.alias("id"),
        F.col("o_custkey").alias("event"),
        currency_of(F.col("o_custkey")).alias("currency"),
        F.col("o_orderdate").alias("created"),
        plus_days(F.col("o_orderdate"), key % 60).alias("changed"),
        pick(CHARGE_LABELS, key % len(CHARGE_LABELS)).alias("charge_type"),
        F.when(block % 3 == 0, 0).otherwise(1).alias("processed"),
        F.round(F.col("o_totalprice").cast(MONEY) * dec_lit("0.01", 3, 2), 2).cast(MONEY).alias("amount"),
        F.when(block % 4 != 0, key).alias("payout_id"),
        F.when(block % 2 == 0, key).otherwise(key - 1).alias("parent_id"),
    )


def transfer_orders(t: DriverTables) -> DataFrame:
    return t.orders.where(F.col("o_orderkey") % 29 == 0).select(F.col("o_orderkey").alias("order_id"))


def event_exclusions(t: DriverTables) -> DataFrame:
    return t.customer.where(F.col("c_custkey") % 83 == 5).select(F.col("c_custkey").alias("event_id"))


def prior_event_level(t: DriverTables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("event_id"))
    return c.unionAll(t.customer.where(F.col("c_custkey") % 101 == 7).select(F.col("c_custkey").alias("event_id")))


def wire_in_events(t: DriverTables) -> DataFrame:
    return t.customer.where(F.col("c_custkey") % 71 == 9).select(F.col("c_custkey").alias("event_id"))


def manual_voids(t: DriverTables) -> DataFrame:
    """Payout ids voided by hand for the fixture period (data, not code)."""
    pid = F.expr("event_id div 3")
    return t.events.where(pid % 37 == 11).select(pid.alias("payout_id")).distinct()


@dataclass
class SettlementInputs:
    events: DataFrame
    users: DataFrame
    orders: DataFrame
    history_orders: DataFrame
    order_itemizations: DataFrame
    history_payouts: DataFrame
    payouts: DataFrame
    history_payment_options: DataFrame
    invoice_charges: DataFrame
    transfer_orders: DataFrame
    event_exclusions: DataFrame
    prior_event_level: DataFrame
    wire_in_events: DataFrame
    manual_voids: DataFrame


def settlement_inputs(t: DriverTables) -> SettlementInputs:
    return SettlementInputs(
        events=events(t), users=users(t), orders=orders(t), history_orders=history_orders(t),
        order_itemizations=order_itemizations(t), history_payouts=history_payouts(t),
        payouts=payouts(t), history_payment_options=history_payment_options(t),
        invoice_charges=invoice_charges(t), transfer_orders=transfer_orders(t),
        event_exclusions=event_exclusions(t), prior_event_level=prior_event_level(t),
        wire_in_events=wire_in_events(t), manual_voids=manual_voids(t),
    )
