"""Hand-sized fixtures for the settlement steps (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from settlebook.plans import (
    Period, apply_payment_options, balance, charge_buckets, combined_net_sales, history_net_sales,
    itemized_net_sales, payout_buckets, payout_snapshot,
)
from settlebook.plans import rules as R

DEC = Period.dec_2018()
EPP = R.EPP_PAYMENT_TYPE
OPTIONS = (f"event_id bigint, changed timestamp_ntz, log_position bigint, {R.ACCEPT_PROCESSOR} int, "
           f"{R.ACCEPT_PROCESSOR_OLD} int, {R.ACCEPT_PAYPAL} int, {R.ACCEPT_AUTHNET} int")
T = dt.datetime

EVENTS = "id bigint, uid bigint, event_parent bigint, current_status string, start_date timestamp_ntz, end_date timestamp_ntz"
USERS = "id bigint, account_type string"
ORDERS = ("id bigint, event bigint, currency string, gross decimal(18,2), mg_fee decimal(18,2), payment_type string, "
          "status int, changed timestamp_ntz")
HIST = ("order_id bigint, event_id bigint, gross decimal(18,2), mg_fee decimal(18,2), payment_type string, "
        "currency string, status int, changed timestamp_ntz, log_position bigint")
SNAP = ("payout_id bigint, event_id bigint, user_id bigint, currency string, country string, payout_type string, "
        "trx_date timestamp_ntz, created timestamp_ntz, changed timestamp_ntz, trx_id bigint, notes string, "
        "account_type string, reason int, status int, status_old int, amount decimal(18,2), payment_id bigint, "
        "withheld_status int, log_position bigint")
NET = ("event_id bigint, current_status string, account_type string, end_date timestamp_ntz, org_uid bigint, "
       "currency string, epp_net_sales decimal(28,2), offline_net_sales decimal(28,2)")
CHARGES = ("id bigint, event bigint, currency string, created timestamp_ntz, changed timestamp_ntz, charge_type string, "
           "processed int, amount decimal(18,2), payout_id bigint, parent_id bigint")


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def events(spark, ids):
    return spark.createDataFrame([(i, 1, None, "live", T(2018, 1, 1), T(2018, 2, 1)) for i in ids], EVENTS)


def users(spark):
    return spark.createDataFrame([(1, "self")], USERS)


def test_null_component_drops_the_row_from_the_sum(spark):
    comps = list(R.EPP_COMPONENTS) + list(R.OFFLINE_DEDUCTIONS)
    schema = "order_id bigint, event_id bigint, currency string, transaction_created timestamp_ntz, " + ", ".join(
        f"{c} bigint" for c in comps)
    row = lambda oid, first, second: (oid, 7, "USD", T(2018, 6, 1), first, second, *([0] * (len(comps) - 2)))
    items = spark.createDataFrame([row(1, 100, 50), row(2, 100, None)], schema)
    keyset = lambda n: spark.createDataFrame([(999,)], f"{n} bigint")
    out = itemized_net_sales(items, empty(spark, ORDERS), events(spark, [7]), users(spark), keyset("event_id"),
                             empty(spark, "event_id bigint"), keyset("order_id"), DEC).collect()
    assert len(out) == 1 and out[0].epp_net_sales == D("-1.50")


def test_union_counts_equal_branches_once(spark):
    hist = spark.createDataFrame([(1, 7, D("10"), D("1"), EPP, "USD", 100, T(2017, 3, 1), 1)], HIST)
    orders = spark.createDataFrame([(2, 7, "USD", D("10"), D("1"), EPP, 100, T(2017, 4, 1))], ORDERS)
    out = combined_net_sales(hist, orders, events(spark, [7]), DEC).collect()
    assert [(r.event_id, r.net_sales) for r in out] == [(7, D("9.00"))]


def test_zero_branches_are_dropped_before_the_outer_sum(spark):
    hist = spark.createDataFrame([(1, 7, D("10"), D("5"), EPP, "USD", 100, T(2017, 3, 1), 1),
                                  (3, 8, D("10"), D("10"), EPP, "USD", 100, T(2017, 3, 1), 1)], HIST)
    orders = spark.createDataFrame([(2, 7, "USD", D("10"), D("5"), "offline", 100, T(2017, 4, 1))], ORDERS)
    out = {r.event_id: r.net_sales for r in combined_net_sales(hist, orders, events(spark, [7, 8]), DEC).collect()}
    assert out == {7: D("0.00")}


def test_history_split_local_time_and_transfers(spark):
    # 2018-01-01 07:59:59 UTC is still 2017 in Los Angeles; 08:00:00 is not,
    # unless the order is a transfer.
    hist = spark.createDataFrame([(1, 7, D("10"), D("1"), EPP, "USD", 100, T(2018, 1, 1, 7, 59, 59), 1),
                                  (2, 7, D("20"), D("2"), EPP, "USD", 100, T(2018, 1, 1, 8), 1),
                                  (3, 7, D("40"), D("4"), EPP, "USD", 100, T(2018, 6, 1), 1)], HIST)
    transfers = spark.createDataFrame([(3,)], "order_id bigint")
    out = history_net_sales(hist, empty(spark, ORDERS), events(spark, [7]), users(spark), transfers, DEC).collect()
    assert [(r.event_id, r.epp_net_sales) for r in out] == [(7, D("-45.00"))]


def test_null_payment_option_flags_suppress_offline(spark):
    net = spark.createDataFrame([(7, "live", "self", T(2018, 2, 1), 1, "USD", D("5"), D("3"), 7)], NET + ", parent bigint")
    opts = spark.createDataFrame([(7, T(2018, 5, 1), 1, 1, 0, None, 0)],
                                 OPTIONS)
    out = apply_payment_options(net, opts, DEC).collect()[0]
    assert out.offline_net_sales == 0
    opts2 = opts.withColumn(R.ACCEPT_PAYPAL, F.lit(0))
    assert apply_payment_options(net, opts2, DEC).collect()[0].offline_net_sales == D("3")


def _snap(pid, status, created, changed, trx=None, currency="USD", ptype="ACH", status_old=2, event=7, user=1,
          amount="10", log=1):
    return (pid, event, user, currency, "US", ptype, trx, created, changed, 1, "", "checking", None, status,
            status_old, D(amount), 1, None, log)


def test_between_upper_edge_with_earlier_trx_date(spark):
    edge = T(2019, 1, 3, 8)  # local 2019-01-03 00:00:00
    hist = spark.createDataFrame([
        _snap(1, 3, edge, T(2019, 1, 2, 12), trx=T(2019, 1, 2, 12)),
        _snap(2, 3, edge + dt.timedelta(seconds=1), T(2019, 1, 2, 12), trx=T(2019, 1, 2, 12)),
    ], SNAP)
    current = empty(spark, SNAP).drop("status_old", "log_position").withColumnRenamed("payout_id", "id") \
        .withColumnRenamed("event_id", "event")
    out = payout_snapshot(hist, current, empty(spark, "payout_id bigint"), DEC)
    assert [r.payout_id for r in out.collect()] == [1]


def test_payout_whose_log_rows_all_fail_vanishes(spark):
    hist = spark.createDataFrame([_snap(5, 0, T(2018, 6, 1), T(2018, 6, 1))], SNAP)  # ACH status 0 filtered out
    current = spark.createDataFrame([_snap(5, 1, T(2018, 6, 1), T(2018, 6, 1))], SNAP) \
        .drop("status_old", "log_position").withColumnRenamed("payout_id", "id").withColumnRenamed("event_id", "event")
    assert payout_snapshot(hist, current, empty(spark, "payout_id bigint"), DEC).count() == 0


def test_charges_repeat_on_every_payout_row_of_a_key_and_missing_charges_give_zero(spark):
    net = empty(spark, NET)
    snap = spark.createDataFrame([_snap(1, 1, T(2018, 6, 1), T(2018, 6, 1), event=7, user=1),
                                  _snap(2, 1, T(2018, 6, 1), T(2018, 6, 1), event=7, user=2),
                                  _snap(3, 1, T(2018, 6, 1), T(2018, 6, 1), event=9, user=3)],
                                 SNAP).drop("log_position").withColumn("source", F.lit("history_payout"))
    level = payout_buckets(net, snap)
    assert level.count() == 3
    charges = spark.createDataFrame([(1, 7, "USD", T(2018, 6, 1), T(2018, 6, 1), "CHARGE_RFID_CHIPS", 1, D("4"), 1, 1)],
                                    CHARGES)
    out = {(r.event_id, r.org_uid): r for r in
           balance(charge_buckets(level, charges, empty(spark, "event_id bigint"), DEC)).collect()}
    assert out[(7, 1)].rfid == D("4") and out[(7, 2)].rfid == D("4")
    assert out[(9, 3)].rfid is None and out[(9, 3)].credits_charges_total == 0
    assert out[(7, 1)].ach_confirmed_in_file == D("10")
    assert out[(7, 1)].balance == D("14.00")


def test_wire_in_events_are_removed(spark):
    snap = spark.createDataFrame([_snap(1, 8, T(2018, 6, 1), T(2018, 6, 1), event=7)],
                                 SNAP).drop("log_position").withColumn("source", F.lit("history_payout"))
    level = payout_buckets(empty(spark, NET), snap)
    assert level.collect()[0].wire_paid_out == D("10")
    wire_ins = spark.createDataFrame([(7,)], "event_id bigint")
    assert charge_buckets(level, empty(spark, CHARGES), wire_ins, DEC).count() == 0


def _level(spark, rows):
    snap = spark.createDataFrame(rows, SNAP).drop("log_position").withColumn("source", F.lit("history_payout"))
    return payout_buckets(empty(spark, NET), snap)


def test_check_deleted_is_positive_and_voided_negative(spark):
    r = _level(spark, [_snap(1, 3, T(2018, 6, 1), T(2018, 6, 1), ptype="CHECK", user=1),
                       _snap(2, 4, T(2018, 6, 1), T(2018, 6, 1), ptype="CHECK", user=1)]).collect()[0]
    assert (r.check_deleted, r.check_voided, r.check_written) == (D("10"), D("-10"), D("20"))


def test_underpayment_refund_enters_total_only_when_settled(spark):
    level = _level(spark, [_snap(1, 1, T(2018, 6, 1), T(2018, 6, 1), event=7, user=1)])
    charges = spark.createDataFrame([
        (1, 7, "USD", T(2018, 6, 1), T(2018, 6, 1), "CHARGE_UNDERPAYMENT_REFUND", 0, D("4"), None, 2),   # not settled
        (2, 7, "USD", T(2018, 6, 1), T(2018, 6, 1), "CHARGE_UNDERPAYMENT_REFUND", 1, D("8"), 55, 3),     # settled
        (3, 7, "USD", T(2018, 6, 1), T(2018, 6, 1), "CREDIT_BACKUP_FUNDING", 0, D("16"), None, 4),       # always
    ], CHARGES)
    r = charge_buckets(level, charges, empty(spark, "event_id bigint"), DEC).collect()[0]
    assert r.credit_backup_funding_total == D("28")
    assert r.credits_charges_total == D("24")


def test_current_only_payouts_count_as_withheld_not_in_file(spark):
    hist = empty(spark, SNAP)
    cur = spark.createDataFrame([_snap(9, 5, T(2018, 6, 1), T(2018, 6, 1), status_old=2)], SNAP) \
        .drop("status_old", "log_position").withColumnRenamed("payout_id", "id").withColumnRenamed("event_id", "event")
    cur = cur.withColumn("withheld_status", F.lit(2))
    snap = payout_snapshot(hist, cur, empty(spark, "payout_id bigint"), DEC)
    r = payout_buckets(empty(spark, NET), snap).collect()[0]
    assert (r.ach_withheld_fraud_in_file, r.ach_withheld_fraud_not_in_file) == (0, D("10"))


def test_payment_options_come_from_the_parent_event(spark):
    net = spark.createDataFrame([(7, "live", "self", T(2018, 2, 1), 1, "USD", D("5"), D("3"), 70)], NET + ", parent bigint")
    schema = OPTIONS
    own = spark.createDataFrame([(7, T(2018, 5, 1), 1, 1, 0, 0, 0)], schema)
    parent = spark.createDataFrame([(70, T(2018, 5, 1), 1, 0, 0, 0, 0)], schema)
    assert apply_payment_options(net, own.unionByName(parent), DEC).collect()[0].offline_net_sales == 0


def test_parent_step_drops_rows_of_unknown_events(spark):
    from settlebook.plans import with_parent
    merged = spark.createDataFrame([(7, "self", "live", 1, "USD", T(2018, 2, 1), D("1"), D("0")),
                                    (8, None, None, None, "USD", None, D("2"), D("0"))],
                                   "event_id bigint, account_type string, current_status string, org_uid bigint, "
                                   "currency string, end_date timestamp_ntz, epp_net_sales decimal(28,2), "
                                   "offline_net_sales decimal(28,2)")
    out = with_parent(merged, events(spark, [7])).collect()
    assert [(r.event_id, r.parent) for r in out] == [(7, 7)]


def test_brl_family_not_in_wired_payouts_with_null_semantics(spark):
    cur = empty(spark, SNAP).drop("status_old", "log_position").withColumnRenamed("payout_id", "id") \
        .withColumnRenamed("event_id", "event")
    t = T(2018, 6, 1)
    base = [_snap(1, 3, t, t, currency="BRL", log=1),                       # never wired: kept
            _snap(2, 3, t, t + dt.timedelta(hours=1), currency="BRL", log=2),  # newest version ...
            _snap(2, 8, t, t, currency="BRL", log=1)]                        # ... but wired once: dropped
    voids = empty(spark, "payout_id bigint")
    out = payout_snapshot(spark.createDataFrame(base, SNAP), cur, voids, DEC)
    latam = sorted(r.payout_id for r in out.where(F.col("currency") == "BRL").where(F.col("status") != 8).collect())
    assert latam == [1]
    # a wired log row without a payout id puts NULL in the NOT IN set: no BRL/ARS row survives
    with_null = spark.createDataFrame(base + [_snap(None, 8, t, t, currency="USD", log=9)], SNAP)
    out = payout_snapshot(with_null, cur, voids, DEC)
    assert out.where((F.col("currency") == "BRL") & (F.col("status") == 3)).count() == 0
    # a manual void removes the BRL row too
    out = payout_snapshot(spark.createDataFrame(base, SNAP), cur, spark.createDataFrame([(1,)], "payout_id bigint"), DEC)
    assert out.where((F.col("currency") == "BRL") & (F.col("status") == 3)).count() == 0
