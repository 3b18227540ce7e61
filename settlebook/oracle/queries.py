"""Oracle SQL (DuckDB) for every registered query with an SQL formulation.

Each string runs against the driver's views (``orders``, ``lineitem``, ...).
Money columns are cast to DOUBLE at the end, as the Spark queries do.
"""

from __future__ import annotations

from settlebook.oracle.adapters import in_list
from settlebook.oracle.steps import _matrix, _latam, _s2, _s6, charge_conditions, local, step_ctes, ts, with_ctes
from settlebook.plans import rules as R
from settlebook.plans.period import FIXTURE as P

NET = ("epp_net_sales", "offline_net_sales")


def doubles(body: str, cols) -> str:
    cols = list(cols)
    if not cols:
        return with_ctes(body, P)
    rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return with_ctes(f"SELECT * REPLACE ({rep}) FROM ({body}) AS result", P)


def _paid_history(local_time: bool) -> str:
    ch = local("h.changed", P.tz) if local_time else "h.changed"
    return f"""SELECT * FROM (
  SELECT h.*, row_number() OVER (PARTITION BY h.order_id ORDER BY h.changed DESC NULLS LAST,
                                 h.log_position DESC NULLS LAST) AS rk
  FROM x_history_orders h
  WHERE {ch} >= {ts(P.history_from)} AND {ch} < {ts(P.history_split)}
    AND h.payment_type IN {in_list(R.NET_SALES_PAYMENT_TYPES)} AND h.status IN {in_list(R.ORDER_STATUSES_KEPT)})
WHERE rk = 1 AND status = {R.ORDER_STATUS_PAID}"""


_TOTALS = """
p AS (SELECT event_id, currency, sum(amount) AS payout_amount FROM x_history_payouts GROUP BY event_id, currency),
c AS (SELECT event AS event_id, currency, sum(amount) AS charge_amount FROM x_charges GROUP BY event, currency)"""


def _with_totals(select: str) -> str:
    return f"WITH {_TOTALS} {select}"


def oracle_sql() -> dict[str, str]:
    lt = lambda c: local(c, P.tz)
    steps = step_ctes(P)
    payout_money = R.PAYOUT_BUCKETS
    charge_money = R.CHARGE_BUCKETS
    q = {
        "scan_project_rename": doubles(
            "SELECT id AS payout_id, event AS event_id, user_id, currency, payout_type, created, status, "
            "CAST(NULL AS INTEGER) AS status_old, amount, 'payout' AS source FROM x_payouts", ["amount"]),
        "filter_half_open_range": doubles(
            "SELECT order_id, event_id, currency, transaction_created FROM x_items "
            "WHERE transaction_created >= TIMESTAMP '1999-01-01' AND transaction_created < TIMESTAMP '2000-01-01'", []),
        "filter_between_inclusive": doubles(
            "SELECT id, changed FROM x_orders WHERE changed BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'", []),
        "filter_in_not_in_list": doubles(
            "SELECT id, payment_type, status FROM x_orders "
            f"WHERE payment_type IN {in_list((R.EPP_PAYMENT_TYPE, R.OFFLINE_PAYMENT_TYPE, 'paypal'))} "
            "AND status NOT IN (200, 400)", []),
        "filter_code_null_logic": doubles(
            "SELECT id, charge_type, processed, payout_id, parent_id, amount FROM x_charges "
            "WHERE (processed = 1 AND payout_id IS NOT NULL AND amount > 100) OR (processed = 1 AND parent_id = id)",
            ["amount"]),
        "local_wall_clock": f"SELECT event_id, ts, {lt('ts')} AS local_ts FROM events",
        "local_cutoff": (f"SELECT event_id, ts FROM events WHERE {lt('ts')} >= TIMESTAMP '2024-01-10' "
                         f"AND {lt('ts')} < TIMESTAMP '2024-01-20'"),
        "effective_date": doubles(
            f"SELECT log_position, payout_id, coalesce({lt('trx_date')}, {lt('created')}) AS effective_at "
            f"FROM x_history_payouts WHERE coalesce({lt('trx_date')}, {lt('created')}) < TIMESTAMP '2024-01-15'", []),
        "currency_cutoff_matrix": doubles(
            f"SELECT log_position, payout_id, currency, payout_type, status, "
            f"CASE WHEN {_matrix(P)} THEN 1 ELSE 0 END AS in_matrix, "
            f"CASE WHEN {_latam(P)} THEN 1 ELSE 0 END AS in_latam "
            f"FROM x_history_payouts WHERE ({_matrix(P)}) OR ({_latam(P)})", []),
        "join_inner": doubles(
            "SELECT h.order_id, h.log_position, h.event_id, e.current_status, e.uid "
            "FROM x_history_orders h JOIN x_events e ON e.id = h.event_id", []),
        "join_left_computed_key": doubles(
            "SELECT i.order_id, coalesce(i.event_id, k.event_id) AS event_key, "
            "coalesce(i.currency, k.currency) AS currency_key, e.current_status, e.end_date, i.transaction_created "
            "FROM x_items i LEFT JOIN (SELECT DISTINCT id AS order_id, event AS event_id, currency FROM x_orders) k "
            "ON i.order_id = k.order_id LEFT JOIN x_events e ON coalesce(i.event_id, k.event_id) = e.id", []),
        "join_left_two_keys": doubles(_with_totals(
            "SELECT p.event_id, p.currency, p.payout_amount, c.charge_amount FROM p "
            "LEFT JOIN c ON c.event_id = p.event_id AND c.currency = p.currency"),
            ["payout_amount", "charge_amount"]),
        "join_full_outer_merge": doubles(_with_totals(
            "SELECT coalesce(p.event_id, c.event_id) AS event_id, coalesce(p.currency, c.currency) AS currency, "
            "p.payout_amount, c.charge_amount, coalesce(p.payout_amount, 0) - coalesce(c.charge_amount, 0) AS net "
            "FROM p FULL OUTER JOIN c ON c.event_id = p.event_id AND c.currency = p.currency"),
            ["payout_amount", "charge_amount", "net"]),
        "not_in_set": doubles("SELECT id, event FROM x_orders WHERE event NOT IN (SELECT * FROM x_exclusions)", []),
        "not_in_set_with_null": doubles(
            "SELECT id, event FROM x_orders WHERE event NOT IN (SELECT event_parent FROM x_events)", []),
        "not_in_empty_set": doubles(
            "SELECT id, event FROM x_orders WHERE event NOT IN (SELECT id FROM x_events WHERE id < 0)", []),
        "not_in_dup_keys": doubles(
            "SELECT id, current_status FROM x_events "
            "WHERE id NOT IN (SELECT event_id FROM x_prior GROUP BY event_id HAVING count(*) > 1)", []),
        "not_in_windowed": doubles(
            f"SELECT id, event, currency FROM x_orders WHERE status = 100 AND changed < {ts(P.history_split)} "
            f"AND payment_type IN {in_list(R.NET_SALES_PAYMENT_TYPES)} "
            f"AND id NOT IN (SELECT order_id FROM ({_paid_history(False)}))", []),
        "not_in_self": doubles(
            "SELECT log_position, payout_id, status FROM x_history_payouts "
            "WHERE payout_id NOT IN (SELECT payout_id FROM x_history_payouts WHERE status = 8)", []),
        "in_under_or": doubles(
            "SELECT order_id, log_position, changed FROM x_history_orders "
            "WHERE changed < TIMESTAMP '1997-01-01' OR order_id IN (SELECT order_id FROM x_transfers)", []),
        "latest_row": doubles(
            "SELECT order_id, log_position, changed, status, event_id FROM ("
            "SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY changed DESC NULLS LAST, "
            "log_position DESC NULLS LAST) AS rk FROM x_history_orders) WHERE rk = 1", []),
        "latest_as_of_status": doubles(
            f"SELECT order_id, log_position, event_id, gross FROM ({_paid_history(False)})", ["gross"]),
        "cents_sum": doubles(
            "SELECT event_id, currency, "
            f"CAST(-sum({' + '.join(R.EPP_COMPONENTS)}) AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) AS epp_net_sales, "
            f"CAST(-sum({' '.join('- ' + c for c in R.OFFLINE_DEDUCTIONS)}) AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) "
            "AS offline_net_sales FROM x_items GROUP BY event_id, currency", NET),
        "conditional_sum": doubles(
            "SELECT event_id, currency, "
            f"-sum(CASE WHEN payment_type = '{R.EPP_PAYMENT_TYPE}' THEN gross - mg_fee ELSE 0 END) AS epp_net_sales, "
            "sum(CASE WHEN payment_type = 'offline' THEN mg_fee ELSE 0 END) AS offline_net_sales, "
            f"sum(CASE WHEN payment_type = '{R.EPP_PAYMENT_TYPE}' THEN gross - mg_fee ELSE -mg_fee END) AS net_sales "
            "FROM x_history_orders GROUP BY event_id, currency", NET + ("net_sales",)),
        "reaggregate_rounded": doubles(
            "SELECT event_id, currency, round(sum(s), 2) AS net_sales, sum(s) AS net_sales_raw FROM ("
            "SELECT event_id, currency, order_id, sum(gross - mg_fee) AS s FROM x_history_orders "
            "GROUP BY event_id, currency, order_id) GROUP BY event_id, currency", ["net_sales", "net_sales_raw"]),
        "distinct_rows": doubles(
            "SELECT DISTINCT id AS order_id, event AS event_id, currency FROM x_orders GROUP BY 1, 2, 3", []),
        "union_distinct_two": doubles(
            "SELECT event AS event_id, currency FROM x_orders UNION SELECT event_id, currency FROM x_history_orders", []),
        "union_distinct_three": doubles(
            "SELECT payout_id, currency, 'history' AS source FROM x_history_payouts WHERE payout_type = 'ACH' "
            "UNION SELECT payout_id, currency, 'history' AS source FROM x_history_payouts WHERE status = 8 "
            "UNION SELECT id AS payout_id, currency, 'payout' AS source FROM x_payouts", []),
        "count_distinct_list": doubles(
            "SELECT event, count(DISTINCT payment_type) AS num_payment_types, "
            "array_to_string(list_sort(array_agg(DISTINCT payment_type)), ',') AS payment_types FROM x_orders "
            f"WHERE payment_type NOT IN {in_list(R.EDGE_EXCLUDED_PAYMENT_TYPES)} AND status = 100 AND mg_fee > 0 "
            "GROUP BY event", []),
        "itemized_net_sales": doubles("SELECT * FROM x_s1", NET),
        "history_net_sales": doubles("SELECT * FROM x_s2", NET),
        "combined_net_sales": doubles("SELECT * FROM x_n1", ["net_sales"]),
        "merge_net_sales": doubles("SELECT * FROM x_s3", NET),
        "with_parent": doubles("SELECT * FROM x_s4", NET),
        "apply_payment_options": doubles("SELECT * FROM x_s5", NET),
        "payout_snapshot": doubles("SELECT * FROM x_s6", ["amount"]),
        "payout_buckets": doubles("SELECT * FROM x_s7", NET + payout_money),
        "charge_snapshot": doubles("SELECT * FROM x_s8", ["amount"]),
        "charge_buckets": doubles("SELECT * FROM x_s9", NET + payout_money + charge_money),
        "charge_buckets_by_rules": doubles("SELECT * FROM x_s9", NET + payout_money + charge_money),
        "charge_rule_sums": doubles(" UNION ALL ".join(
            f"SELECT i.event AS event_id, i.currency, '{name}' AS bucket, sum(i.amount) AS amount FROM x_s8 i WHERE {cond} GROUP BY i.event, i.currency"
            for name, cond in charge_conditions(P)), ["amount"]),
        "payout_snapshot_filtered": doubles(_s6(P, "filtered"), ["amount"]),
        "history_net_sales_all": doubles(_s2(P, dedupe=False), NET),
        "charge_log_snapshot": doubles(
            "SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY changed DESC, log_position DESC) AS rk FROM ("
            "SELECT * REPLACE (created AS changed, 0 AS processed), CAST(1 AS BIGINT) AS log_position FROM x_charges UNION ALL BY NAME "
            f"SELECT *, CAST(2 AS BIGINT) AS log_position FROM x_charges) WHERE {lt('changed')} < {ts(P.charges_created_before)} "
            f"AND currency IN {in_list(R.CHARGE_CURRENCIES)}) WHERE rk = 1", ["amount"]),
        "not_in_bitmap": doubles("SELECT id, event, status FROM x_payouts WHERE id NOT IN (SELECT payout_id FROM x_history_payouts)", []),
        "latest_carried_on": doubles(
            "SELECT payout_id, changed, log_position, status, amount, currency FROM (SELECT *, row_number() OVER (PARTITION BY payout_id "
            f"ORDER BY changed DESC, log_position DESC) AS rk FROM x_history_payouts WHERE changed < {ts(P.wire_before)}) WHERE rk = 1", ["amount"]),
        "balance": doubles("SELECT * FROM x_s10", ("balance",) + NET + payout_money + charge_money),
        "multi_processor_events": doubles("SELECT * FROM x_p1", []),
        "payout_level_duplicates": doubles(
            "SELECT event_id, currency, count(*) AS rows FROM x_s7 GROUP BY event_id, currency HAVING count(*) > 1", []),
    }
    q["latest_payment_options"] = doubles(
        f"SELECT event_id, changed, log_position, {R.ACCEPT_PROCESSOR}, {R.ACCEPT_PROCESSOR_OLD}, {R.ACCEPT_PAYPAL}, "
        f"{R.ACCEPT_AUTHNET} FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY changed DESC NULLS LAST, "
        f"log_position DESC NULLS LAST) AS rk FROM x_options WHERE changed < {ts(P.options_before)}) WHERE rk = 1", [])
    q["prior_period_duplicates"] = doubles(
        "SELECT event_id FROM x_prior GROUP BY event_id HAVING count(*) > 1", [])
    chg = lt("changed")
    t0, t1 = ts(P.charges_settled_from), ts(P.charges_settled_before)
    q["settled_charges"] = doubles(
        f"SELECT id, event, currency, CASE WHEN (processed = 1 AND {chg} >= {t0} AND {chg} < {t1} "
        f"AND payout_id IS NOT NULL) OR (processed = 1 AND {chg} < {t0} AND parent_id = id) THEN 1 ELSE 0 END "
        "AS settled FROM x_charges", [])
    q["net_sales_with_processors"] = doubles(
        "SELECT n.*, p.payment_types FROM x_n1 n LEFT JOIN x_p1 p ON p.event = n.event_id", ["net_sales"])
    del steps
    return q
