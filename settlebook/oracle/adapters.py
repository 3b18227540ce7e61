"""The adapter recipes of ``settlebook.sources.adapters`` written in SQL
(DuckDB dialect) over the driver's views. CTE names carry an ``x_`` prefix so
they never shadow a driver view."""

from __future__ import annotations

from settlebook.plans import rules as R
from settlebook.sources import adapters as A


def q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def pick(values, index_sql: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"CASE {index_sql} {arms} END"


def cur(key_sql: str) -> str:
    return pick(A.CURRENCY_CYCLE, f"{key_sql} % {len(A.CURRENCY_CYCLE)}")


def _payout_cols() -> dict[str, str]:
    pid = "(event_id // 3)"
    return {
        "payout_id": pid,
        "event_id": f"CASE WHEN event_id % 50 = 0 THEN user_id + {A.RIGHT_ONLY_EVENT_OFFSET} ELSE user_id END",
        "user_id": "event_id % 25",
        "currency": cur("user_id"),
        "country": f"substr({cur('user_id')}, 1, 2)",
        "payout_type": f"CASE WHEN {pid} % 4 = 3 THEN 'CHECK' ELSE 'ACH' END",
        "trx_date": f"CASE WHEN {pid} % 5 <> 0 THEN ts + INTERVAL 1 DAY END",
        "created": "ts",
        "changed": "ts",
        "trx_id": "event_id * 10 + 1",
        "notes": "event_type",
        "account_type": "CASE WHEN event_id % 2 = 0 THEN 'checking' ELSE 'savings' END",
        "reason": f"CAST({pick(A.REASON_CYCLE, '(event_id // 7) % 4')} AS INTEGER)",
        "status": f"CAST({pick(A.PAYOUT_STATUS_CYCLE, f'(event_id * 7 + user_id) % {len(A.PAYOUT_STATUS_CYCLE)}')} AS INTEGER)",
        "status_old": f"CAST({pick(A.STATUS_OLD_CYCLE, 'event_id % 3')} AS INTEGER)",
        "amount": "CAST(value AS DECIMAL(18,2))",
        "payment_id": "event_id",
        "withheld_status": f"CAST({pick(A.WITHHELD_CYCLE, '(event_id // 5) % 6')} AS INTEGER)",
        "log_position": "event_id",
    }


def _payouts_current() -> str:
    c = _payout_cols()
    rest = ("user_id", "currency", "country", "payout_type", "trx_date", "created", "changed", "trx_id",
            "notes", "account_type", "reason", "status", "amount", "payment_id", "withheld_status")
    cols = [f"{c['payout_id']} + CASE WHEN event_id % 2 = 0 THEN {A.CURRENT_ONLY_PAYOUT_OFFSET} ELSE 0 END AS id",
            f"{c['event_id']} AS event"] + [f"{c[n]} AS {n}" for n in rest]
    return "SELECT " + ",\n  ".join(cols) + "\nFROM events WHERE event_id % 3 = 0"


ADAPTERS: dict[str, str] = {
    "x_events": f"""
SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS uid,
  CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 100 END AS event_parent,
  {pick(A.EVENT_STATUSES, 'c_custkey % 4')} AS current_status,
  TIMESTAMP '1994-12-01' + CAST(c_custkey % 2000 AS INTEGER) * INTERVAL 1 DAY AS start_date,
  TIMESTAMP '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) * INTERVAL 1 DAY AS end_date
FROM customer WHERE c_custkey % 97 <> 13""",
    "x_users": f"""
SELECT CAST(n_nationkey AS BIGINT) AS id, {pick(A.ACCOUNT_TYPES, 'n_regionkey % 3')} AS account_type
FROM nation WHERE n_nationkey % 7 <> 3""",
    "x_orders": f"""
SELECT o_orderkey AS id, o_custkey AS event, {cur('o_custkey')} AS currency,
  CAST(o_totalprice AS DECIMAL(18,2)) AS gross,
  CASE WHEN o_orderkey % 10 = 0 THEN CAST(0 AS DECIMAL(18,2))
       ELSE CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) END AS mg_fee,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN {q(R.EPP_PAYMENT_TYPE)} WHEN '2' THEN {q(R.OFFLINE_PAYMENT_TYPE)} WHEN '3' THEN 'paypal'
       WHEN '4' THEN 'google' ELSE 'free' END AS payment_type,
  CAST(CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 100 ELSE 200 END
       WHEN 'P' THEN 400 END AS INTEGER) AS status,
  o_orderdate AS changed
FROM orders""",
    "x_history_orders": f"""
SELECT l.l_orderkey AS order_id, o.o_custkey AS event_id,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gross,
  CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS mg_fee,
  {pick(A.HISTORY_PAYMENT_TYPES, '(l.l_orderkey + l.l_linenumber) % 4')} AS payment_type,
  {cur('o.o_custkey')} AS currency,
  CAST(CASE WHEN l.l_partkey % 13 = 0 THEN 500 WHEN l.l_returnflag = 'N' THEN 200
            WHEN l.l_returnflag = 'A' AND l.l_linenumber % 2 = 0 THEN 350 ELSE 100 END AS INTEGER) AS status,
  l.l_shipdate AS changed,
  CAST(l.l_linenumber AS BIGINT) * 10000000 + l.l_partkey AS log_position
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "x_items": f"""
SELECT l.l_orderkey AS order_id,
  CASE WHEN NOT (l.l_linenumber % 3 = 0) THEN o.o_custkey END AS event_id,
  CASE WHEN NOT (l.l_linenumber % 3 = 0) THEN {cur('o.o_custkey')} END AS currency,
  l.l_shipdate AS transaction_created,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN floor(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 25) ELSE 0 END AS BIGINT)
    AS refund__ap_organizer__gts__epp,
  CAST(0 AS BIGINT) AS refund__ap_organizer__org_to_att_tax__epp,
  CAST(l.l_linenumber AS BIGINT) AS refund__ap_organizer__royalty__epp,
  CAST(0 AS BIGINT) AS refund__ap_organizer__transfer__epp,
  -CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS sale__ap_organizer__gts__epp,
  -CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(18,2)), 2) * 100 AS BIGINT)
    AS sale__ap_organizer__org_to_att_tax__epp,
  -(CAST(l.l_linenumber AS BIGINT) * 7) AS sale__ap_organizer__royalty__epp,
  CASE WHEN l.l_partkey % 50 <> 0 THEN CAST(0 AS BIGINT) END AS sale__ap_organizer__transfer__epp,
  CAST((l.l_partkey % 90) * 25 AS BIGINT) AS sale__gtf_esf__offline,
  CAST(l.l_linenumber AS BIGINT) * 11 AS sale__eb_tax__offline,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN 50 ELSE 0 END AS BIGINT) AS refund__gtf_esf__offline,
  CASE WHEN l.l_suppkey % 40 <> 0 THEN CAST(3 AS BIGINT) END AS refund__eb_tax__offline
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "x_history_payouts": "SELECT " + ",\n  ".join(f"{v} AS {k}" for k, v in _payout_cols().items()) + "\nFROM events",
    "x_payouts": _payouts_current(),
    "x_options": f"""
SELECT user_id AS event_id, ts AS changed, event_id AS log_position,
  CASE WHEN event_type IN ('purchase', 'view') THEN 1 ELSE 0 END AS {R.ACCEPT_PROCESSOR},
  CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS {R.ACCEPT_PROCESSOR_OLD},
  CASE WHEN event_type <> 'error' THEN CAST(event_id % 2 AS INTEGER) END AS {R.ACCEPT_PAYPAL},
  CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS {R.ACCEPT_AUTHNET}
FROM events""",
    "x_charges": f"""
SELECT o_orderkey AS id, o_custkey AS event, {cur('o_custkey')} AS currency, o_orderdate AS created,
  o_orderdate + CAST(o_orderkey % 60 AS INTEGER) * INTERVAL 1 DAY AS changed,
  {pick(A.CHARGE_LABELS, f'o_orderkey % {len(A.CHARGE_LABELS)}')} AS charge_type,
  CASE WHEN (o_orderkey // 20) % 3 = 0 THEN 0 ELSE 1 END AS processed,
  CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS amount,
  CASE WHEN (o_orderkey // 20) % 4 <> 0 THEN o_orderkey END AS payout_id,
  CASE WHEN (o_orderkey // 20) % 2 = 0 THEN o_orderkey ELSE o_orderkey - 1 END AS parent_id
FROM orders""",
    "x_transfers": "SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey % 29 = 0",
    "x_exclusions": "SELECT c_custkey AS event_id FROM customer WHERE c_custkey % 83 = 5",
    "x_prior": ("SELECT c_custkey AS event_id FROM customer UNION ALL "
                "SELECT c_custkey AS event_id FROM customer WHERE c_custkey % 101 = 7"),
    "x_wire_ins": "SELECT c_custkey AS event_id FROM customer WHERE c_custkey % 71 = 9",
    "x_voids": "SELECT DISTINCT event_id // 3 AS payout_id FROM events WHERE (event_id // 3) % 37 = 11",
}

assert len(A.CHARGE_LABELS) == 20 and len(R.CHARGE_CATEGORIES) == 14
