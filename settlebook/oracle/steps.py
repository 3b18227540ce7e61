"""Settlement steps as direct SQL (DuckDB dialect), the oracle for the Spark plans.

Written the straightforward way on purpose: join first and group by every
attribute, NOT IN subqueries, ROW_NUMBER rank filters, local wall clock
computed on every row and compared with the cutoff. The Spark plans take
shortcuts (pre-aggregation, predicate rewrites, set statistics); matching this
SQL on the driver data is what shows the shortcuts are exact.
"""

from __future__ import annotations

from settlebook.oracle.adapters import ADAPTERS, in_list
from settlebook.plans import rules as R
from settlebook.plans.period import Period


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def local(col: str, tz: str) -> str:
    return f"date_trunc('second', timezone('{tz}', timezone('UTC', {col})))"


def _history_where(a: str, p: Period, local_time: bool) -> str:
    ch = local(f"{a}.changed", p.tz) if local_time else f"{a}.changed"
    transfer = f" OR {a}.order_id IN (SELECT order_id FROM x_transfers)" if local_time else ""
    return (f"{ch} >= {ts(p.history_from)} AND ({ch} < {ts(p.history_split)}{transfer})"
            f" AND {a}.payment_type IN {in_list(R.NET_SALES_PAYMENT_TYPES)}"
            f" AND {a}.status IN {in_list(R.ORDER_STATUSES_KEPT)}")


def _rank(part: str, a: str = "") -> str:
    pre = f"{a}." if a else ""
    return (f"row_number() OVER (PARTITION BY {pre}{part} "
            f"ORDER BY {pre}changed DESC NULLS LAST, {pre}log_position DESC NULLS LAST)")


_WHEN = "(changed, coalesce(log_position, -9223372036854775808))"  # what "newest" compares


def _order_sales(p: Period, local_time: bool) -> str:
    """CTEs up to ``sales``: per branch, what the log says of each order (its newest
    version of a known event, if paid), and the paid orders that it has not taken
    (an order is taken if its newest version of all is paid)."""
    ch = local("o.changed", p.tz) if local_time else "o.changed"
    return f"""
WITH versions AS (SELECT h.* FROM x_history_orders h WHERE {_history_where('h', p, local_time)}),
of_events AS (SELECT arg_max(v, {_WHEN}) AS v FROM versions v SEMI JOIN x_events e ON e.id = v.event_id GROUP BY v.order_id),
taken AS (SELECT order_id FROM versions GROUP BY order_id HAVING arg_max(status, {_WHEN}) = {R.ORDER_STATUS_PAID}),
sales AS (
  SELECT 1 AS branch, v.event_id, v.currency, v.payment_type, v.gross, v.mg_fee FROM of_events WHERE v.status = {R.ORDER_STATUS_PAID}
  UNION ALL
  SELECT 2, o.event, o.currency, o.payment_type, o.gross, o.mg_fee FROM x_orders o ANTI JOIN taken t ON t.order_id = o.id
  WHERE o.status = {R.ORDER_STATUS_PAID} AND {ch} < {ts(p.history_split)} AND o.payment_type IN {in_list(R.NET_SALES_PAYMENT_TYPES)}
    AND (o.id IS NOT NULL OR NOT EXISTS (FROM taken)) AND NOT EXISTS (FROM taken WHERE order_id IS NULL))"""


def _s1(p: Period) -> str:
    epp = " + ".join(f"i.{c}" for c in R.EPP_COMPONENTS)
    off = " ".join(f"- i.{c}" for c in R.OFFLINE_DEDUCTIONS)
    key = "coalesce(i.event_id, k.event_id)"
    return f"""
SELECT {key} AS event_id, e.current_status, e.uid AS org_uid, u.account_type,
  coalesce(i.currency, k.currency) AS currency, e.end_date,
  CAST(-sum({epp}) AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) AS epp_net_sales,
  CAST(-sum({off}) AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) AS offline_net_sales
FROM x_items i
LEFT JOIN (SELECT DISTINCT id AS order_id, event AS event_id, currency FROM x_orders) k ON i.order_id = k.order_id
LEFT JOIN x_events e ON {key} = e.id
LEFT JOIN x_users u ON u.id = e.uid
WHERE i.transaction_created >= {ts(p.itemized_from)} AND i.transaction_created < {ts(p.itemized_to)}
  AND {key} NOT IN (SELECT * FROM x_exclusions)
  AND {key} NOT IN (SELECT event_id FROM x_prior GROUP BY event_id HAVING count(*) > 1)
  AND i.order_id NOT IN (SELECT order_id FROM x_transfers)
GROUP BY {key}, e.current_status, e.uid, u.account_type, coalesce(i.currency, k.currency), e.end_date"""


def _s2(p: Period, dedupe: bool = True) -> str:
    return f"""{_order_sales(p, True)},
sums AS (  -- equal sums of both branches are one row
  SELECT {"DISTINCT" if dedupe else ""} event_id, currency, epp, offline FROM (
    SELECT branch, event_id, currency, -sum(CASE payment_type WHEN '{R.EPP_PAYMENT_TYPE}' THEN gross - mg_fee ELSE 0 END) AS epp,
      sum(CASE payment_type WHEN '{R.OFFLINE_PAYMENT_TYPE}' THEN mg_fee ELSE 0 END) AS offline
    FROM sales GROUP BY ALL))
SELECT s.event_id, e.current_status, e.uid AS org_uid, u.account_type, s.currency, e.end_date,
  round(sum(s.epp), 2) AS epp_net_sales, round(sum(s.offline), 2) AS offline_net_sales
FROM sums s JOIN x_events e ON e.id = s.event_id LEFT JOIN x_users u ON u.id = e.uid
WHERE NOT (s.epp = 0 AND s.offline = 0)
GROUP BY ALL"""


def _n1(p: Period) -> str:
    return f"""{_order_sales(p, False)},
sums AS (
  SELECT DISTINCT event_id, currency, net FROM (
    SELECT branch, event_id, currency, sum(CASE payment_type WHEN '{R.EPP_PAYMENT_TYPE}' THEN gross ELSE 0 END - mg_fee) AS net
    FROM sales GROUP BY ALL))
SELECT s.event_id, e.current_status, e.uid AS org_uid, s.currency, sum(s.net) AS net_sales
FROM sums s JOIN x_events e ON e.id = s.event_id
WHERE s.net <> 0
GROUP BY ALL"""


_S3 = """
SELECT coalesce(t.event_id, a.event_id) AS event_id,
  coalesce(a.account_type, t.account_type) AS account_type,
  coalesce(a.current_status, t.current_status) AS current_status,
  coalesce(a.org_uid, t.org_uid) AS org_uid,
  coalesce(a.currency, t.currency) AS currency,
  coalesce(a.end_date, t.end_date) AS end_date,
  coalesce(a.epp_net_sales, 0) + coalesce(t.epp_net_sales, 0) AS epp_net_sales,
  coalesce(a.offline_net_sales, 0) + coalesce(t.offline_net_sales, 0) AS offline_net_sales
FROM x_s1 t FULL OUTER JOIN x_s2 a ON a.event_id = t.event_id AND a.currency = t.currency"""

_S4 = """
SELECT m.*, CASE WHEN e.event_parent IS NULL THEN e.id ELSE e.event_parent END AS parent
FROM x_s3 m JOIN x_events e ON e.id = m.event_id"""


def _s5(p: Period) -> str:
    return f"""
SELECT n.event_id, n.current_status, n.account_type, n.end_date, n.org_uid, n.currency, n.epp_net_sales,
  CASE WHEN (o.{R.ACCEPT_PROCESSOR} = 1 OR o.{R.ACCEPT_PROCESSOR_OLD} = 1)
        AND (o.{R.ACCEPT_PAYPAL} <> 1 AND o.{R.ACCEPT_AUTHNET} <> 1)
       THEN n.offline_net_sales ELSE 0 END AS offline_net_sales
FROM x_s4 n
LEFT JOIN (
  SELECT * FROM (SELECT x.*, {_rank('event_id', 'x')} AS rk FROM x_options x WHERE x.changed < {ts(p.options_before)})
  WHERE rk = 1
) o ON o.event_id = n.parent"""


_PAYOUT_COLS = [c for c in R.SNAPSHOT_COLUMNS if c != "source"]


def _matrix(p: Period) -> str:
    created = local("created", p.tz)
    eff = f"coalesce({local('trx_date', p.tz)}, {created})"
    arms = [f"({created} BETWEEN {ts(p.ach_regime_from)} AND {ts(w.created_to)} AND {eff} < {ts(w.before)}"
            f" AND changed < {ts(w.before)} AND currency IN {in_list(w.currencies)})" for w in p.ach_windows]
    arms.append(f"({created} < {ts(p.ach_regime_from)} AND changed < {ts(p.ach_old_changed_before)}"
                f" AND currency IN {in_list(R.ACH_OLD_CURRENCIES)})")
    ach = (f"(payout_type = 'ACH' AND status NOT IN {in_list(R.ACH_EXCLUDED_STATUSES)} AND ("
           + " OR ".join(arms) + "))")
    check = (f"(payout_type = 'CHECK' AND status <> 0 AND status_old IS NOT NULL AND status <> 8"
             f" AND {eff} < {ts(p.check_before)} AND changed < {ts(p.check_before)}"
             f" AND currency IN {in_list(R.ALL_PAYOUT_CURRENCIES)})")
    wire = (f"(status = 8 AND {created} < {ts(p.wire_before)} AND changed < {ts(p.wire_before)}"
            f" AND currency IN {in_list(R.ALL_PAYOUT_CURRENCIES)})")
    return f"{ach} OR {check} OR {wire}"


def _latam(p: Period) -> str:
    per = " OR ".join(f"(currency = '{c}' AND changed < {ts(d)})" for c, d in p.latam_changed_before.items())
    return (f"payout_type = 'ACH' AND ({per}) AND status NOT IN {in_list(R.LATAM_EXCLUDED_STATUSES)}")


def _s6(p: Period, exclude_against: str = "log") -> str:
    known = "SELECT payout_id FROM x_history_payouts" + (f" WHERE ({_matrix(p)}) OR ({_latam(p)})" if exclude_against == "filtered" else "")
    newest = ", ".join(f"v.{c}" for c in _PAYOUT_COLS)
    renamed = {"payout_id": "id AS payout_id", "event_id": "event AS event_id", "status_old": "CAST(NULL AS INTEGER) AS status_old"}
    current = ", ".join(renamed.get(c, c) for c in _PAYOUT_COLS)
    wired = f"SELECT payout_id FROM x_history_payouts WHERE status = {R.WIRE_STATUS}"

    def outside(key: str, members: str) -> str:
        return (f"NOT EXISTS (FROM ({members}) s(k) WHERE s.k = {key} OR s.k IS NULL)"
                f" AND ({key} IS NOT NULL OR NOT EXISTS (FROM ({members})))")

    return f"""
WITH by_matrix AS (SELECT arg_max(h, {_WHEN}) AS v FROM x_history_payouts h WHERE {_matrix(p)} GROUP BY payout_id),
by_currency AS (SELECT arg_max(h, {_WHEN}) AS v FROM x_history_payouts h WHERE {_latam(p)} GROUP BY payout_id),
unseen AS (SELECT {current} FROM x_payouts o WHERE created < {ts(p.payouts_created_before)}
           AND {outside('o.id', known)})
SELECT DISTINCT *, 'history_payout' AS source FROM (
  SELECT {newest} FROM by_matrix
  UNION ALL
  SELECT {newest} FROM by_currency
  WHERE {outside('v.payout_id', wired)} AND {outside('v.payout_id', 'SELECT payout_id FROM x_voids')})
UNION ALL
SELECT DISTINCT *, 'payout' AS source FROM unseen"""


def _payout_bucket_sql() -> list[tuple[str, int, str]]:
    cur = "coalesce(e.currency, p.currency)"
    ach, chk = "p.payout_type = 'ACH'", "p.payout_type = 'CHECK'"
    latam, not_latam = f"{cur} IN ('BRL', 'ARS')", f"{cur} NOT IN ('BRL', 'ARS')"
    in_file = "p.status = 5 AND p.status_old = 2"
    not_in_file = "p.status = 5 AND (p.status_old <> 2 OR p.status_old IS NULL)"
    flagged = "(p.withheld_status IN (1, 2, 4, 5) OR p.reason IN (6, 7))"
    other = "p.withheld_status IS NULL AND p.reason IN (6, 7)"
    out = [
        ("ach_confirmed_in_file", 1,
         f"{ach} AND (({not_latam} AND (p.status IN (0, 1, 2, 3, 4, 6, 7, 10, 11, 12, 13) OR ({in_file} AND {flagged})))"
         f" OR ({latam} AND (p.status IN (1, 3, 4, 6, 7, 11, 13) OR ({in_file} AND {flagged}))))"),
        ("ach_paid_out_in_file", 1,
         f"{ach} AND (({latam} AND p.status = 1) OR ({not_latam} AND p.status IN (0, 1, 2, 10, 11, 12, 13)))"),
    ]
    for label, cond in (("in_file", in_file), ("not_in_file", not_in_file)):
        for kind, code in (("fraud", 2), ("trust_safety", 4), ("canceled_event", 5), ("ach_recoup", 1)):
            out.append((f"ach_withheld_{kind}_{label}", 1, f"{ach} AND {cond} AND p.withheld_status = {code}"))
        out.append((f"ach_withheld_other_fraud_{label}", 1, f"{ach} AND {cond} AND {other}"))
    for kind, code in (("deleted", 3), ("voided", 4), ("returned", 6), ("reissued", 7)):
        out.append((f"ach_{kind}_in_file", -1, f"{ach} AND p.status = {code}"))
    out += [
        ("wire_paid_out", 1, "p.status = 8"),
        ("check_written", 1, f"{chk} AND p.status <> 8"),
        ("check_completed", 1, f"p.status IS NOT NULL AND {chk} AND p.status IN (0, 1, 2, 10, 11, 12, 13)"),
        ("check_withheld", 1, f"{chk} AND p.status = 5 AND (p.withheld_status IN (1, 2, 4, 5) OR ({other}))"),
        ("check_deleted", 1, f"{chk} AND p.status = 3"),
        ("check_voided", -1, f"{chk} AND p.status = 4"),
        ("check_reissued_returned", -1, f"{chk} AND p.status IN (6, 7)"),
    ]
    assert tuple(n for n, _, _ in out) == R.PAYOUT_BUCKETS
    return out


def _s7() -> str:
    sums = ",\n  ".join(f"{'-' if s < 0 else ''}sum(CASE WHEN {pred} THEN p.amount ELSE 0 END) AS {name}"
                        for name, s, pred in _payout_bucket_sql())
    keys = ("coalesce(e.event_id, p.event_id)", "e.current_status", "e.account_type", "e.end_date",
            "coalesce(e.org_uid, p.user_id)", "coalesce(e.currency, p.currency)", "e.epp_net_sales",
            "e.offline_net_sales")
    sel = ", ".join(f"{k} AS {n}" for k, n in zip(keys, R.PAYOUT_LEVEL_KEYS))
    return f"""
SELECT {sel},
  {sums}
FROM x_s5 e FULL OUTER JOIN x_s6 p ON e.event_id = p.event_id AND p.currency = e.currency
GROUP BY {", ".join(keys)}"""


def _s8(p: Period) -> str:
    return (f"SELECT * FROM x_charges WHERE {local('created', p.tz)} < {ts(p.charges_created_before)}"
            f" AND currency IN {in_list(R.CHARGE_CURRENCIES)}")


def charge_conditions(p: Period) -> list[tuple[str, str]]:
    """(bucket, which charges ``i`` count for it), the total last."""
    chg, crt = local("i.changed", p.tz), local("i.created", p.tz)
    t0, t1 = ts(p.charges_settled_from), ts(p.charges_settled_before)
    recent = f"(i.processed = 1 AND {chg} >= {t0} AND {chg} < {t1} AND i.payout_id IS NOT NULL)"
    legacy = f"(i.processed = 1 AND {chg} < {t0} AND i.parent_id = i.id)"
    settled = f"({recent} OR {legacy})"
    fam = [("credit_backup_funding", f"i.charge_type IN {in_list(R.BACKUP_FUNDING_TYPES)} AND {crt} < {t1}"),
           ("credit_balance_transfer", f"i.charge_type = '{R.CREDIT_BALANCE_TRANSFER}' AND {chg} < {t1}"),
           ("charge_balance_transfer", f"i.charge_type = '{R.CHARGE_BALANCE_TRANSFER}' AND {chg} < {t1}")]
    parts = [(f"{n}_total", c) for n, c in fam]
    parts += [(f"{n}_not_applied", f"{c} AND i.processed = 0") for n, c in fam]
    parts += [(f"{n}_applied", f"{c} AND i.processed = 1") for n, c in fam]
    parts += [(n, f"i.charge_type IN {in_list(types)} AND {settled}") for n, types in R.CHARGE_CATEGORIES]
    return parts + [("credits_charges_total", f"{recent} OR (i.charge_type IN {in_list(R.TOTAL_ALWAYS_TYPES)} AND {chg} < {t1}) OR {legacy}")]


def _s9(p: Period) -> str:
    *parts, (total, counted) = charge_conditions(p)
    sums = [f"sum(CASE WHEN {c} THEN i.amount END) AS {n}" for n, c in parts]
    sums.append(f"sum(CASE WHEN {counted} THEN i.amount ELSE 0 END) AS {total}")
    group = ", ".join(f"p.{c}" for c in R.PAYOUT_LEVEL_COLUMNS)
    return f"""
SELECT p.*,
  {",\n  ".join(sums)}
FROM x_s7 p LEFT JOIN x_s8 i ON i.event = p.event_id AND p.currency = i.currency
WHERE p.event_id NOT IN (SELECT event_id FROM x_wire_ins)
GROUP BY {group}"""


def _s10() -> str:
    total = " + ".join(f"coalesce({t}, 0)" for t in R.BALANCE_TERMS)
    return f"SELECT round({total}, 2) AS balance, * FROM x_s9"


_P1 = f"""
SELECT event, payment_types FROM (
  SELECT event, count(DISTINCT payment_type) AS num_payment_types,
    array_to_string(list_sort(array_agg(DISTINCT payment_type)), ',') AS payment_types
  FROM x_orders
  WHERE payment_type NOT IN {in_list(R.EDGE_EXCLUDED_PAYMENT_TYPES)} AND status = 100 AND mg_fee > 0
  GROUP BY event)
WHERE num_payment_types > 1 AND payment_types IN {in_list(R.EDGE_PROCESSOR_COMBOS)}"""


def step_ctes(p: Period) -> dict[str, str]:
    return {
        "x_s1": _s1(p), "x_s2": _s2(p), "x_n1": _n1(p), "x_s3": _S3, "x_s4": _S4, "x_s5": _s5(p),
        "x_s6": _s6(p), "x_s7": _s7(), "x_s8": _s8(p), "x_s9": _s9(p), "x_s10": _s10(), "x_p1": _P1,
    }


def with_ctes(body: str, p: Period) -> str:
    ctes = {**ADAPTERS, **step_ctes(p)}
    used = {}
    # Keep only the CTEs the body needs (transitively), in definition order.
    names = list(ctes)
    need = {n for n in names if _refers(body, n)}
    changed = True
    while changed:
        changed = False
        for n in list(need):
            for m in names:
                if m not in need and _refers(ctes[n], m):
                    need.add(m)
                    changed = True
    for n in names:
        if n in need:
            used[n] = ctes[n]
    if not used:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({sql}\n)" for n, sql in used.items()) + "\n" + body


def _refers(sql: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", sql) is not None
