"""Periods from files, and the fixed values of the December 2018 close."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from settlebook.plans import Period
from settlebook.plans import rules as R
from settlebook.plans.payouts import cutoff_matrix, latam_rule

DEC = {
    "history_from": "2013-05-13 13:30:06", "history_split": "2018-01-01", "itemized_from": "2018-01-01", "itemized_to": "2019-01-01",
    "options_before": "2019-01-01", "ach_regime_from": "2017-01-01",
    "ach_windows": [
        {"currencies": ["AUD", "CAD", "NZD", "USD", "HKD", "SGD"], "created_to": "2019-01-03", "before": "2019-01-03"},
        {"currencies": ["GBP"], "created_to": "2018-12-29", "before": "2018-12-29"},
        {"currencies": ["EUR"], "created_to": "2019-01-01", "before": "2019-01-01"}],
    "ach_old_changed_before": "2019-01-01", "check_before": "2019-01-01", "wire_before": "2019-01-01",
    "latam_changed_before": {"BRL": "2019-01-01", "ARS": "2018-12-29"}, "payouts_created_before": "2019-01-01",
    "charges_created_before": "2019-01-01", "charges_settled_from": "2013-08-14 03:13:18", "charges_settled_before": "2019-05-01",
    "tz": "America/Los_Angeles",
}


def test_december_2018_dates():
    assert Period.dec_2018() == Period.from_dict(DEC)


def test_rule_values():
    assert R.ORDER_STATUSES_KEPT == (100, 200, 220, 400, 350, 300, 250) and R.ORDER_STATUS_PAID == 100
    assert (R.EPP_PAYMENT_TYPE, R.OFFLINE_PAYMENT_TYPE) == R.NET_SALES_PAYMENT_TYPES == ("eventbrite", "offline")
    assert R.EDGE_EXCLUDED_PAYMENT_TYPES == ("free", "manual")
    assert R.EDGE_PROCESSOR_COMBOS == ("eventbrite,google", "eventbrite,paypal", "eventbrite,google,offline", "eventbrite,offline,paypal")
    assert (R.ACH, R.CHECK, R.WIRE_STATUS) == ("ACH", "CHECK", 8)
    assert R.ACH_EXCLUDED_STATUSES == (0, 10, 12, 1, 8) and R.LATAM_EXCLUDED_STATUSES == (0, 10, 12, 2)
    assert R.LATAM_CURRENCIES == ("BRL", "ARS")
    assert R.ACH_OLD_CURRENCIES == ("AUD", "CAD", "EUR", "GBP", "NZD", "USD", "SGD", "HKD", "MXN")
    assert set(R.ALL_PAYOUT_CURRENCIES) == set(R.CHARGE_CURRENCIES) == {
        "AUD", "CAD", "EUR", "GBP", "NZD", "USD", "BRL", "ARS", "MXN", "SGD", "HKD"}
    assert R.ACH_CONFIRMED_STATUSES == (0, 1, 2, 3, 4, 6, 7, 10, 11, 12, 13)
    assert R.ACH_CONFIRMED_STATUSES_LATAM == (1, 3, 4, 6, 7, 11, 13)
    assert R.PAID_OUT_STATUSES == (0, 1, 2, 10, 11, 12, 13)
    assert (R.WITHHELD_STATUS, R.WITHHELD_IN_FILE_OLD_STATUS) == (5, 2)
    assert R.WITHHELD_REASON_CODES == (1, 2, 4, 5) and R.OTHER_FRAUD_REASONS == (6, 7)
    assert R.WITHHELD_KINDS == (("fraud", 2), ("trust_safety", 4), ("canceled_event", 5), ("ach_recoup", 1))
    assert R.ACH_REVERSALS == (("deleted", 3), ("voided", 4), ("returned", 6), ("reissued", 7))
    assert len(R.DEC_2018_MANUAL_VOIDS_BRL) == 79 and len(R.DEC_2018_MANUAL_VOIDS_ARS) == 27
    assert sum(R.DEC_2018_MANUAL_VOIDS_BRL) == 622841954 and sum(R.DEC_2018_MANUAL_VOIDS_ARS) == 212872871


# A payout version well inside the December windows, and what moves it over each bound. Times are
# UTC; local midnight is 08:00 in winter. Each pair: the last moment inside, the first outside.
PAYOUT = {"payout_type": "ACH", "status": 2, "status_old": 1, "currency": "USD", "created": "2018-06-01 00:00:00",
          "trx_date": "2018-06-02 00:00:00", "changed": "2018-06-03 00:00:00"}
BOUNDS = [
    ({"currency": "USD"}, "created", "2019-01-03 08:00:00", "2019-01-03 08:00:01"),
    ({"currency": "GBP"}, "created", "2018-12-29 08:00:00", "2018-12-29 08:00:01"),
    ({"currency": "EUR"}, "created", "2019-01-01 08:00:00", "2019-01-01 08:00:01"),
    ({"currency": "SGD"}, "trx_date", "2019-01-03 07:59:59", "2019-01-03 08:00:00"),
    ({"currency": "GBP"}, "trx_date", "2018-12-29 07:59:59", "2018-12-29 08:00:00"),
    ({"currency": "EUR"}, "trx_date", "2019-01-01 07:59:59", "2019-01-01 08:00:00"),
    ({"currency": "HKD"}, "changed", "2019-01-02 23:59:59", "2019-01-03 00:00:00"),
    ({"currency": "GBP"}, "changed", "2018-12-28 23:59:59", "2018-12-29 00:00:00"),
    ({"currency": "EUR"}, "changed", "2018-12-31 23:59:59", "2019-01-01 00:00:00"),
    ({"currency": "MXN", "created": "2016-06-01 00:00:00"}, "changed", "2018-12-31 23:59:59", "2019-01-01 00:00:00"),
    ({"currency": "MXN"}, "created", "2017-01-01 07:59:59", "2017-01-01 08:00:00"),
    ({"payout_type": "CHECK"}, "trx_date", "2019-01-01 07:59:59", "2019-01-01 08:00:00"),
    ({"payout_type": "CHECK"}, "changed", "2018-12-31 23:59:59", "2019-01-01 00:00:00"),
    ({"status": 8}, "created", "2019-01-01 07:59:59", "2019-01-01 08:00:00"),
    ({"status": 8}, "changed", "2018-12-31 23:59:59", "2019-01-01 00:00:00"),
]
LATAM = [({"currency": "BRL"}, "changed", "2018-12-31 23:59:59", "2019-01-01 00:00:00"),
         ({"currency": "ARS"}, "changed", "2018-12-28 23:59:59", "2018-12-29 00:00:00")]
CODES = [("status", s, s not in (0, 10, 12, 1)) for s in range(14)]  # 8 comes back in by the wire rule


def payouts(spark, rows):
    cols = list(PAYOUT)
    df = spark.createDataFrame([(i, *({**PAYOUT, **r}[c] for c in cols)) for i, r in enumerate(rows)],
                               "i int, payout_type string, status int, status_old int, currency string, created string, trx_date string, changed string")
    return df.select("i", *cols[:4], *(F.col(c).cast("timestamp_ntz").alias(c) for c in cols[4:]))


@pytest.mark.parametrize("rule,bounds", [(cutoff_matrix, BOUNDS), (latam_rule, LATAM)])
def test_december_bounds_on_both_sides(spark, rule, bounds):
    if rule is latam_rule:
        bounds = [({**b[0], "status": 1}, *b[1:]) for b in bounds]
    rows = [{**base, column: value} for base, column, inside, outside in bounds for value in (inside, outside)]
    got = {r["i"] for r in payouts(spark, rows).where(rule(Period.dec_2018())).select("i").collect()}
    assert got == set(range(0, len(rows), 2))


def test_december_status_codes_and_currencies(spark):
    rows = [{"status": s} for s in range(14)]
    got = {r["i"] for r in payouts(spark, rows).where(cutoff_matrix(Period.dec_2018())).select("i").collect()}
    assert got == {s for s, (_, _, ok) in enumerate(CODES) if ok}
    rows = [{"currency": "BRL", "status": s} for s in range(14)]
    got = {r["i"] for r in payouts(spark, rows).where(latam_rule(Period.dec_2018())).select("i").collect()}
    assert got == set(range(14)) - {0, 10, 12, 2}
    names = ["AUD", "CAD", "EUR", "GBP", "NZD", "USD", "BRL", "ARS", "MXN", "SGD", "HKD", "JPY"]
    for created, inside in (("2018-06-01 00:00:00", {"AUD", "CAD", "EUR", "GBP", "NZD", "USD", "SGD", "HKD"}),
                            ("2016-06-01 00:00:00", {"AUD", "CAD", "EUR", "GBP", "NZD", "USD", "SGD", "HKD", "MXN"})):
        df = payouts(spark, [{"currency": c, "created": created} for c in names])
        assert {names[r["i"]] for r in df.where(cutoff_matrix(Period.dec_2018())).select("i").collect()} == inside


def shifted(month):
    """The December close a month on, with the MXN arm switched on."""
    d = json.loads(json.dumps(DEC))
    d |= {k: month for k in ("itemized_to", "options_before", "ach_old_changed_before", "check_before", "wire_before",
                             "payouts_created_before", "charges_created_before")}
    d["ach_windows"].append({"currencies": ["MXN"], "created_to": month, "before": month})
    return d


@pytest.mark.parametrize("ending", ["json", "toml"])
def test_period_from_a_file(tmp_path, ending):
    d = shifted("2019-02-01")
    path = tmp_path / f"jan.{ending}"
    if ending == "json":
        path.write_text(json.dumps(d))
    else:
        lines = [f"{k} = {json.dumps(v)}" for k, v in d.items() if isinstance(v, str)]
        lines += ["[latam_changed_before]", *(f"{k} = {json.dumps(v)}" for k, v in d["latam_changed_before"].items())]
        for w in d["ach_windows"]:
            lines += ["[[ach_windows]]", *(f"{k} = {json.dumps(v)}" for k, v in w.items())]
        path.write_text("\n".join(lines))
    p = Period.from_file(str(path))
    assert p.itemized_to == "2019-02-01" and p.ach_windows[-1].currencies == ("MXN",)
    assert dataclasses.replace(p, itemized_to="2019-01-01").itemized_to == "2019-01-01"


@pytest.mark.parametrize("change,field", [
    ({"options_befor": "2019-01-01"}, "options_befor"), ({"check_before": None}, "check_before"), ({"check_before": "soon"}, "check_before"),
    ({"history_split": "2012-01-01"}, "history_split"), ({"itemized_to": "2018-01-01"}, "itemized_to"), ({"ach_windows": []}, "ach_windows"),
    ({"ach_windows": [{"currencies": [], "created_to": "2019-01-01", "before": "2019-01-01"}]}, "currencies"),
    ({"ach_windows": [{"currencies": ["USD"], "created_to": "2016-01-01", "before": "2019-01-01"}]}, "created_to"),
    ({"ach_windows": [{"currencies": ["USD"], "before": "2019-01-01"}]}, "ach_windows"),
    ({"latam_changed_before": {"BRL": "2019-01-01"}}, "latam_changed_before"), ({"charges_settled_before": "2013-01-01"}, "charges_settled_before"),
])
def test_period_errors_name_the_field(change, field):
    d = {k: v for k, v in {**DEC, **change}.items() if v is not None}
    with pytest.raises(ValueError, match=field):
        Period.from_dict(d)
