"""The close gives the same balance lazily, from written stages, and when its
inputs are read back from written tables."""

import dataclasses
import os
import tempfile

from settlebook.functions import decimals_to_double
from settlebook.oracle.compare import digest
from settlebook.plans import FIXTURE, close_period
from settlebook.plans.closing import STAGES
from settlebook.sources import DriverTables, load_inputs, settlement_inputs, write_stage
from settlebook.sources import StageStore

from conftest import SF_SMALL


def fingerprint(df):
    df = decimals_to_double(df)
    return df.count(), digest(df.columns, [tuple(r) for r in df.collect()])


def test_stored_and_reloaded_close_agree(spark):
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    lazy = fingerprint(close_period(x, FIXTURE).balance)
    assert lazy[0] > 0
    stored = tempfile.mkdtemp(prefix="settlebook-stages-")
    assert fingerprint(close_period(x, FIXTURE, StageStore(spark, stored)).balance) == lazy
    assert fingerprint(close_period(x, FIXTURE, StageStore(spark, stored)).balance) == lazy  # over existing output

    root = tempfile.mkdtemp(prefix="settlebook-wh-")
    for f in dataclasses.fields(x):
        write_stage(getattr(x, f.name), f"{root}/{f.name}")
    reloaded = load_inputs(spark, root)
    assert fingerprint(close_period(reloaded, FIXTURE).balance) == lazy


def test_december_2018_period_matches_oracle(spark):
    """The worksheet's own dates (odd-second bounds, per-currency cutoffs)
    through the whole close, against the direct SQL with the same period.
    The driver data lies outside most of these windows, so this mainly checks
    that a period's literals mean the same in both engines."""
    from settlebook.functions import decimals_to_double as to_double
    from settlebook.oracle.compare import compare, duckdb_connection
    from settlebook.oracle.steps import with_ctes
    from settlebook.plans import Period
    from settlebook.plans import rules as R

    dec = Period.dec_2018()
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    close = close_period(x, dec)
    con = duckdb_connection(SF_SMALL)
    money = ("balance", "epp_net_sales", "offline_net_sales") + R.PAYOUT_BUCKETS + R.CHARGE_BUCKETS
    for stage, cte, cols in (("history", "x_s2", ("epp_net_sales", "offline_net_sales")),
                             ("payout_snapshot", "x_s6", ("amount",)),
                             ("balance", "x_s10", money)):
        rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
        sql = with_ctes(f"SELECT * REPLACE ({rep}) FROM {cte}", dec)
        r = compare(spark, stage, lambda s, d, st=stage: to_double(getattr(close, st)), sql, SF_SMALL, con)
        assert r["ok"], r


def test_december_2018_manual_voids_load_as_a_table(spark):
    from settlebook.plans import rules as R
    from settlebook.sources import manual_voids_table

    voids = manual_voids_table(spark, R.DEC_2018_MANUAL_VOIDS_BRL + R.DEC_2018_MANUAL_VOIDS_ARS)
    assert voids.count() == len(R.DEC_2018_MANUAL_VOIDS_BRL) + len(R.DEC_2018_MANUAL_VOIDS_ARS) == 106
    assert {r.payout_id for r in voids.collect()} == {*R.DEC_2018_MANUAL_VOIDS_BRL, *R.DEC_2018_MANUAL_VOIDS_ARS}


def test_resume_starts_at_the_first_missing_stage(spark):
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    made = []

    class Counting(StageStore):
        def __call__(self, stage, make):
            return super().__call__(stage, lambda: made.append(stage) or make())

    out = tempfile.mkdtemp(prefix="settlebook-stages-")
    first = fingerprint(close_period(x, FIXTURE, Counting(spark, out, run="k")).balance)
    assert made == list(STAGES)
    made.clear()
    assert fingerprint(close_period(x, FIXTURE, Counting(spark, out, resume=True, run="k")).balance) == first
    assert made == []
    os.remove(f"{out}/payout_snapshot/_current.json")
    assert fingerprint(close_period(x, FIXTURE, Counting(spark, out, resume=True, run="k")).balance) == first
    assert made == list(STAGES[STAGES.index("payout_snapshot"):])


def test_stages_as_catalog_tables(spark):
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    spark.sql("CREATE DATABASE IF NOT EXISTS close_test LOCATION '%s'" % tempfile.mkdtemp(prefix="settlebook-db-"))
    try:
        store = StageStore(spark, "close_test", "table", stages=["net_sales", "balance"])
        got = fingerprint(close_period(x, FIXTURE, store).balance)
        assert got == fingerprint(close_period(x, FIXTURE).balance)
        names = [t.name for t in spark.catalog.listTables("close_test")]
        assert sorted(n for n in names if "__" not in n) == ["balance", "net_sales"] and len(names) == 4
        assert fingerprint(spark.table("close_test.balance")) == got
    finally:
        spark.sql("DROP DATABASE close_test CASCADE")
