"""Inputs in other stored types give the same close; what does not fit is named."""

import dataclasses
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from settlebook.functions import decimals_to_double
from settlebook.oracle.compare import digest, duckdb_connection
from settlebook.oracle.queries import oracle_sql
from settlebook.plans import FIXTURE, close_period
from settlebook.sources import DriverTables, SchemaError, conform, load_inputs, settlement_inputs, write_stage
from settlebook.sources.schema import CONTRACT, TIME, declared

from conftest import SF_SMALL


def as_instants(spark, df):
    """Wall clocks stored as the instants that UTC showed them at, under any session zone."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(f.name))
            df = df.withColumn(f.name, F.timestamp_micros(micros))
    return df


@pytest.fixture(scope="module")
def oracle_balance():
    con = duckdb_connection(SF_SMALL)
    cur = con.execute(oracle_sql()["balance"])
    return digest([c[0] for c in cur.description], [tuple(r) for r in cur.fetchall()])


def balance_of(x):
    df = decimals_to_double(close_period(x, FIXTURE).balance)
    return digest(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def instants(spark):
    """All inputs with instants for times, wider or narrower numbers, and columns nobody asked for."""
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    root = tempfile.mkdtemp(prefix="settlebook-ltz-")
    for f in dataclasses.fields(x):
        df = as_instants(spark, getattr(x, f.name))
        for c, kind in CONTRACT[f.name].items():
            if kind == "code":
                df = df.withColumn(c, F.col(c).cast("bigint"))
            elif kind == "money":
                df = df.withColumn(c, F.col(c).cast("double") if f.name == "invoice_charges" else F.col(c).cast("decimal(30,6)"))
            elif kind == "cents":
                df = df.withColumn(c, F.col(c).cast("decimal(38,0)"))
        write_stage(df.withColumn("unasked", F.lit("x")), f"{root}/{f.name}")
    return root


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_close_on_instants_equals_the_oracle_under_any_session_zone(spark, instants, oracle_balance, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        x = load_inputs(spark, instants)
        assert x.orders.schema == declared("orders")
        assert balance_of(x) == oracle_balance
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_instants_of_catalog_tables(spark, instants, oracle_balance):
    spark.sql("CREATE DATABASE ltz_test LOCATION '%s'" % tempfile.mkdtemp(prefix="settlebook-db-"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in CONTRACT:
            spark.read.parquet(f"{instants}/{name}").write.saveAsTable(f"ltz_test.{name}")
        assert isinstance(spark.table("ltz_test.orders").schema["changed"].dataType, T.TimestampType)
        assert balance_of(load_inputs(spark, "ltz_test", "table")) == oracle_balance
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
        spark.sql("DROP DATABASE ltz_test CASCADE")


def test_cutoffs_reach_the_scan_of_instants(spark, instants):
    from settlebook.functions import local_before
    from settlebook.plans.charges import charge_snapshot
    x = load_inputs(spark, instants)
    plan = charge_snapshot(x.invoice_charges, FIXTURE)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(created" in plan
    assert x.orders.where(local_before("changed", "1996-01-01")).count() > 0


def test_an_instant_in_a_repeated_hour_keeps_its_place(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        moments = ["2018-11-04T08:30:00Z", "2018-11-04T09:30:00Z", "2018-03-11T10:00:00Z", None]
        df = spark.createDataFrame([(i, 1, None, "live", m) for i, m in enumerate(moments)],
                                   "id long, uid long, event_parent long, current_status string, e string")
        got = conform(df.withColumn("end_date", F.to_timestamp("e")), "events").orderBy("id").collect()
        assert [str(r["end_date"]) for r in got] == ["2018-11-04 08:30:00", "2018-11-04 09:30:00", "2018-03-11 10:00:00", "None"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_all_that_is_missing_or_wrong_is_named_at_once(spark):
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    root = tempfile.mkdtemp(prefix="settlebook-bad-")
    for f in dataclasses.fields(x):
        df = getattr(x, f.name)
        if f.name == "orders":
            df = df.drop("mg_fee").withColumn("changed", F.col("changed").cast("string"))
        if f.name == "users":
            df = df.withColumn("id", F.col("id").cast("string"))
        write_stage(df, f"{root}/{f.name}")
    with pytest.raises(SchemaError) as e:
        load_inputs(spark, root)
    for said in ("orders.mg_fee: missing", "orders.changed: stored as string", "users.id: stored as string, needs bigint"):
        assert said in str(e.value)


@pytest.mark.parametrize("stored, good, bad", [
    ("decimal(20,4)", "12.3400", "12.3450"), ("double", "12.34", "12.345"), ("bigint", "12", "10000000000000000"), ("decimal(38,2)", "5.25", "12345678901234567890.00")])
def test_money_is_never_rounded_in_silence(spark, stored, good, bad):
    def charges(v):
        df = spark.createDataFrame([(1, 1, "USD", "t", 1, 1, 1, v), (2, 1, "USD", "t", 1, 1, 1, None)],
                                   "id long, event long, currency string, charge_type string, processed int, payout_id long, parent_id long, a string")
        when = F.lit("2018-01-01").cast("timestamp_ntz")
        return conform(df.select("*", F.col("a").cast(stored).alias("amount"), when.alias("created"), when.alias("changed")), "invoice_charges")
    assert [None if r["amount"] is None else float(r["amount"]) for r in charges(good).orderBy("id").collect()] == [float(good), None]
    with pytest.raises(Exception, match="invoice_charges.amount: .* does not fit"):
        charges(bad).collect()


def test_wider_codes_are_checked(spark):
    base = spark.createDataFrame([(1, 1, 1, 1, 1)], ["event_id", "log_position", "a", "b", "c"])
    from settlebook.plans import rules as R
    cols = [F.lit(v).cast("bigint").alias(n) for n, v in zip((R.ACCEPT_PROCESSOR, R.ACCEPT_PROCESSOR_OLD, R.ACCEPT_PAYPAL, R.ACCEPT_AUTHNET), (1, 0, 1 << 31, 0))]
    df = conform(base.select("event_id", "log_position", F.lit("2018-01-01").cast("timestamp_ntz").alias("changed"), *cols), "history_payment_options")
    with pytest.raises(Exception, match=f"history_payment_options.{R.ACCEPT_PAYPAL}: 2147483648"):
        df.collect()


def test_every_plan_column_is_declared(spark):
    """The close runs on exactly the declared columns."""
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    narrow = type(x)(**{f.name: conform(getattr(x, f.name), f.name) for f in dataclasses.fields(x)})
    assert {n for n, cols in CONTRACT.items() for c, k in cols.items() if k == TIME and c not in getattr(narrow, n).columns} == set()
    assert close_period(narrow, FIXTURE).balance.columns[0] == "balance"
