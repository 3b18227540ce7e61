"""Cutoffs become bounds on the day column of logs stored by day."""

import dataclasses
import re
import tempfile

import pytest
from pyspark.sql import functions as F
from settlebook.functions import local_at_or_after, local_at_or_before, local_before, local_ts
from settlebook.functions.timez import at_or_after, before, day_of
from settlebook.oracle.compare import digest
from settlebook.functions import decimals_to_double
from settlebook.plans import FIXTURE, close_period, combined_net_sales
from settlebook.sources import DriverTables, load_inputs, misplaced, settlement_inputs, with_day, write_by_day, write_stage

from conftest import SF_SMALL

BY_DAY = {"order_itemizations": "transaction_created", "history_orders": "changed", "orders": "changed", "history_payment_options": "changed",
          "payouts": "created", "invoice_charges": "created", "history_payouts": "changed"}
JANUARY = {"history_payment_options", "payouts", "history_payouts"}  # these lie within one month


@pytest.fixture(scope="module")
def plain(spark):
    """The inputs, with the first two days of each month of the tables that are stored by day."""
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    few = {t: getattr(x, t).where((F.dayofmonth(c) <= 2) | F.col(c).isNull()) for t, c in BY_DAY.items() if t not in JANUARY}
    return dataclasses.replace(x, **few)


@pytest.fixture(scope="module")
def stored(spark, plain):
    root = tempfile.mkdtemp(prefix="settlebook-days-")
    for f in dataclasses.fields(plain):
        if f.name in BY_DAY:
            write_by_day(getattr(plain, f.name), f"{root}/{f.name}", BY_DAY[f.name], files_per_day=2 if f.name in JANUARY else 1)
        else:
            write_stage(getattr(plain, f.name), f"{root}/{f.name}")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # plans show whole filters
    yield root
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def partition_filters(df):
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", df._jdf.queryExecution().executedPlan().toString())


def fingerprint(df):
    df = decimals_to_double(df)
    return digest(df.columns, [tuple(r) for r in df.collect()])


def test_the_close_is_the_same_on_tables_stored_by_day(spark, stored, plain):
    x = load_inputs(spark, stored)
    close, want = close_period(x, FIXTURE), close_period(plain, FIXTURE)
    for stage in ("payout_snapshot", "charge_snapshot", "balance"):
        assert fingerprint(getattr(close, stage)) == fingerprint(getattr(want, stage)), stage
    assert "created_day" not in close.charge_snapshot.columns
    n1 = combined_net_sales(x.history_orders, x.orders, x.events, FIXTURE)
    assert fingerprint(n1) == fingerprint(combined_net_sales(plain.history_orders, plain.orders, plain.events, FIXTURE))


@pytest.mark.parametrize("step, day, bounds", [
    ("itemized", "transaction_created_day", (">= 1999-01-01", "<= 1999-12-31")),
    ("history", "changed_day", (">= 1995-06-01", "<= 1999-01-01")),
    ("net_sales", "changed_day", ("<= 2024-01-22",)),
    ("charge_snapshot", "created_day", ("<= 2001-01-01",)),
    ("payout_snapshot", "created_day", ("<= 2024-01-22",))])
def test_derived_bounds_are_partition_filters(spark, stored, step, day, bounds):
    found = [f for f in partition_filters(getattr(close_period(load_inputs(spark, stored), FIXTURE), step)) if day in f]
    for b in bounds:
        assert any(re.search(rf"{day}#\d+ {re.escape(b)}", f) for f in found), (b, found)


def test_fewer_files_are_read(spark, stored):
    x = load_inputs(spark, stored)
    all_files = len(x.order_itemizations.inputFiles())
    day = day_of(x.order_itemizations, "transaction_created")
    year = x.order_itemizations.where(at_or_after("transaction_created", "1999-01-01", day) & before("transaction_created", "2000-01-01", day))
    plan = year.select("order_id").toPandas() is not None and year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_created_day" in plan
    read = spark.read.parquet(f"{stored}/order_itemizations").where("transaction_created_day >= '1999-01-01' and transaction_created_day <= '1999-12-31'")
    assert len(read.select(F.input_file_name()).distinct().collect()) < all_files / 4


def test_bounds_of_every_helper_are_implied(spark):
    """Over hours around changes of the clock, the day bound never removes a row that the test keeps."""
    hours = spark.range(24 * 9).select((F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2018-11-01").cast("timestamp_ntz"))).alias("t"))
    hours = hours.unionByName(spark.range(24 * 9).select((F.timestamp_add("MINUTE", (F.col("id") * 37).cast("int"), F.lit("2018-03-09").cast("timestamp_ntz"))).alias("t")))
    hours = with_day(hours.unionByName(spark.sql("SELECT CAST(NULL AS timestamp_ntz) AS t")), "t")
    assert misplaced(hours, "t").isEmpty()
    for bound in ("2018-11-04 01:30:00", "2018-11-04", "2018-03-11 02:30:00", "2018-11-05 00:00:00.5", "2018-11-03 23:59:59"):
        for helper in (local_before, local_at_or_after, local_at_or_before):
            assert hours.where(helper("t", bound, day="t_day")).exceptAll(hours.where(helper("t", bound))).isEmpty()
            assert hours.where(helper("t", bound)).exceptAll(hours.where(helper("t", bound, day="t_day"))).isEmpty(), (helper, bound)
        for helper in (before, at_or_after):
            assert hours.where(helper("t", bound)).exceptAll(hours.where(helper("t", bound, "t_day"))).isEmpty()
    assert hours.where(local_ts("t") < F.lit("2018-11-04 01:30:00").cast("timestamp_ntz")).count() == hours.where(local_before("t", "2018-11-04 01:30:00", day="t_day")).count()


def test_misplaced_rows_are_found(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2018-01-01 23:59:59' AS t, DATE'2018-01-02' AS t_day")
    assert misplaced(df, "t").count() == 1
