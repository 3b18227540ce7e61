"""Wall-clock helpers: the pushable rewrites agree with the wrapped form."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from settlebook.functions import (
    effective_before, local_at_or_after, local_at_or_before, local_before, local_to_utc, local_ts, ts_lit,
)

TZ = "America/Los_Angeles"


def sweep(spark, around, hours=10):
    rows = []
    base = dt.datetime.fromisoformat(around)
    step = dt.timedelta(minutes=7, seconds=13, microseconds=900_000)
    t = base - dt.timedelta(hours=hours)
    while t < base + dt.timedelta(hours=hours):
        rows.append((t,))
        t += step
    for d in (-1, 0, 1):  # the exact edges
        for frac in (0, 900_000):
            rows.append((base + dt.timedelta(hours=8, seconds=d, microseconds=frac),))
            rows.append((base + dt.timedelta(hours=7, seconds=d, microseconds=frac),))
    rows.append((None,))
    return spark.createDataFrame(rows, "c timestamp_ntz")


def test_cutoff_fixture(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 1, 7, 59, 59, 900000),), (dt.datetime(2018, 1, 1, 8),)],
                               "c timestamp_ntz")
    out = df.select(local_before("c", "2018-01-01").alias("b"), local_ts("c").alias("l")).collect()
    assert [r.b for r in out] == [True, False]
    assert out[0].l == dt.datetime(2017, 12, 31, 23, 59, 59)


@pytest.mark.parametrize("bound", ["2018-01-01", "2019-01-03", "2013-08-14 03:13:18", "2024-03-10 02:30:00",
                                   "2024-11-03 01:30:00", "2024-11-03 00:00:00", "2024-03-10 03:00:00"])
def test_rewrites_equal_wrapped(spark, bound):
    df = sweep(spark, bound)
    wrapped = local_ts("c")
    b = ts_lit(bound)
    checks = df.select(
        (local_before("c", bound).eqNullSafe(wrapped < b)).alias("lt"),
        (local_at_or_after("c", bound).eqNullSafe(wrapped >= b)).alias("ge"),
        (local_at_or_before("c", bound).eqNullSafe(wrapped <= b)).alias("le"),
    ).agg(F.min(F.col("lt").cast("int")), F.min(F.col("ge").cast("int")), F.min(F.col("le").cast("int"))).collect()[0]
    assert tuple(checks) == (1, 1, 1)


def test_ambiguous_and_missing_bounds_are_not_rewritten():
    assert local_to_utc("2024-11-03 01:30:00") is None  # repeated hour
    assert local_to_utc("2024-03-10 02:30:00") is None  # DST gap
    assert local_to_utc("2019-01-01") == dt.datetime(2019, 1, 1, 8)


def test_effective_before_matches_coalesce(spark):
    rows = [(None, dt.datetime(2018, 12, 31, 9)), (dt.datetime(2019, 1, 2, 7), dt.datetime(2018, 12, 1)),
            (dt.datetime(2019, 1, 1, 9), dt.datetime(2018, 12, 1)), (None, None)]
    df = spark.createDataFrame(rows, "trx timestamp_ntz, created timestamp_ntz")
    got = [r[0] for r in df.select(effective_before(["trx", "created"], "2019-01-01")).collect()]
    want = [r[0] for r in df.select(F.coalesce(local_ts("trx"), local_ts("created")) < ts_lit("2019-01-01")).collect()]
    assert [bool(x) for x in got] == [bool(x) for x in want]


def test_cutoff_is_pushed_to_parquet(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where(local_before("ts", "2024-01-20"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan
