"""Stages are published whole or not at all, and resumed only if made from the same."""

import dataclasses
import tempfile

import pytest
from pyspark.sql import functions as F
from settlebook.functions import decimals_to_double
from settlebook.oracle.compare import digest
from settlebook.plans import FIXTURE, close_period
from settlebook.plans.closing import STAGES
from settlebook.sources import DriverTables, StageStore, input_fingerprint, load_inputs, run_fingerprint, settlement_inputs, write_stage
from settlebook.sources.warehouse import path_exists

from conftest import SF_SMALL


class Counting(StageStore):
    def __init__(self, *a, **kw):
        super().__init__(*a, **kw)
        self.computed = []

    def __call__(self, stage, make):
        return super().__call__(stage, lambda: self.computed.append(stage) or make())


def fingerprint(df):
    df = decimals_to_double(df)
    return digest(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture
def where(spark, request):
    if request.param == "parquet":
        yield tempfile.mkdtemp(prefix="settlebook-stages-"), "parquet"
        return
    spark.sql("CREATE DATABASE stages_test LOCATION '%s'" % tempfile.mkdtemp(prefix="settlebook-db-"))
    yield "stages_test", "table"
    spark.sql("DROP DATABASE stages_test CASCADE")


both = pytest.mark.parametrize("where", ["parquet", "table"], indirect=True)


@both
def test_a_write_that_fails_leaves_the_former_stage(spark, where):
    out, fmt = where
    StageStore(spark, out, fmt)("a", lambda: spark.range(10).toDF("v"))
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        StageStore(spark, out, fmt)("a", lambda: broken)
    assert StageStore(spark, out, fmt).read("a").count() == 10
    if fmt == "table":
        assert spark.table("stages_test.a").count() == 10
    assert StageStore(spark, out, fmt)("a", lambda: spark.range(3).toDF("v")).count() == 3


@both
def test_the_former_version_stays_for_readers_and_older_ones_go(spark, where):
    out, fmt = where
    first = StageStore(spark, out, fmt)("a", lambda: spark.range(1).toDF("v"))
    old = StageStore(spark, out, fmt).manifest("a")["version"]
    StageStore(spark, out, fmt)("a", lambda: spark.range(2).toDF("v"))
    assert first.count() == 1
    StageStore(spark, out, fmt)("a", lambda: spark.range(3).toDF("v"))
    now = StageStore(spark, out, fmt).manifest("a")
    assert len(now["before"]) == 1 and old not in now["before"]
    assert not (spark.catalog.tableExists(f"{out}.a__{old}") if fmt == "table" else path_exists(spark, f"{out}/a/{old}"))
    assert StageStore(spark, out, fmt).read("a").count() == 3


@both
def test_resume_needs_the_same_run_and_the_same_earlier_stages(spark, where):
    out, fmt = where

    def run(key, resume=True):
        s = Counting(spark, out, fmt, resume=resume, run=key)
        for i, name in enumerate("abc"):
            s(name, lambda: spark.range(i + 1).toDF("v"))
        return s.computed

    assert run("k1", False) == ["a", "b", "c"]
    assert run("k1") == []
    assert run("k2") == ["a", "b", "c"]
    s = Counting(spark, out, fmt, run="k2")  # one stage in the middle made anew by another process
    s.made = {"a": s.manifest("a")["version"]}
    s("b", lambda: spark.range(9).toDF("v"))
    assert run("k2") == ["c"]
    with pytest.raises(ValueError, match="fingerprint"):
        StageStore(spark, out, fmt, resume=True)


def test_a_missing_stage_is_an_error(spark):
    with pytest.raises(FileNotFoundError, match="no stage x"):
        StageStore(spark, tempfile.mkdtemp(prefix="settlebook-stages-")).read("x")


def test_fingerprints_tell_files_rows_and_periods_apart(spark):
    root = tempfile.mkdtemp(prefix="settlebook-fp-")
    write_stage(spark.range(5).toDF("v"), f"{root}/t")
    one = input_fingerprint(spark.read.parquet(f"{root}/t"))
    assert one == input_fingerprint(spark.read.parquet(f"{root}/t"))
    spark.range(1).toDF("v").write.mode("append").parquet(f"{root}/t")
    assert one != input_fingerprint(spark.read.parquet(f"{root}/t"))
    a, b = spark.createDataFrame([(1,), (2,)], "v long"), spark.createDataFrame([(2,), (1,)], "v long")
    assert input_fingerprint(a) == input_fingerprint(b) != input_fingerprint(spark.createDataFrame([(1,), (2,), (2,)], "v long"))
    assert run_fingerprint({"a": a}, FIXTURE) != run_fingerprint({"a": a}, dataclasses.replace(FIXTURE, wire_before="2024-01-24"))


def test_close_resumed_with_other_inputs_or_period_is_computed_again(spark):
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    root, out = tempfile.mkdtemp(prefix="settlebook-wh-"), tempfile.mkdtemp(prefix="settlebook-stages-")
    for f in dataclasses.fields(x):
        write_stage(getattr(x, f.name), f"{root}/{f.name}")

    def close(period=FIXTURE):
        inputs = load_inputs(spark, root)
        s = Counting(spark, out, resume=True, run=run_fingerprint(inputs, period))
        return fingerprint(close_period(inputs, period, s).balance), s.computed

    first, made = close()
    assert made == list(STAGES)
    assert close() == (first, [])
    later = dataclasses.replace(FIXTURE, charges_created_before="1998-01-01")
    other, made = close(later)
    assert made == list(STAGES) and other != first
    x.wire_in_events.limit(1).write.mode("append").parquet(f"{root}/wire_in_events")
    assert close(later)[1] == list(STAGES)
    back, made = close()
    assert back == first and made == list(STAGES)


def test_joins_of_bucketed_stages_move_no_rows(spark):
    """The merge, payout and charge joins read both sides as they lie."""
    from settlebook.plans.charges import charge_buckets
    from settlebook.plans.net_sales import merge_net_sales
    from settlebook.plans.payouts import payout_buckets
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    spark.sql("CREATE DATABASE bucket_test LOCATION '%s'" % tempfile.mkdtemp(prefix="settlebook-db-"))
    try:
        c = close_period(x, FIXTURE, StageStore(spark, "bucket_test", "table", buckets=4))
        assert fingerprint(c.balance) == fingerprint(close_period(x, FIXTURE).balance)

        def exchanges_below_join(df, kind):
            lines = df._jdf.queryExecution().sparkPlan().toString() and df._jdf.queryExecution().executedPlan().toString().split("\n")
            at = next(i for i, line in enumerate(lines) if "SortMergeJoin [event_id" in line and "currency" in line and kind in line)
            depth = lambda line: len(line) - len(line.lstrip(" :+-"))
            own = []
            for line in lines[at + 1:]:
                if depth(line) <= depth(lines[at]):
                    break
                own.append(line)
            return [line for line in own if "Exchange" in line]

        assert exchanges_below_join(merge_net_sales(c.itemized, c.history), "FullOuter") == []
        assert exchanges_below_join(payout_buckets(c.net_sales, sums=c.payout_sums), "FullOuter") == []
        joined = charge_buckets(c.payout_level, None, x.wire_in_events, FIXTURE, sums=c.charge_sums)
        assert exchanges_below_join(joined, "LeftOuter") == []
    finally:
        spark.sql("DROP DATABASE bucket_test CASCADE")
