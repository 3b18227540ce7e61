"""Hand-sized fixtures for the reusable operators."""

import datetime as dt

from pyspark.sql import functions as F

from settlebook.operators import (
    Bucket, combine_bucket_sums, conditional_sums, duplicated_keys, exists_flag, full_merge, latest_as_of,
    not_in, partial_bucket_sums, union_distinct,
)


def keys(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


def test_not_in_three_valued(spark):
    left = keys(spark, [1, 2, None], "x")

    def run(s):
        return sorted((r.x for r in not_in(left, "x", keys(spark, s)).collect()), key=lambda v: (v is None, v))

    assert run([1]) == [2]
    assert run([1, None]) == []
    assert run([]) == [1, 2, None]
    assert run([None]) == []
    assert run([3, 3, 3]) == [1, 2]


def test_not_in_matches_sql(spark):
    spark.createDataFrame([(1,), (2,), (None,)], "x bigint").createOrReplaceTempView("l")
    for s in ([1], [1, None], [], [None], [5]):
        keys(spark, s).createOrReplaceTempView("r")
        expect = sorted(map(str, [r.x for r in spark.sql("SELECT x FROM l WHERE x NOT IN (SELECT k FROM r)").collect()]))
        got = sorted(map(str, [r.x for r in not_in(spark.table("l"), "x", spark.table("r")).collect()]))
        assert got == expect, s


def test_not_in_expression_key(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (None, None)], "a bigint, b bigint")
    out = not_in(df, F.coalesce("a", "b"), keys(spark, [1]))
    assert [(r.a, r.b) for r in out.collect()] == [(2, None)]


def test_exists_flag_under_or(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, 50), (None, 50)], "k bigint, v int")
    s = keys(spark, [2, None])
    out = exists_flag(df, "k", s, "_in").where((F.col("v") < 10) | F.col("_in"))
    assert sorted(r.k for r in out.collect()) == [1, 2]


def test_latest_tie_breaks_on_log_position(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, ts, 5, "a"), (1, ts, 9, "b"), (2, ts, 1, "c")],
                               "id bigint, changed timestamp_ntz, log_position bigint, v string")
    out = latest_as_of(df, ["id"], ["changed", "log_position"])
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, "b"), (2, "c")]


def test_latest_then_status_is_tested_after_rank(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, d1, 1, 100), (1, d2, 2, 350), (2, d1, 1, 100)],
                               "id bigint, changed timestamp_ntz, log_position bigint, status int")
    out = latest_as_of(df, ["id"], ["changed", "log_position"], then=F.col("status") == 100)
    assert [r.id for r in out.collect()] == [2]


def test_latest_where_applies_before_rank(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, d1, 1, 100), (1, d2, 2, 350)],
                               "id bigint, changed timestamp_ntz, log_position bigint, status int")
    out = latest_as_of(df, ["id"], ["changed", "log_position"], where=F.col("changed") < F.lit(d2).cast("timestamp_ntz"))
    assert [r.status for r in out.collect()] == [100]


def test_latest_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1)], "id bigint, changed timestamp_ntz, log_position bigint")
    plan = latest_as_of(df, ["id"], ["changed", "log_position"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_full_merge_null_keys_never_match(spark):
    a = spark.createDataFrame([(1, None, 5)], "event_id bigint, currency string, x int")
    b = spark.createDataFrame([(1, None, 7)], "event_id bigint, currency string, x int")
    out = full_merge(a, b, ["event_id", "currency"], [("event_id", "left"), ("currency", "right")], add=["x"])
    assert sorted(r.x for r in out.collect()) == [5, 7]


def test_union_distinct_counts_equal_rows_once(spark):
    a = spark.createDataFrame([(1, 10)], "e bigint, v int")
    b = spark.createDataFrame([(1, 10), (1, 11)], "e bigint, v int")
    assert sorted(r.v for r in union_distinct(a, b).collect()) == [10, 11]


def test_duplicated_keys(spark):
    df = keys(spark, [1, 1, 2, 3, 3, 3], "event_id")
    assert sorted(r.event_id for r in duplicated_keys(df, "event_id").collect()) == [1, 3]


def test_conditional_sums_null_vs_zero(spark):
    df = spark.createDataFrame([("A", 5), ("B", 7)], "t string, v int")
    b = [Bucket("zero_else", F.col("t") == "C"), Bucket("null_else", F.col("t") == "C", else_zero=False),
         Bucket("neg", F.col("t") == "A", sign=-1)]
    r = df.agg(*conditional_sums(b, F.col("v"))).collect()[0]
    assert (r.zero_else, r.null_else, r.neg) == (0, None, -5)


def test_pre_aggregated_bucket_sums_equal_direct(spark):
    # many side pre-aggregated per key, then joined: equals join-then-group
    one = spark.createDataFrame([(1,), (2,)], "k bigint")
    many = spark.createDataFrame([(1, "A", 5), (1, "B", 7), (1, "A", None)], "k bigint, t string, v int")
    b = [Bucket("a", F.col("t") == "A"), Bucket("b", F.col("t") == "B", sign=-1),
         Bucket("c", F.col("t") == "C", else_zero=False)]
    direct = one.join(many, "k", "left").groupBy("k").agg(*conditional_sums(b, F.col("v")))
    pre = many.groupBy("k").agg(*partial_bucket_sums(b, F.col("v"))).withColumn("_m", F.lit(True))
    combined = one.join(pre, "k", "left").groupBy("k").agg(*combine_bucket_sums(b, F.col("_m").isNotNull()))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, combined.collect()))
