"""Bitmap NOT IN, the state carried from close to close, and charge rules as a table."""

import tempfile

import pytest
from pyspark.sql import functions as F
from settlebook.functions import decimals_to_double
from settlebook.operators import Facts, KeySet, carried_on, latest_as_of, not_in, not_in_split, set_facts, unfolded
from settlebook.operators.split import bits_for, bitmap, split_by_bitmap
from settlebook.oracle.compare import digest
from settlebook.plans import FIXTURE, close_period
from settlebook.plans import rules as R
from settlebook.plans.charge_rules import SCHEMA, charge_sums_by_rules, checked_rules, default_rules, rules_table, sparse_charge_sums
from settlebook.plans.charges import charge_sums
from settlebook.sources import DriverTables, settlement_inputs

from conftest import SF_SMALL


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# --- NOT IN by a bitmap ---------------------------------------------------------


def rows(spark, *keys):
    return spark.createDataFrame([(k, str(k)) for k in keys], "k long, v string")


@pytest.mark.parametrize("members", [[], [1], [1, 2, 2, 5], [1, None], [None], list(range(0, 3000, 3))])
def test_the_split_is_not_in(spark, members):
    left = rows(spark, *range(-5, 3000, 7), None, 1, 1, 2)
    s = spark.createDataFrame([(m,) for m in members], "m long")
    facts = set_facts(s=KeySet(s, "m"))["s"]
    assert facts == Facts(len(members), members.count(None))
    left.createOrReplaceTempView("l"), s.createOrReplaceTempView("s")
    want = spark.sql("SELECT * FROM l WHERE k NOT IN (SELECT m FROM s)")
    assert same(not_in_split(left, "k", s, "m", facts), want)
    assert same(not_in(left, "k", s, "m", facts=facts), want)


def test_only_hits_go_to_the_exact_join(spark):
    """A set of ten times the rows: nearly all rows outside it are told so by the bitmap alone."""
    left = spark.range(0, 2_000_000, 100).select(F.col("id").alias("k"))
    s = spark.range(1, 400_001, 2).select((F.col("id") * 10).alias("m"))  # 200,000 keys, none of them in left but multiples of 100
    bits = bits_for(200_000, 1 << 27)
    outside, others = split_by_bitmap(left, "k", s, "m", bits)
    inside = left.join(s, F.col("k") == F.col("m"), "left_semi").count()
    assert outside.count() + others.count() == 20_000
    assert inside <= others.count() <= inside + 0.09 * 20_000
    assert same(not_in_split(left, "k", s, "m", Facts(200_000, 0)), left.join(s, F.col("k") == F.col("m"), "left_anti"))


def test_bitmaps_are_bounded(spark):
    assert bits_for(10**12, 1 << 27) == 0 and bits_for(1, 1 << 27) == 1 << 10 and bits_for(1 << 25, 1 << 27) == 1 << 27
    words = bitmap(spark.range(100_000), "id", 1 << 12)
    assert words.count() <= (1 << 12) // 64
    plan = not_in_split(rows(spark, 1), "k", spark.range(9), "id", Facts(10**12, 0))._jdf.queryExecution().toString()
    assert "shiftright" not in plan  # too large a set: the plain anti join


def test_facts_of_several_sets_take_one_pass_per_table(spark):
    log = spark.createDataFrame([(1, 8), (None, 8), (2, 1), (3, None)], "id long, status int")
    other = spark.createDataFrame([(None,), (None,)], "id long")
    got = set_facts(wired=KeySet(log, "id", F.col("status") == 8), all=KeySet(log, "id"), other=KeySet(other, "id"), none=KeySet(other, "id", F.col("id") > 0))
    assert got == {"wired": Facts(2, 1), "all": Facts(4, 1), "other": Facts(2, 2), "none": Facts(0, 0)}


def test_itemized_net_sales_needs_few_jobs(spark):
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    sc = spark.sparkContext
    sc.setJobGroup("op1-jobs", "itemized net sales")
    try:
        df = close_period(x, FIXTURE).itemized
        assert len(sc.statusTracker().getJobIdsForGroup("op1-jobs")) <= 6  # facts: one query, a job per shuffle
        assert "scalar-subquery" not in df._jdf.queryExecution().optimizedPlan().toString()
        df.collect()
        assert len(sc.statusTracker().getJobIdsForGroup("op1-jobs")) <= 20
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


# --- state from close to close ----------------------------------------------------

KEYS, ORDER, PAYLOAD = ["k"], ("changed", "log_position"), ("status", "amount")


def log_rows(spark, rows):
    return spark.createDataFrame(rows, "k long, changed string, log_position long, status int, amount long").withColumn(
        "changed", F.col("changed").cast("timestamp_ntz"))


def whole(log, cutoff, rule=None):
    bound = F.col("changed") < F.lit(cutoff).cast("timestamp_ntz")
    return latest_as_of(log, KEYS, [*ORDER, *PAYLOAD], where=bound & rule if rule is not None else bound).select("k", *ORDER, *PAYLOAD)


def test_state_and_delta_equal_the_whole_fold(spark):
    """Late rows, ties, keys that come anew, and versions whose status ends a key's standing."""
    root = tempfile.mkdtemp(prefix="settlebook-log-")
    def read(files=None):
        return spark.read.parquet(*(files or [root]))
    def rule(cutoff):
        return F.col("status") != 9
    log_rows(spark, [(1, "2018-01-05", 1, 1, 10), (1, "2018-02-05", 2, 3, 11), (2, "2018-01-31 23:59:59", 1, 1, 20), (2, "2018-02-01", 2, 1, 21),
                     (3, "2018-03-01", 1, 1, 30), (4, "2018-01-01", 5, 1, 40), (5, "2018-01-02", 1, 9, 50), (None, "2018-01-02", 1, 1, 60)]).write.parquet(root, mode="append")
    state, seen, how = carried_on(read(), KEYS, ORDER, PAYLOAD, "2018-02-01", qualifies=rule)
    assert how == "whole" and same(unfolded(state, KEYS), whole(read(), "2018-02-01", rule("")))
    state = spark.createDataFrame(state.collect(), state.schema)  # as persisted
    log_rows(spark, [(1, "2018-01-06", 9, 2, 12),  # late, but newer than what January knew
                     (2, "2018-01-01", 7, 1, 22),  # late and older
                     (4, "2018-01-01", 5, 1, 41),  # a tie in time and position
                     (4, "2018-02-07", 6, 9, 42),  # never qualifies
                     (6, "2018-02-27", 1, 1, 70), (6, "2018-03-02", 2, 1, 71)]).write.parquet(root, mode="append")
    nxt, seen2, how = carried_on(read(), KEYS, ORDER, PAYLOAD, "2018-03-01", (state, seen), rule, read=read)
    assert how == "delta" and same(unfolded(nxt, KEYS), whole(read(), "2018-03-01", rule("")))
    same_cutoff, _, how = carried_on(read(), KEYS, ORDER, PAYLOAD, "2018-02-01", (state, seen), rule, read=read)
    assert how == "delta" and same(unfolded(same_cutoff, KEYS), whole(read(), "2018-02-01", rule("")))
    again, _, how = carried_on(read(), KEYS, ORDER, PAYLOAD, "2018-03-01", (nxt, seen2), rule, read=read)
    assert how == "delta" and same(unfolded(again, KEYS), unfolded(nxt, KEYS))


def test_state_is_void_if_files_are_gone_or_the_cutoff_went_back(spark):
    root = tempfile.mkdtemp(prefix="settlebook-log-")
    log_rows(spark, [(1, "2018-01-05", 1, 1, 10), (1, "2018-02-05", 2, 3, 11)]).write.parquet(root, mode="overwrite")
    state, seen, _ = carried_on(spark.read.parquet(root), KEYS, ORDER, PAYLOAD, "2018-03-01")
    state = spark.createDataFrame(state.collect(), state.schema)
    back, _, how = carried_on(spark.read.parquet(root), KEYS, ORDER, PAYLOAD, "2018-02-01", (state, seen), read=lambda f: spark.read.parquet(*f))
    assert how == "whole" and back.select("_state.log_position").collect()[0][0] == 1
    log_rows(spark, [(1, "2018-01-05", 1, 1, 10)]).write.parquet(root, mode="overwrite")
    now, _, how = carried_on(spark.read.parquet(root), KEYS, ORDER, PAYLOAD, "2018-03-01", (state, seen), read=lambda f: spark.read.parquet(*f))
    assert how == "whole" and now.select("_state.log_position").collect()[0][0] == 1


# --- charge rules -----------------------------------------------------------------


@pytest.fixture(scope="module")
def charges(spark):
    return close_period(settlement_inputs(DriverTables(spark, SF_SMALL)), FIXTURE).charge_snapshot


def test_the_rule_table_gives_the_same_sums(spark, charges):
    dense = charge_sums(charges, FIXTURE)
    by_rules = charge_sums_by_rules(charges, rules_table(spark), FIXTURE).select(*dense.columns)
    def fingerprint(df):
        df = decimals_to_double(df)
        return digest(df.columns, [tuple(r) for r in df.collect()])
    assert fingerprint(by_rules) == fingerprint(dense)


def test_a_new_charge_type_is_a_new_row(spark, charges):
    base = sparse_charge_sums(charges, rules_table(spark), FIXTURE).where("bucket = 'equipment'").agg(F.sum("amount")).first()[0]
    more = rules_table(spark, [*default_rules(), ("CHARGE_NEW_PRODUCT", "equipment", "settled", None)])
    got = sparse_charge_sums(charges, more, FIXTURE).where("bucket = 'equipment'").agg(F.sum("amount")).first()[0]
    own = sparse_charge_sums(charges.where("charge_type = 'CHARGE_NEW_PRODUCT'"), more, FIXTURE).where("bucket = 'equipment'").agg(F.sum("amount")).first()[0]
    assert got == base + own and own != 0


def test_a_charge_counts_once_for_a_bucket(spark, charges):
    t = R.CHARGE_CATEGORIES[0][1][0]
    twice = rules_table(spark, [(t, "equipment", "settled", None), (None, "equipment", "settled", None)])
    once = rules_table(spark, [(None, "equipment", "settled", None)])
    assert same(sparse_charge_sums(charges, twice, FIXTURE), sparse_charge_sums(charges, once, FIXTURE))


def test_no_charges_no_rules_and_rules_that_cannot_be_applied(spark, charges):
    assert charge_sums_by_rules(charges.where("false"), rules_table(spark), FIXTURE).count() == 0
    none = charge_sums_by_rules(charges, spark.createDataFrame([], SCHEMA), FIXTURE)
    assert none.count() == charges.select("event", "currency").distinct().count() and none.where("credits_charges_total <> 0").isEmpty()
    for bad in [("A", "no_such_bucket", "settled", None), ("A", "equipment", "sometimes", None), ("A", "equipment", "settled", 2), ("A", None, "settled", None)]:
        with pytest.raises(ValueError, match="cannot be applied"):
            checked_rules(rules_table(spark, [bad]))
    with pytest.raises(ValueError, match="cannot be applied"):
        checked_rules(rules_table(spark, [("A", "equipment", "settled", None)] * 2))
