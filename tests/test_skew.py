"""A third of all rows on one key: results stay exact.

The driver's sf0.01 tables are copied with one rule applied: every third
order belongs to customer 42 (so one event holds a third of orders, line
items, itemizations and charges) and every third change-log event belongs to
user 7 (one event holds a third of the payout and payment-option logs).
Spark and the DuckDB oracle read the same skewed copy.
"""

import tempfile
from dataclasses import replace

import duckdb
import pytest

from settlebook.oracle.compare import compare
from settlebook.queries import in_under_or, queries
from settlebook.sources import DriverTables, settlement_inputs
from settlebook.oracle.queries import oracle_sql

from conftest import SF_CHECK

SKEWED = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 42 ELSE o_custkey END AS o_custkey) FROM t",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM t",
}
TABLES = ("customer", "nation", "lineitem", "orders", "events")
STEPS = ("itemized_net_sales", "history_net_sales", "combined_net_sales", "payout_snapshot", "payout_buckets",
         "charge_buckets", "balance", "multi_processor_events", "not_in_set")
# and, with a third of all line items on one (transfer) order:
RAW = ("in_under_or", "join_left_computed_key")
HOT_ORDER = {"lineitem": "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 58 ELSE l_orderkey END AS l_orderkey) FROM t"}


def skewed_copy(rules):
    root = tempfile.mkdtemp(prefix="settlebook-skew-")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW t AS SELECT * FROM read_parquet('{SF_CHECK}/{name}.parquet')")
        body = rules.get(name, "SELECT * FROM t")
        con.execute(f"COPY ({body}) TO '{root}/{name}.parquet' (FORMAT PARQUET, ROW_GROUP_SIZE 2048)")
        con.execute("DROP VIEW t")
    return root


@pytest.fixture(scope="module")
def skewed_dir():
    return skewed_copy(SKEWED)


@pytest.fixture(scope="module")
def hot_order_dir():
    return skewed_copy(HOT_ORDER)


@pytest.mark.parametrize("name", STEPS)
def test_hot_keys_keep_results_exact(spark, skewed_dir, name):
    con = duckdb_connection_subset(skewed_dir)
    r = compare(spark, name, queries()[name], oracle_sql()[name], skewed_dir, con)
    assert r["ok"], r
    assert r["spark_rows"] > 0


@pytest.mark.parametrize("name", RAW)
def test_hot_order_keeps_results_exact(spark, hot_order_dir, name):
    r = compare(spark, name, queries()[name], oracle_sql()[name], hot_order_dir, duckdb_connection_subset(hot_order_dir))
    assert r["ok"], r
    assert r["spark_rows"] > 0


def duckdb_connection_subset(root):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def test_hot_event_holds_a_third_of_the_orders(skewed_dir):
    con = duckdb_connection_subset(skewed_dir)
    share = con.execute("SELECT avg(CASE WHEN o_custkey = 42 THEN 1 ELSE 0 END) FROM orders").fetchall()[0][0]
    assert share > 0.33


@pytest.mark.parametrize("name", ["combined_net_sales", "not_in_set", *RAW])
def test_hot_partition_is_split_by_aqe(spark, skewed_dir, hot_order_dir, name):
    """Where raw or per-(order, event) rows of a hot key meet another table,
    the inputs of the join are plain shuffles, so AQE's skew-join handling
    splits that partition (thresholds scaled down to the fixture's size)."""
    folder = hot_order_dir if name in RAW else skewed_dir
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            # a hot partition is split between map tasks, so the scan must have several
            "spark.sql.files.maxPartitionBytes": "16KB", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        if name == "in_under_or":  # the log as a table: derived from line items it is partitioned by order already
            x = settlement_inputs(DriverTables(spark, folder))
            log = tempfile.mkdtemp(prefix="settlebook-skew-") + "/log"
            x.history_orders.repartition(8).write.parquet(log)
            df = in_under_or(replace(x, history_orders=spark.read.parquet(log)), None)
        else:
            df = queries()[name](spark, folder)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
