"""Plan assertions over every registered query: no Python in the hot path,
no cartesian products or nested-loop joins, filters reach the scans."""

import pytest

from settlebook.queries import queries

from conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")
QUERIES = queries()


def plan_of(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cartesian(spark, name):
    plan = plan_of(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_local_cutoffs_reach_the_scan(spark):
    assert "GreaterThanOrEqual(ts," in plan_of(spark, "local_cutoff")


@pytest.fixture(scope="module")
def written(spark):
    """The settlement inputs as tables, and a session that never broadcasts at run time."""
    import dataclasses
    import tempfile

    from settlebook.sources import DriverTables, load_inputs, settlement_inputs, write_stage
    x = settlement_inputs(DriverTables(spark, SF_SMALL))
    root = tempfile.mkdtemp(prefix="settlebook-wh-")
    for f in dataclasses.fields(x):
        write_stage(getattr(x, f.name), f"{root}/{f.name}")
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "100000",
            "spark.sql.debug.maxToStringFields": "1000"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield load_inputs(spark, root)
    for k, v in before.items():
        spark.conf.set(k, v)


def executed(df):
    """The plan that ran, without the initial ones; a shuffle that is used again stands there as ReusedExchange."""
    df.collect()
    kept, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if skip is not None and depth > skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def shuffles(plan):
    return plan.count("Exchange hashpartitioning")


STAGES = ("itemized", "history", "merged", "net_sales", "payout_snapshot", "payout_level", "event_level", "balance")


@pytest.mark.parametrize("stage", STAGES)
def test_not_in_joins_on_the_key_itself(spark, written, stage):
    from settlebook.plans import FIXTURE, close_period
    plan = getattr(close_period(written, FIXTURE), stage)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(coalesce(" not in plan


def test_payout_cutoffs_reach_the_scan_of_the_log(spark, written):
    from settlebook.plans import FIXTURE, payout_snapshot
    df = payout_snapshot(written.history_payouts, written.payouts, written.manual_voids, FIXTURE)
    plan = executed(df)
    scans = [line for line in plan.splitlines() if "history_payouts" in line and "payout_type" in line.split("ReadSchema")[-1]]
    assert scans and all("LessThan(changed," in line for line in scans)
    assert shuffles(plan) <= 4


def test_itemized_shuffles(spark, written):
    from settlebook.plans import FIXTURE, itemized_net_sales
    x = written
    df = itemized_net_sales(x.order_itemizations, x.orders, x.events, x.users, x.event_exclusions, x.prior_event_level,
                            x.transfer_orders, FIXTURE)
    assert shuffles(executed(df)) <= 12


def test_history_window_is_limited_map_side(spark):
    plan = plan_of(spark, "latest_row")
    assert "WindowGroupLimit" in plan


def test_scans_are_pruned(spark):
    plan = plan_of(spark, "multi_processor_events")
    schemas = [line for line in plan.splitlines() if "orders.parquet" in line or "o_orderkey" in line]
    assert schemas and all("o_orderdate" not in line for line in schemas)
