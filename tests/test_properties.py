"""Property tests: operators against brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from settlebook.operators import latest_as_of, not_in

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
small = st.one_of(st.none(), st.integers(min_value=0, max_value=5))


@SETTINGS
@given(left=st.lists(small, max_size=8), right=st.lists(small, max_size=6))
def test_not_in_equals_sql_semantics(spark, left, right):
    l = spark.createDataFrame([(v,) for v in left], "x bigint")
    r = spark.createDataFrame([(v,) for v in right], "k bigint")
    got = sorted(map(repr, (row.x for row in not_in(l, "x", r).collect())))
    if not right:
        want = left
    elif None in right:
        want = []
    else:
        want = [v for v in left if v is not None and v not in right]
    assert got == sorted(map(repr, want))


rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 3), st.sampled_from([100, 200, 350])),
                max_size=15)


@SETTINGS
@given(data=rows)
def test_latest_as_of_equals_brute_force(spark, data):
    # (key, day, log_position, status); make (key, day, log_position) unique
    uniq = {}
    for k, d, lp, s in data:
        uniq[(k, d, lp)] = s
    recs = [(k, dt.datetime(2024, 1, 1 + d), lp, s) for (k, d, lp), s in uniq.items()]
    df = spark.createDataFrame(recs, "k bigint, changed timestamp_ntz, log_position bigint, status int")
    got = sorted(tuple(r) for r in latest_as_of(
        df, ["k"], ["changed", "log_position"], where=F.col("status") != 200, then=F.col("status") == 100).collect())
    best = {}
    for k, c, lp, s in recs:
        if s == 200:
            continue
        if k not in best or (c, lp) > best[k][1:3]:
            best[k] = (k, c, lp, s)
    want = sorted(v for v in best.values() if v[3] == 100)
    assert got == want
