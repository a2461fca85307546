"""Properties: results do not depend on parallelism, and the running
operators equal a brute-force replay of per-key state on random inputs."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import late, state, windows
from tidewater.plans.queries import QUERIES

from .conftest import SF_SMALL, rows


def _canon(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else
                         (tuple(v) if isinstance(v, list) else v) for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result_independent_of_shuffle_partitions(spark, name):
    q = QUERIES[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _canon(q(spark, SF_SMALL))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        seven = _canon(q(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == seven


def _replay(events):
    """Brute force: walk each key's rows in order with plain Python state."""
    by_key = defaultdict(list)
    for seq, k, v in events:
        by_key[k].append((seq, v))
    out = {}
    for k, items in by_key.items():
        items.sort()
        total, top, prev, n = 0, [], None, 0
        for seq, v in items:
            n += 1
            total += v
            before = prev
            prev = v
            top = sorted(top + [v], reverse=True)[:3]
            out[seq] = (total, list(top), before, n)
    return out


rows_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                                   st.integers(min_value=-20, max_value=20)),
                         min_size=1, max_size=40)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows_strategy, hot=st.sampled_from([3, 10**9]))
def test_running_state_against_brute_force(spark, data, hot):
    events = [(i, k, v) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(events, "seq int, k string, v int")
    want = _replay(events)
    run = agg.rolling(df, ["k"], ["seq"], {"s": ("sum", "v"), "n": ("count", "v")},
                      hot_rows=hot)
    for r in run.collect():
        assert (r.s, r.n) == (want[r.seq][0], want[r.seq][3])
    top = state.running_topk(df, ["k"], ["seq"], "v", 3, hot_rows=hot)
    for r in top.collect():
        assert r.top == want[r.seq][1]
    alerts = state.value_jump_alert(df, ["k"], ["seq"], "v", threshold=10, hot_rows=hot)
    expect = sorted(seq for seq, (_, _, before, _) in want.items()
                    if abs([v for s, _, v in events if s == seq][0] - (before or 0)) > 10)
    assert sorted(r.seq for r in alerts.collect()) == expect


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=40),
       hot=st.sampled_from([4, 10**9]))
def test_count_windows_and_late_rows_against_brute_force(spark, data, hot):
    df = (spark.createDataFrame([(i, "k", t) for i, t in enumerate(data)],
                                "seq int, k string, t int")
          .withColumn("et", F.timestamp_seconds("t")))
    slide = windows.count_sliding(df, ["k"], ["seq"], 5, 2, {"s": F.sum("t")}, hot_rows=hot)
    want = [(i, sum(data[max(0, i - 5):i])) for i in range(2, len(data) + 1, 2)]
    assert rows(slide, "fire_at", "s") == want
    flagged = late.flag_late(df, "et", ["seq"], 3, hot_rows=hot)
    expect, top = [], None
    for i, t in enumerate(data):
        if top is not None and t < top - 3:
            expect.append(i)
        top = t if top is None else max(top, t)
    assert sorted(r.seq for r in flagged.filter("is_late").collect()) == expect


def _ttl_replay(items, ttl, refresh):
    """Plain replay of a value cell with time-to-live (event time as clock)."""
    value, touched, out = None, None, []
    for t, v in items:
        alive = value is not None and t - touched < ttl
        out.append(value if alive else None)
        if not alive:
            value = None
        elif refresh == "read_write":
            touched = t
        if v > 10:
            value, touched = v, t
    return out


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(gaps=st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=30),
       vals=st.lists(st.integers(min_value=0, max_value=20), min_size=30, max_size=30),
       refresh=st.sampled_from(["read_write", "create_write"]),
       hot=st.sampled_from([3, 10**9]))
def test_ttl_against_brute_force(spark, gaps, vals, refresh, hot):
    times = [sum(gaps[:i + 1]) for i in range(len(gaps))]
    items = list(zip(times, vals))
    df = (spark.createDataFrame([(i, "k", t, v) for i, (t, v) in enumerate(items)],
                                "seq int, k string, t int, v int")
          .withColumn("et", F.timestamp_seconds("t")))
    got = state.ttl_value(df, ["k"], ["seq"], "et", "v", 5, F.col("v") > 10,
                          refresh=refresh, hot_rows=hot)
    assert [r.state for r in got.orderBy("seq").collect()] == _ttl_replay(items, 5, refresh)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b"]),
                               st.integers(min_value=-50, max_value=50)),
                     min_size=2, max_size=60),
       q=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_against_numpy(spark, data, q):
    import numpy as np
    df = spark.createDataFrame(data, "k string, v int").withColumn("v", F.col("v").cast("double"))
    got = dict(rows(agg.exact_quantile(df, ["k"], "v", q, hot_rows=3)))   # distributed path
    for k in {k for k, _ in data}:
        want = float(np.percentile([v for kk, v in data if kk == k], q * 100))
        assert abs(got[k] - want) < 1e-9
