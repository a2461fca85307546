"""Hot-key splitting must not change results: every running operator is run
with a tiny hot-key threshold (so keys and the whole stream are split into
ordered chunks with carried-in state) and compared to the unsplit scan."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import late, scan, state, windows

from .conftest import SF_SMALL, rows

KEY, ORDER = ["user_id"], ["ts", "event_id"]
HOT = 20          # sf0.001: 15 users with up to 88 rows each -> every key is hot


@pytest.fixture(scope="module")
def ev(spark):
    return (spark.read.parquet(f"{SF_SMALL}/events.parquet")
            .withColumn("value", F.col("value").cast("decimal(18,2)")))


def test_plan_finds_hot_keys(ev):
    plan = scan.plan_chunks(ev, KEY, ORDER, hot_rows=HOT)
    assert plan is not None and plan.bounds.count() >= 2
    chunked = scan.with_chunks(ev, KEY, plan)
    assert chunked.select(scan.CHUNK).distinct().count() > 1
    assert scan.plan_chunks(ev, KEY, ORDER, hot_rows=10**9) is None
    assert scan.plan_chunks(ev, KEY, ORDER, hot_rows=0) is None      # switched off


def test_rows_tied_on_the_first_order_column_are_split(spark):
    # one key, every row at the same time: only the tiebreak orders them
    df = spark.range(0, 200, 1, 4).select(F.lit("k").alias("k"), F.lit(0).alias("t"),
                                          F.col("id"), (F.col("id") % 7).alias("v"))
    plan = scan.plan_chunks(df, ["k"], ["t", "id"], hot_rows=20)
    chunks = scan.with_chunks(df, ["k"], plan).select(scan.CHUNK).distinct().count()
    assert chunks >= 5
    a = agg.rolling(df, ["k"], ["t", "id"], {"s": ("sum", "v")}, hot_rows=20)
    b = agg.rolling(df, ["k"], ["t", "id"], {"s": ("sum", "v")}, hot_rows=10**9)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("kind", ["sum", "count", "max", "min", "first", "last"])
def test_rolling_fields(ev, kind):
    fields = {"x": (kind, "value")}
    a = agg.rolling(ev, KEY, ORDER, fields, hot_rows=HOT)
    b = agg.rolling(ev, KEY, ORDER, fields, hot_rows=10**9)
    assert rows(a) == rows(b)


def test_rolling_max_by(ev):
    cols = ["event_id", "value"]
    a = agg.extreme_row(ev, KEY, ORDER, "value", cols, rolling_=True, hot_rows=HOT)
    b = agg.extreme_row(ev, KEY, ORDER, "value", cols, rolling_=True, hot_rows=10**9)
    assert rows(a) == rows(b)


def test_running_topk(ev):
    a = state.running_topk(ev, KEY, ORDER, "value", k=3, hot_rows=HOT)
    b = state.running_topk(ev, KEY, ORDER, "value", k=3, hot_rows=10**9)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("refresh", ["read_write", "create_write"])
def test_ttl(ev, refresh):
    w = F.col("value") > 100
    a = state.ttl_value(ev, KEY, ORDER, "ts", "value", 6 * 3600, w, refresh, hot_rows=HOT)
    b = state.ttl_value(ev, KEY, ORDER, "ts", "value", 6 * 3600, w, refresh, hot_rows=10**9)
    assert rows(a) == rows(b)


def test_jump_alert(ev):
    a = state.value_jump_alert(ev, KEY, ORDER, "value", hot_rows=HOT)
    b = state.value_jump_alert(ev, KEY, ORDER, "value", hot_rows=10**9)
    assert rows(a) == rows(b)


def test_count_windows(ev):
    a = windows.count_sliding(ev, KEY, ORDER, 5, 2, {"s": F.sum("value")}, hot_rows=HOT)
    b = windows.count_sliding(ev, KEY, ORDER, 5, 2, {"s": F.sum("value")}, hot_rows=10**9)
    assert rows(a) == rows(b)


def test_whole_stream_late_rows(ev):
    perm = ev.withColumn("arrival", F.floor(F.col("event_id") / 10) * 10
                         + F.pmod(F.col("event_id") * 7, F.lit(10)))
    a = late.flag_late(perm, "ts", ["arrival"], 600, hot_rows=HOT)
    b = late.flag_late(perm, "ts", ["arrival"], 600, hot_rows=10**9)
    assert rows(a) == rows(b)
    assert a.filter("is_late").count() > 0


def test_session_windows_hot_path(ev):
    aggs = {"n": F.count(F.lit(1)), "s": F.sum("value")}
    a = windows.session(ev, KEY, "ts", "30 minutes", aggs, tiebreak=["event_id"], hot_rows=HOT)
    b = windows.session(ev, KEY, "ts", "30 minutes", aggs, hot_rows=10**9)
    assert rows(a) == rows(b)


def test_exact_quantile_matches_percentile(ev):
    dv = ev.withColumn("value", F.col("value").cast("double"))
    for q in (0.5, 0.25, 0.9):
        a = agg.exact_quantile(dv, ["event_type"], "value", q, hot_rows=HOT)
        b = dv.groupBy("event_type").agg(F.percentile("value", q).alias("quantile"))
        got = dict(rows(a))
        for k, v in rows(b):
            assert abs(got[k] - v) < 1e-9


def test_whole_stream_scans_share_one_plan(ev):
    a = state.running_topk(ev, [], ORDER, "value", 3, hot_rows=HOT)
    b = state.running_topk(ev, [], ORDER, "value", 3, hot_rows=10**9)
    assert rows(a) == rows(b)
    w = F.col("value") > 100
    a = state.ttl_value(ev, [], ORDER, "ts", "value", 3600, w, hot_rows=HOT)
    b = state.ttl_value(ev, [], ORDER, "ts", "value", 3600, w, hot_rows=10**9)
    assert rows(a) == rows(b)
    aggs = {"n": F.count(F.lit(1))}
    a = windows.session(ev, [], "ts", "30 minutes", aggs, tiebreak=["event_id"], hot_rows=HOT)
    b = windows.session(ev, [], "ts", "30 minutes", aggs, hot_rows=10**9)
    assert rows(a) == rows(b)


def test_two_level_chunk_lookup_matches_brute_force(spark):
    df = spark.range(0, 1000, 1, 6).select(F.lit("k").alias("k"), (F.col("id") % 97).alias("t"),
                                           F.col("id"))
    plan = scan.plan_chunks(df, ["k"], ["t", "id"], hot_rows=7)
    bounds = [tuple(b) for b in plan.bounds.first()[scan.BOUNDS]]
    assert len(bounds) > 100
    got = scan.with_chunks(df, ["k"], plan).select("t", "id", scan.CHUNK).collect()
    for r in got:
        assert r[scan.CHUNK] == sum(1 for b in bounds if b < (r.t, r.id))


def test_sampled_detection_path(spark):
    from .conftest import SF_CHECK
    ev = spark.read.parquet(f"{SF_CHECK}/events.parquet")   # 10 000 rows
    perm = ev.withColumn("arrival", F.floor(F.col("event_id") / 100) * 100
                         + F.pmod(F.col("event_id") * 37, F.lit(100)))
    plan = scan.plan_chunks(perm, ["event_type"], ["arrival"],
                            hot_rows=1000)
    assert plan is not None          # every event type holds ~2000 rows
    a = late.flag_late(perm, "ts", ["arrival"], 3600, hot_rows=1000)
    b = late.flag_late(perm, "ts", ["arrival"], 3600, hot_rows=10**9)
    assert rows(a) == rows(b) and a.filter("is_late").count() > 0
    c = state.running_topk(ev, [], ORDER, "value", 3, hot_rows=1000)
    d = state.running_topk(ev, [], ORDER, "value", 3, hot_rows=10**9)
    assert rows(c) == rows(d)
    whole = scan.plan_chunks(ev.withColumn(scan.ALL, F.lit(0)), [scan.ALL], ORDER)
    assert whole is not None         # a whole-stream scan is split at any size
    chunked = scan.with_chunks(ev.withColumn(scan.ALL, F.lit(0)), [scan.ALL], whole)
    assert chunked.select(scan.CHUNK).distinct().count() > 2


def test_whole_stream_scan_by_ranges(spark, ev, monkeypatch):
    """The tree of carries: more levels than one, chunks without rows, types and rows as unsplit."""
    from tidewater.operators import late
    outputs = {"s": scan.running_sum("value"), "n": scan.running_count(), "b": scan.running_count(inclusive=False),
               "m": scan.running_max("value", inclusive=False), "p": scan.last_value("event_type", ORDER, inclusive=False)}
    few = ev.select("event_id", "ts", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    want = scan.keyed_prefix(few, [], ORDER, outputs, hot_rows=0)
    for fan, parts in ((1024, "4"), (2, "7"), (3, "40")):
        monkeypatch.setattr(scan, "CARRY_FAN", fan)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = scan.keyed_prefix(few, [], ORDER, outputs)
            assert got.schema == want.schema and rows(got) == rows(want)
            tiny = scan.keyed_prefix(few.limit(3), [], ORDER, outputs)
            assert sorted(r.n for r in tiny.collect()) == [1, 2, 3]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert scan.keyed_prefix(few.limit(0), [], ORDER, outputs).count() == 0
    flagged = late.flag_late(ev.withColumn("arrival", F.col("event_id")), "ts", ["arrival"], 3600)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("k", [1, 2, 4])
def test_topk_in_chunks(spark, k):
    df = spark.range(0, 900, 1, 3).select(
        F.when(F.col("id") % 13 != 0, F.col("id") % 2).alias("k"), F.col("id").alias("t"),
        F.when(F.col("id") % 7 != 0, F.pmod(F.col("id") * 7919, F.lit(101)).cast("double")).alias("v"))
    want = state.running_topk(df, ["k"], ["t"], "v", k, hot_rows=0)
    seen, brute = {}, []
    for r in sorted(df.collect(), key=lambda r: r.t):
        seen.setdefault(r.k, []).extend([] if r.v is None else [r.v])
        brute.append((r.k, r.t, r.v, sorted(seen[r.k], reverse=True)[:k]))
    for hot in (0, 8, 100):
        got = state.running_topk(df, ["k"], ["t"], "v", k, hot_rows=hot)
        assert got.schema == want.schema
        assert sorted((r.k, r.t, r.v, list(r.top)) for r in got.collect() if r.k is not None) == sorted(
            b for b in brute if b[0] is not None)
        assert sorted((r.t, list(r.top)) for r in got.collect() if r.k is None) == sorted(
            (b[1], b[3]) for b in brute if b[0] is None)
    split = state.running_topk(df, ["k"], ["t"], "v", k, hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert split.count("Range (") <= 2                  # the input is read twice, whatever k is


def test_null_keys_are_split_and_types_are_the_same(spark):
    df = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 3).alias("k"), F.col("id").alias("t"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 11).cast("decimal(18,2)")).alias("v"))
    plan = scan.plan_chunks(df, ["k"], ["t"], hot_rows=100)
    chunked = scan.with_chunks(df, ["k"], plan)
    assert chunked.filter("k is null").select(scan.CHUNK).distinct().count() > 5
    fields = {"s": ("sum", "v"), "m": ("max", "v"), "f": ("first", "v"), "n": ("count", "v")}
    a = agg.rolling(df, ["k"], ["t"], fields, hot_rows=100)
    b = agg.rolling(df, ["k"], ["t"], fields, hot_rows=0)
    assert a.schema == b.schema
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    c = windows.count_sliding(df, ["k"], ["t"], 5, 2, {"s": F.sum("v")}, hot_rows=100)
    d = windows.count_sliding(df, ["k"], ["t"], 5, 2, {"s": F.sum("v")}, hot_rows=0)
    assert c.schema == d.schema and sorted(map(repr, c.collect())) == sorted(map(repr, d.collect()))


def test_quantile_keeps_null_groups_and_groups_of_nulls(spark):
    rows_ = [(1, 1.0), (1, 2.0), (1, 5.0), (None, 1.0), (None, 3.0), (2, None), (2, None)]
    df = spark.createDataFrame(rows_, "k int, v double")
    for hot in (0, 1, 4, 10**9):
        got = agg.exact_quantile(df, ["k"], "v", hot_rows=hot)
        assert sorted(map(tuple, got.collect()), key=repr) == [(1, 2.0), (2, None), (None, 2.0)]


def test_sessions_skip_rows_without_a_time(spark):
    df = spark.createDataFrame([("a", 0), ("a", 4), ("a", None), (None, 1), (None, 100), ("b", None)], "k string, s int")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    out = [windows.session(df, ["k"], "ts", "5 seconds", {"n": F.count(F.lit(1))}, hot_rows=h) for h in (4, 0)]
    assert out[0].schema == out[1].schema
    got = [sorted((r.k or "", r.window_start, r.window_end, r.n) for r in o.collect()) for o in out]
    assert got[0] == got[1] and [g[3] for g in got[0]] == [1, 1, 2]


def test_extreme_row_skips_nulls_and_orders_by_text(spark):
    df = spark.createDataFrame([("a", "x1", 5), ("a", "x2", None), ("a", "x3", 4), ("a", "x4", 5), ("b", "y", None)],
                               "k string, o string, v int")
    for hot in (4, 0):
        hi = agg.extreme_row(df, ["k"], ["o"], "v", ["o", "v"], largest=True, hot_rows=hot)
        lo = agg.extreme_row(df, ["k"], ["o"], "v", ["o", "v"], largest=False, hot_rows=hot)
        assert sorted(map(tuple, hi.collect())) == [("a", "x1", 5), ("b", "y", None)]
        assert sorted(map(tuple, lo.collect())) == [("a", "x3", 4), ("b", "y", None)]
        roll = agg.extreme_row(df, ["k"], ["o"], "v", ["o", "v"], largest=False, rolling_=True, hot_rows=hot)
        assert sorted((r.at_o, r.o, r.v) for r in roll.collect()) == [
            ("x1", "x1", 5), ("x2", "x1", 5), ("x3", "x3", 4), ("x4", "x3", 4), ("y", "y", None)]


def test_descending_text(spark):
    from tidewater.functions.core import descending
    words = ["", "a", "ab", "b", "aa", "é", "z", "ba", "漢"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.w for r in df.orderBy(descending(df, "w")).collect()]
    assert got == [r.w for r in df.orderBy(F.desc("w")).collect()]


def test_user_reduce(ev):
    longest = scan.Monoid(F.max, F.max, lambda c, l: F.greatest(c, l))
    a = agg.reduce_with(ev, KEY, ORDER, {"m": (longest, "value"), "s": (scan.SUM, "value")}, rolling_=True, hot_rows=HOT)
    b = agg.rolling(ev, KEY, ORDER, {"m": ("max", "value"), "s": ("sum", "value")}, hot_rows=0)
    assert rows(a) == rows(b) and a.schema == b.schema
    c = agg.reduce_with(ev, KEY, ORDER, {"m": (longest, "value")})
    assert rows(c) == rows(ev.groupBy(*KEY).agg(F.max("value").alias("m")))


def test_predicate_trigger_and_full_window(ev):
    total = {"total": scan.running_sum("value")}
    a = windows.global_when(ev, KEY, ORDER, F.col(windows.RN) % 5 == 0, total, hot_rows=HOT)
    b = windows.global_every(ev, KEY, ORDER, 5, total, hot_rows=0)
    assert rows(a.select(*KEY, "fire_at", "total")) == rows(b)
    out = windows.full_window(ev, ["event_type"], "ts", "1 day", {"n": F.count(F.lit(1)), "hi": F.max("value")},
                              {"mid": ("value", 0.5)}, hot_rows=HOT)
    want = windows.tumbling(ev, ["event_type"], "ts", "1 day", {
        "n": F.count(F.lit(1)), "hi": F.max("value"), "mid": F.percentile("value", 0.5)})
    assert out.columns == want.columns and rows(out.withColumn("mid", F.round("mid", 9))) == rows(
        want.withColumn("mid", F.round("mid", 9)))


def test_map_state_snapshots(spark):
    df = spark.range(0, 300, 1, 3).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"),
                                          F.when(F.col("id") % 7 != 0, F.pmod(F.col("id") * 31, F.lit(5)).cast("string")).alias("v"))
    seen, want = {}, []
    for r in sorted(df.collect(), key=lambda r: r.t):
        m = seen.setdefault(r.k, {})
        if r.v is not None and r.v != "4":
            m[r.v] = m.get(r.v, 0) + 1
        want.append((r.k, r.t, r.v, dict(m)))
    for hot in (0, 8, 60):
        got = state.value_maps_rolling(df, ["k"], ["t"], "v", ["0", "1", "2", "3", "none", None], hot_rows=hot)
        assert sorted(((r.k, r.t, r.v, r.counts) for r in got.collect()), key=lambda r: r[1]) == want
    none = state.value_maps_rolling(df, ["k"], ["t"], "v", [])
    assert none.schema["counts"].dataType == got.schema["counts"].dataType and none.first().counts == {}
    with pytest.raises(ValueError):
        state.value_maps_rolling(df, ["k"], ["t"], "v", list(range(state.MAP_VALUES + 1)))
