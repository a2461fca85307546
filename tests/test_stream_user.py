"""Streams with user code: the same rows as the batch forms over micro-batches out of order."""

import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tidewater.operators import accumulate as acc
from tidewater.operators import grouped, joins, windows
from tidewater.streaming import user
from tidewater.streaming.run import checkpoint_for

from .test_grouped import trimmed_mean
from .test_stream_nulls import got, rows, stream

BASE = 1_500_000_000
FAR = 9_000_000


def subtract(a, b):
    return {"v": (a["v"] or 0) - (b["v"] or 0)}


BATCHES = [[("a", 1, 5), ("b", 2, 2 ** 53 + 1), (None, 3, 1)], [("a", 4, None), ("a", 5, 7), ("b", 6, None)], [(None, 7, 3), ("a", 8, 1)]]


def test_ordered_reduce(spark):
    src, whole = stream(spark, BATCHES, "k string, t long, v long")
    out = got(spark, user.reduce_ordered(src, ["k"], ["t"], ["v"], subtract), "reduce")
    assert out == rows(grouped.reduce_ordered(whole, ["k"], ["t"], ["v"], subtract, rolling_=True))


def test_trigger_between_the_rows_of_a_batch(spark):
    src, whole = stream(spark, BATCHES, "k string, t long, v long")
    args = (["k"], ["t"], ["v"], lambda: 0, lambda s, r: s + (r["v"] or 0), lambda r, s, n: n % 2 == 0 or (r["v"] or 0) == 7,
            lambda s: {"total": s}, "total long")
    out = got(spark, user.global_when(src, *args), "trigger")
    want = windows.global_when(whole, ["k"], ["t"], (F.col(windows.RN) % 2 == 0) | F.coalesce(F.col("v") == 7, F.lit(False)),
                               {"total": windows.scan.running_sum("v")}, hot_rows=0)
    assert out == rows(want)


def test_map_state_after_each_row(spark):
    batches = [[("a", 1, "x"), ("a", 2, "y"), ("b", 3, "x")], [("a", 4, "x"), ("a", 5, None)]]
    src, whole = stream(spark, batches, "k string, t long, v string")
    out = got(spark, user.value_maps(src, ["k"], ["t"], "v"), "maps")
    assert [(k, t, dict(m)) for k, t, m in out] == [
        ("a", 1, {"x": 1}), ("a", 2, {"x": 1, "y": 1}), ("a", 4, {"x": 2, "y": 1}), ("a", 5, {"x": 2, "y": 1}), ("b", 3, {"x": 1})]


def _timed(df):
    return df.withColumn("ts", F.timestamp_seconds(F.col("s") + BASE))


def test_accumulators_over_merging_sessions(spark):
    """Out-of-order rows open sessions, bridge two, and prolong one on either side."""
    batches = [[("a", 100, 1), ("a", 112, 2), ("b", 100, 50)],
               [("a", 106, 4), ("a", 94, 8), ("b", 130, 60)],             # 106 bridges 100 and 112
               [("a", 140, 16), (None, 139, None), ("b", 125, 70), ("a", None, 5)],
               [("a", 500, 32), ("b", 501, 80)],
               [("a", 100, 1000)],                                         # late: its session has closed
               [("z", FAR, 0)], [("z", FAR + 1, 0)]]
    src, whole = stream(spark, batches, "k string, s long, v long")
    args = ("6 seconds", acc.sum_as_text("v"), ["v"], "total", "string")
    out = got(spark, user.session_accumulate(_timed(src), ["k"], "ts", args[0], "60 seconds", *args[1:]), "sessions")
    on_time = whole.filter("coalesce(v, 0) <> 1000 and (k is null or k <> 'z')")
    want = rows(windows.session_accumulate(_timed(on_time), ["k"], "ts", *args))
    assert len(want) == 7 and out == want


def test_full_window_function(spark):
    batches = [[("a", 10 * k % 97, k) for k in range(30)], [("b", 50, 7), ("a", 3, 1000), ("a", None, 5)], [("z", FAR, 0)], [("z", FAR + 1, 0)]]
    src, whole = stream(spark, batches, "k string, s long, value long")
    args = (["value", "s"], trimmed_mean, "mean double, n long")
    out = got(spark, user.process_window(_timed(src), ["k"], "ts", "50 seconds", "200 seconds", *args), "process")
    want = rows(windows.process_window(_timed(whole.filter("k <> 'z'")), ["k"], "ts", "50 seconds", *args))
    assert len(want) == 3 and out == want


def test_cogroup_function(spark):
    left, l = stream(spark, [[("a", 1, 5), ("a", 12, 6)], [("b", 3, None)], [("z", FAR, 0)], [("z", FAR + 1, 0)]], "k string, s long, v long")
    right, r = stream(spark, [[("a", 2, "x")], [("a", 1, "y"), ("c", 30, "q")], [("z", FAR, "")], [("z", FAR + 1, "")]], "k string, s long, v string")

    def fn(key, one, two):
        yield {"l": [x["v"] for x in grouped.rows_of(one, ["v"])], "r": [x["v"] for x in grouped.rows_of(two, ["v"])]}

    args = (["s"], ["s"], fn, "l array<bigint>, r array<string>")
    out = got(spark, user.window_cogroup_process(_timed(left), _timed(right), ["k"], "ts", "ts", "10 seconds", "100 seconds", *args), "cogroup")
    keep = "k <> 'z'"
    want = rows(joins.window_cogroup_process(_timed(l.filter(keep)), _timed(r.filter(keep)), ["k"], "ts", "ts", "10 seconds", *args))
    assert len(want) == 4 and [x for x in out if x[0] != "z"] == want


@pytest.mark.parametrize("slide", [None, "1 second"])
def test_processing_time_windows_close(spark, slide):
    """Windows fire once their end has passed on the clock, with all rows of their batches, and are cleared."""
    src, _ = stream(spark, [[("a", 1), ("a", 2), (None, 5)], [("a", 4), ("b", None)], [("a", 8)]], "k string, v long")
    name = f"closing_{time.time_ns()}"
    out = user.processing_window(src, ["k"], "2 seconds", acc.sum_as_text("v"), ["v"], "total", "string", slide)
    q = (out.writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", checkpoint_for(spark, name)).trigger(processingTime="500 milliseconds").start())
    copies = 2 if slide else 1
    want = {"a": 15 * copies, "": 5 * copies, "b": 0}
    end = time.time() + 90
    totals = {}
    while time.time() < end and totals != want:
        time.sleep(1)
        totals = {}
        for r in spark.table(name).collect():
            totals[r.k or ""] = totals.get(r.k or "", 0) + int(r.total)
    done = spark.table(name).collect()
    state = (q.lastProgress or {})["stateOperators"][0]["numRowsTotal"]
    q.stop()
    assert totals == want
    width = {(r.window_end - r.window_start).total_seconds() for r in done}
    step = 1 if slide else 2
    assert width == {2.0} and all(r.window_start.second % step == 0 for r in done)
    assert len({(r.k, r.window_start) for r in done}) == len(done)       # each window fires once
    assert state == 0
