"""Stream operators on small batches with nulls, large integers and short watermark delays."""

import os
import tempfile
import time

import pandas as pd
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import joins, state
from tidewater.streaming import ops
from tidewater.streaming.processors import RollingFields
from tidewater.streaming.run import run_available_now

from .conftest import JOIN_LEFT, JOIN_RIGHT


def stream(spark, batches, schema):
    """A stream of the batches, one micro-batch each, and all their rows as a table."""
    d = tempfile.mkdtemp(prefix="tw-nulls-")
    now = time.time() - 100
    for i, part in enumerate(batches):
        df = spark.createDataFrame(part, schema)
        df.coalesce(1).write.parquet(f"{d}/f{i}")
        for f in os.listdir(f"{d}/f{i}"):
            os.utime(f"{d}/f{i}/{f}", (now + i * 10, now + i * 10))
    src = (spark.readStream.schema(df.schema).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", 1).parquet(d))
    return src, spark.createDataFrame([r for part in batches for r in part], schema)


def got(spark, df, name):
    run_available_now(df, f"n_{name}_{time.time_ns()}", sink="memory").stop()
    table = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"n_{name}_")][-1]
    return sorted((tuple(r) for r in spark.table(table).collect()), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_running_extremes_keep_their_state_over_nulls():
    for kind, values, want in (("max", [[10], [5, None], [1]], [[10], [10, 10], [10]]),
                               ("min", [[3], [None, 7], [None]], [[3], [3, 3], [3]])):
        seen, acc, out = False, None, []
        for part in values:
            s, acc = RollingFields._running(kind, pd.Series(part, dtype="float64"), seen, acc)
            seen = True
            out.append(s.tolist())
        assert out == want


PARTS = [[("a", 1, 50.0), ("a", 2, None), ("b", 3, None)], [("a", 4, 50.0), ("b", 5, 7.0), ("a", 6, None)],
         [("a", 7, 1.0), ("b", 8, None), ("b", 9, 4.0)]]
SCHEMA = "k string, seq long, v double"


def test_jump_alert_with_nulls(spark):
    src, all_ = stream(spark, PARTS, SCHEMA)
    a = got(spark, ops.jump_alert(src, ["k"], ["seq"], "v", 10, 0), "jump")
    assert a == rows(state.value_jump_alert(all_, ["k"], ["seq"], "v", 10, 0).select("k", "seq", "v", "prev"))


def test_trigger_counts_rows(spark):
    src, all_ = stream(spark, [[("a", 1, None), ("a", 2, 1.0)], [("a", 3, 1.0), ("a", 4, None), ("a", 5, 1.0)]], SCHEMA)
    a = ops.running_sum(src, ["k"], ["seq"], "v", every=2)
    assert [r[1] for r in got(spark, a, "every")] == [2, 4]


def test_extreme_rows_of_large_integers_and_nulls(spark):
    big = 2 ** 53
    src, all_ = stream(spark, [[("a", 1, None), ("a", 2, big)], [("a", 3, big + 1), ("a", 4, None)], [("a", 5, big)]],
                       "k string, seq long, v long")
    for largest in (True, False):
        a = got(spark, ops.extreme_row(src, ["k"], ["seq"], "v", ["seq", "v"], largest), f"ext{int(largest)}")
        b = agg.extreme_row(all_, ["k"], ["seq"], "v", ["seq", "v"], largest=largest, rolling_=True)
        assert a == rows(b.select("k", "at_seq", "seq", "v"))


def test_window_join_keeps_rows_of_open_windows(spark):
    day = 86_400.0
    ts = lambda df, c: df.withColumn(c, F.timestamp_millis((F.col(c) * 1000).cast("long")))
    left, la = stream(spark, [[("a", 0.6 + day, "new")], [("a", day - 0.1, "late in its window")], [("a", 3 * day, "far")]],
                      "k string, l_ts double, l string")
    right, ra = stream(spark, [[("a", day - 5, "r")], [("a", day + 1, "r2")], [("a", 3 * day, "far")]],
                       "k string, r_ts double, r string")
    out = ops.window_join(ts(left, "l_ts"), ts(right, "r_ts"), ["k"], "l_ts", "r_ts", "1 day", "1 second")
    pairs = {(r[3], r[4]) for r in got(spark, out, "wj")}
    assert ("late in its window", "r") in pairs and ("new", "r2") in pairs and ("far", "far") in pairs and len(pairs) == 3


def test_window_join_on_the_literal_times(spark):
    left, la = stream(spark, [JOIN_LEFT], "seq int, k string, t bigint")
    right, ra = stream(spark, [JOIN_RIGHT], "seq int, k string, t2 bigint, p string")
    lt = lambda df: df.select("k", F.timestamp_seconds("t").alias("lt"), F.col("seq").alias("l"))
    rt = lambda df: df.select("k", F.timestamp_seconds("t2").alias("rt"), F.col("seq").alias("r"))
    a = got(spark, ops.window_join(lt(left), rt(right), ["k"], "lt", "rt", "5 seconds", "1 second"), "lit")
    b = joins.window_join(lt(la), rt(ra), ["k"], "lt", "rt", "5 seconds").drop("lt", "rt")
    assert len(a) == 17 and a == rows(b)


def test_joins_with_time_columns_of_one_name(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 3), ("a", 3, 90)], "k string, id int, s long").select(
        "k", "id", F.timestamp_seconds("s").alias("ts"))
    w = joins.window_join(df, df, ["k"], "ts", "ts", "1 minute")
    assert w.columns == ["k", "window_start", "window_end", "id", "ts", "right_id", "right_ts"]
    assert sorted((r.id, r.right_id) for r in w.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 3)]
    i = joins.interval_join(df, df, ["k"], "ts", "ts", 0, 5)
    assert sorted((r.id, r.right_id) for r in i.collect()) == [(1, 1), (1, 2), (2, 2), (3, 3)]
