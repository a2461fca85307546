"""Stream goldens from the reference's literal inputs (FIXTURES F5, F7, F10).

Event times are the fixture seconds shifted by ``BASE`` (a multiple of the 3 s
and 5 s window steps, so windows keep their alignment): a stream-stream join
treats rows at or before the initial watermark (epoch 0) as late, which
would swallow the fixture's first windows."""

import tempfile

from pyspark.sql import functions as F

from tidewater.streaming import ops, user
from tidewater.streaming.run import run_available_now

from .conftest import JOIN_LEFT, JOIN_RIGHT, URLS
from .test_windows_joins import both_lists

BASE = 1_500_000_000


def _at(col):
    return F.timestamp_seconds(F.col(col) + F.lit(BASE))


def _stream_of(spark, rows, ddl, name):
    d = tempfile.mkdtemp(prefix=f"tw-golden-{name}-")
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{d}/a")
    return spark.readStream.schema(ddl).parquet(f"{d}/a")


def _run(df, name):
    run_available_now(df, name, checkpoint=tempfile.mkdtemp(prefix="tw-golden-ckpt-"))
    return df.sparkSession.table(name)


def _sides(spark):
    left = (_stream_of(spark, JOIN_LEFT, "seq int, k string, t bigint", "l")
            .select("k", "t", _at("t").alias("lt")))
    right = (_stream_of(spark, JOIN_RIGHT, "seq int, k string, t2 bigint, p string", "r")
             .select(F.col("k").alias("k"), "t2", "p", _at("t2").alias("rt")))
    return left, right


def test_f5_stream_window_join_17_pairs(spark):
    left, right = _sides(spark)
    out = _run(ops.window_join(left, right, ["k"], "lt", "rt", "5 seconds", "1 second"),
               "g_f5")
    assert sorted((r.k, r.cnt) for r in out.groupBy("k").agg(F.count(F.lit(1)).alias("cnt"))
                  .collect()) == [("a", 12), ("b", 4), ("e", 1)]


def test_f7_stream_interval_join_10_rows(spark):
    left, right = _sides(spark)
    out = _run(ops.interval_join(left, right, ["k"], "lt", "rt", -1, 1, "1 second"), "g_f7")
    assert sorted((r.k, r.t, r.t2, r.p) for r in out.collect()) == [
        ("a", 1, 1, "11"), ("a", 2, 1, "11"), ("a", 2, 3, "2"), ("a", 3, 3, "2"),
        ("a", 3, 4, "2"), ("a", 4, 3, "2"), ("a", 4, 4, "2"), ("b", 2, 3, "7"),
        ("b", 2, 3, "8"), ("e", 1, 1, "1")]


def test_f10_stream_topn_without_closing_row(spark):
    src = (_stream_of(spark, URLS, "seq int, url string, t int, user string", "u")
           .withColumn("et", _at("t")))
    out = _run(ops.window_topn(src, "url", "et", "5 seconds", "3 seconds", 3, "1 second"),
               "g_f10")
    ends = sorted({int(r.window_end.timestamp()) - BASE for r in out.collect()})
    # the watermark reaches 19 - 1 = 18 s: windows ending at or before 18 s come out
    assert ends == [2, 5, 8, 11, 14]
    top = sorted((r.rank, r.url, r.cnt) for r in
                 out.filter(F.unix_seconds("window_start") == BASE).collect())
    assert top == [(1, "/login", 2), (2, "/user", 2), (3, "/info", 1)]


def test_f6_stream_cogroup_with_closing_row(spark):
    rows_l = JOIN_LEFT + [(99, "zz", 10_000)]          # closing row moves the watermark on
    rows_r = JOIN_RIGHT + [(99, "zz", 10_000, "x")]
    left = (_stream_of(spark, rows_l, "seq int, k string, t bigint", "cl")
            .select("k", "t", _at("t").alias("lt")))
    right = (_stream_of(spark, rows_r, "seq int, k string, t2 bigint, p string", "cr")
             .select("k", "t2", "p", _at("t2").alias("rt")))
    out = _run(user.window_cogroup_process(
        left, right, ["k"], "lt", "rt", "5 seconds", "0 seconds", ["t"], ["t2", "p"], both_lists,
        "left array<bigint>, right array<struct<t2:bigint,p:string>>"), "g_f6")
    got = {(r.k, int(r.window_start.timestamp()) - BASE):
           (r.left, [tuple(x) for x in r.right] if r.right else None)
           for r in out.filter(F.col("k") != "zz").collect()}
    assert got == {
        ("a", 0): ([1, 2, 3, 4], [(1, "11"), (3, "2"), (4, "2")]),
        ("b", 0): ([1, 2], [(3, "7"), (3, "8")]),
        ("b", 5): ([9], None),
        ("b", 15): (None, [(19, "1")]),
        ("e", 0): ([1], [(1, "1")]),
        ("e", 5): (None, [(9, "1")]),
    }


def test_f9_stream_sessions_merge_at_one_gap(spark):
    src = (_stream_of(spark, [("x", 0), ("x", 5), ("y", 0), ("y", 4), ("zz", 10_000)],
                      "k string, t int", "s")
           .withColumn("et", _at("t")))
    out = _run(ops.session_agg(src, ["k"], "et", "5 seconds", "0 seconds",
                               {"n": F.count(F.lit(1))}), "g_f9")
    assert sorted((r.k, r.n) for r in out.filter(F.col("k") != "zz").collect()) == [
        ("x", 2), ("y", 2)]
