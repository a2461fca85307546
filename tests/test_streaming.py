"""Streaming forms against their batch forms.

The sf0.001 events are written as three files (by event id range) and read
one file per micro-batch, so every keyed processor has to carry its state
across micro-batches.
"""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import joins, late, state, topn, windows
from tidewater.sinks.files import rolling_text_sink
from tidewater.streaming import ops
from tidewater.streaming.late import LateRouter
from tidewater.streaming.run import closing_rows, run_available_now, run_batches

from .conftest import SF_SMALL, rows

KEY, ORDER = ["user_id"], ["ts", "event_id"]


def scratch():
    return tempfile.mkdtemp(prefix="tw-stream-")


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").drop("props")


@pytest.fixture(scope="module")
def stream_dir(spark, events):
    d = scratch()
    now = time.time() - 100
    for i, (lo, hi) in enumerate([(0, 300), (300, 700), (700, 10**9)]):
        part = events.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi))
        out = f"{d}/f{i}"
        part.coalesce(1).write.parquet(out)
        for f in os.listdir(out):
            os.utime(f"{out}/{f}", (now + i * 10, now + i * 10))
    return d


def stream(spark, events, d):
    return (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(d))


def collect(spark, df, name, mode="append", processing_time=False):
    run_available_now(df, name, mode=mode, checkpoint=scratch(),
                      processing_time=processing_time)
    return spark.table(name)


def test_running_topk_stream(spark, events, stream_dir):
    s = ops.running_topk(stream(spark, events, stream_dir), KEY, ORDER, "value", 3)
    got = collect(spark, s, "s_topk")
    want = state.running_topk(events, KEY, ORDER, "value", 3)
    assert rows(got, "event_id", "top") == rows(want, "event_id", "top")


def test_jump_alert_stream(spark, events, stream_dir):
    s = ops.jump_alert(stream(spark, events, stream_dir), KEY, ORDER, "value")
    got = collect(spark, s, "s_alert")
    want = state.value_jump_alert(events, KEY, ORDER, "value")
    assert rows(got, "event_id", "prev") == rows(want, "event_id", "prev")


def test_running_sum_and_counts_stream(spark, events, stream_dir):
    s = ops.running_sum(stream(spark, events, stream_dir), KEY, ORDER, "value")
    got = {r.event_id: (r.run_sum, r.n) for r in collect(spark, s, "s_sum").collect()}
    want = agg.rolling(events.withColumn("value", F.col("value").cast("decimal(18,2)")),
                       KEY, ORDER, {"s": ("sum", "value"), "n": ("count", "value")},
                       keep=["event_id"])
    for r in want.collect():
        assert got[r.event_id][1] == r.n
        assert abs(got[r.event_id][0] - float(r.s)) < 1e-6
    c = ops.value_counts(stream(spark, events, stream_dir), KEY, ORDER, "event_type")
    gotc = collect(spark, c, "s_counts")
    wantc = agg.value_counts_rolling(events, KEY, ORDER, "event_type", keep=["event_id"])
    assert rows(gotc, "event_id", "cnt") == rows(wantc, "event_id", "cnt")


def test_count_windows_stream(spark, events, stream_dir):
    src = stream(spark, events, stream_dir)
    got = collect(spark, ops.count_window(src, KEY, ORDER, "value", 5, 2), "s_cw")
    want = windows.count_sliding(events, KEY, ORDER, 5, 2, {"cnt": F.count(F.lit(1))})
    assert rows(got, "user_id", "fire_at", "cnt") == rows(want, "user_id", "fire_at", "cnt")
    src = stream(spark, events, stream_dir)
    got = collect(spark, ops.count_window(src, KEY, ORDER, "value", 5), "s_ct")
    want = windows.count_tumbling(events, KEY, ORDER, 5, {"cnt": F.count(F.lit(1))})
    assert rows(got, "user_id", "cnt") == rows(want, "user_id", "cnt")


def test_late_flags_by_key_stream(spark, events, stream_dir):
    src = stream(spark, events, stream_dir)
    got = collect(spark, ops.late_flags_by_key(src, KEY, ["event_id"], "ts", 3600), "s_late")
    want = late.flag_late(events, "ts", ["event_id"], 3600, key=KEY)
    assert rows(got, "event_id", "is_late") == rows(want, "event_id", "is_late")


def test_ttl_stream_lapses_between_batches(spark, events, stream_dir):
    src = stream(spark, events, stream_dir)
    got = collect(spark, ops.ttl_value(src, KEY, ORDER, "value", ttl_ms=1, write_above=-1),
                  "s_ttl", processing_time=True)
    # within a micro-batch the clock stands still, so the previous row of the
    # key in the same batch is visible; across batches 1 ms has lapsed
    batch_of = F.when(F.col("event_id") < 300, 0).when(F.col("event_id") < 700, 1).otherwise(2)
    w = agg.rolling(events.withColumn("b", batch_of), KEY + ["b"], ORDER,
                    {"prev": ("count", F.lit(1))}, keep=["event_id"])
    firsts = {r.event_id for r in w.collect() if r.prev == 1}
    for r in got.collect():
        assert (r.state is None) == (r.event_id in firsts)


def _closed(spark, events, d, name):
    base = events.withColumn("_closing", F.lit(False))
    closing = closing_rows(events, "ts", []).withColumn("_closing", F.lit(True))
    cdir = scratch()
    closing.write.parquet(f"{cdir}/z")
    for f in os.listdir(f"{cdir}/z"):
        os.utime(f"{cdir}/z/{f}", (time.time(), time.time()))
    src = (spark.readStream.schema(base.schema).option("recursiveFileLookup", "true")
           .parquet(d))
    extra = (spark.readStream.schema(base.schema).option("recursiveFileLookup", "true")
             .parquet(cdir))
    return src.withColumn("_closing", F.lit(False)).unionByName(extra)


def test_window_agg_stream_matches_batch_with_closing_row(spark, events, stream_dir):
    src = _closed(spark, events, stream_dir, "w")
    out = ops.window_agg(src, KEY, "ts", "1 hour", None, "0 seconds",
                         {"cnt": F.count(F.lit(1))})
    got = collect(spark, out, "s_win").filter(F.col("user_id").isNotNull())
    want = windows.tumbling(events, KEY, "ts", "1 hour", {"cnt": F.count(F.lit(1))})
    g = rows(got.withColumn("ws", F.col("window_start").cast("timestamp_ntz")),
             "user_id", "ws", "cnt")
    assert g == rows(want, "user_id", "window_start", "cnt")


def test_window_topn_stream_matches_batch_with_closing_row(spark, events, stream_dir):
    src = _closed(spark, events, stream_dir, "t")
    out = ops.window_topn(src, "event_type", "ts", "5 hours", "3 hours", 3, "0 seconds")
    got = collect(spark, out, "s_topn").filter(F.col("event_type").isNotNull())
    want = topn.window_topn(events, "event_type", "ts", "5 hours", "3 hours", 3)
    g = rows(got.withColumn("ws", F.col("window_start").cast("timestamp_ntz")),
             "ws", "rank", "event_type", "cnt")
    w = rows(want, "window_start", "rank", "event_type", "cnt")
    assert g == w


def test_stream_joins(spark, events, stream_dir):
    src = stream(spark, events, stream_dir)
    l = src.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("l_id"), F.col("ts").alias("l_ts"))
    r = src.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"))
    got = collect(spark, ops.interval_join(l, r, KEY, "l_ts", "r_ts", -3600, 3600, "1 day"),
                  "s_ij")
    bl = events.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("l_id"), F.col("ts").alias("l_ts"))
    br = events.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"))
    want = joins.interval_join(bl, br, KEY, "l_ts", "r_ts", -3600, 3600)
    assert rows(got, "l_id", "r_id") == rows(want, "l_id", "r_id")
    src = stream(spark, events, stream_dir)
    l = src.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("l_id"), F.col("ts").alias("l_ts"))
    r = src.filter(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"))
    got = collect(spark, ops.window_join(l, r, KEY, "l_ts", "r_ts", "1 day", "2 days"), "s_wj")
    want = joins.window_join(bl, br, KEY, "l_ts", "r_ts", "1 day")
    assert rows(got, "l_id", "r_id") == rows(want, "l_id", "r_id")
    src = stream(spark, events, stream_dir)
    got = collect(spark, ops.connect_join(
        src.select("user_id", F.col("event_id").alias("a")).filter("a % 7 = 0"),
        src.select("user_id", F.col("event_id").alias("b")).filter("b % 11 = 0"), KEY), "s_cj")
    want = joins.connect_join(events.select("user_id", F.col("event_id").alias("a"))
                              .filter("a % 7 = 0"),
                              events.select("user_id", F.col("event_id").alias("b"))
                              .filter("b % 11 = 0"), KEY)
    assert rows(got, "a", "b") == rows(want, "a", "b")


def test_late_router(spark, events):
    d = scratch()
    now = time.time() - 100
    # arrival order: the middle file holds the newest rows, the last the oldest
    for i, (lo, hi) in enumerate([(300, 600), (600, 1000), (0, 300)]):
        out = f"{d}/f{i}"
        events.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)) \
            .coalesce(1).write.parquet(out)
        for f in os.listdir(out):
            os.utime(f"{out}/{f}", (now + i * 10, now + i * 10))
    out = scratch()
    src = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(d))
    run_batches(src, "s_router", LateRouter(out, "ts", 3600), checkpoint=scratch())
    late_rows = spark.read.parquet(f"{out}/late")
    on_time = spark.read.parquet(f"{out}/on_time")
    assert late_rows.count() + on_time.count() == events.count()
    assert rows(late_rows, "event_id") == [(i,) for i in range(300)]


def test_rolling_file_sink_exactly_once(spark):
    src_dir, out, ckpt = scratch(), scratch(), scratch()
    spark.createDataFrame([(f"Number:{i}",) for i in range(100)], "value string") \
        .coalesce(1).write.text(f"{src_dir}/a")
    lines = spark.readStream.format("text").option("recursiveFileLookup", "true").load(src_dir)
    q = rolling_text_sink(lines, f"{out}/sink", "s_files", max_records_per_file=30,
                          checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    got = spark.read.text(f"{out}/sink")
    assert got.count() == 100
    assert len([f for f in os.listdir(f"{out}/sink") if f.startswith("bucket=")]) >= 1
    # restart from the same checkpoint with one new file: only new lines appear
    spark.createDataFrame([("Number:100",)], "value string").coalesce(1) \
        .write.text(f"{src_dir}/b")
    q = rolling_text_sink(lines, f"{out}/sink", "s_files2", max_records_per_file=30,
                          checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    again = spark.read.text(f"{out}/sink")
    assert again.count() == 101
    assert again.select("value").distinct().count() == 101


def test_window_cogroup_stream(spark, events):
    src = _closed(spark, events, _single_dir(spark, events), "c")
    src = src.filter(~F.col("_closing") | F.col("event_id").isNull())
    l = src.filter((F.col("event_type") == "click") | F.col("_closing"))
    r = src.filter((F.col("event_type") == "purchase") | F.col("_closing"))
    out = ops.window_cogroup(l, r, KEY, "ts", "ts", "1 day", "0 seconds",
                             {"l_cnt": ("count", "event_id")}, {"r_cnt": ("count", "event_id")})
    got = collect(spark, out, "s_cog").filter(F.col("user_id").isNotNull())
    bl = events.filter(F.col("event_type") == "click")
    br = events.filter(F.col("event_type") == "purchase")
    want = joins.window_cogroup(bl, br, KEY, "ts", "ts", "1 day",
                                {"l_cnt": ("count", "event_id")}, {"r_cnt": ("count", "event_id")})
    g = rows(got.withColumn("ws", F.col("window_start").cast("timestamp_ntz")),
             "user_id", "ws", "l_cnt", "r_cnt")
    assert g == rows(want, "user_id", "window_start", "l_cnt", "r_cnt")


def _single_dir(spark, events):
    d = scratch()
    events.coalesce(1).write.parquet(f"{d}/all")
    for f in os.listdir(f"{d}/all"):
        os.utime(f"{d}/all/{f}", (time.time() - 50, time.time() - 50))
    return d


def test_rolling_fields_and_extreme_rows_stream(spark, events, stream_dir):
    fields = {"mx": ("max", "value"), "mn": ("min", "value"), "first_type": ("first", "event_type"),
              "last_ts": ("last", "ts"), "cnt": ("count", "value")}
    got = collect(spark, ops.rolling(stream(spark, events, stream_dir), KEY, ORDER, fields),
                  "s_roll")
    want = agg.rolling(events, KEY, ORDER, fields)
    cols = ["user_id", "event_id", "mx", "mn", "first_type", "cnt"]
    assert rows(got, *cols) == rows(want, *cols)
    for largest in (True, False):
        name = "s_maxby" if largest else "s_minby"
        got = collect(spark, ops.extreme_row(stream(spark, events, stream_dir), KEY, ORDER,
                                             "value", ["event_id", "value"], largest), name)
        want = agg.extreme_row(events, KEY, ORDER, "value", ["event_id", "value"],
                               largest=largest, rolling_=True)
        assert rows(got, "at_event_id", "event_id", "value") == \
            rows(want, "at_event_id", "event_id", "value")


def test_session_agg_stream_matches_batch(spark, events):
    src = _closed(spark, events, _single_dir(spark, events), "sess")
    out = ops.session_agg(src, KEY, "ts", "30 minutes", "0 seconds",
                          {"n": F.count("event_id")})
    got = collect(spark, out, "s_sess").filter(F.col("user_id").isNotNull())
    want = windows.session(events, KEY, "ts", "30 minutes", {"n": F.count("event_id")})
    g = rows(got.withColumn("ws", F.col("window_start").cast("timestamp_ntz")), "user_id", "ws", "n")
    assert g == rows(want, "user_id", "window_start", "n")


def test_processing_time_window_and_ingest_stamp(spark, events):
    src = stream(spark, events, _single_dir(spark, events))
    stamped = ops.stamp_ingest_time(src)
    out = ops.processing_time_window(stamped, ["event_type"], "1 hour", {"n": F.count(F.lit(1))})
    got = collect(spark, out, "s_pt", mode="update", processing_time=True)
    assert sum(r.n for r in got.collect()) == events.count()
    assert got.filter(F.col("window_end") <= F.col("window_start")).count() == 0


def test_generator_stream(spark):
    from tidewater.sources.core import generate_stream, number_label
    gen = generate_stream(spark, number_label, rows_per_batch=10, num_partitions=2)
    q = (gen.writeStream.format("memory").queryName("s_gen")
         .option("checkpointLocation", scratch()).trigger(processingTime="200 milliseconds")
         .start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("s_gen").count() < 30:
            time.sleep(0.5)
    finally:
        q.stop()
    got = spark.table("s_gen").orderBy("index").collect()
    assert len(got) >= 30
    assert [r["index"] for r in got[:30]] == list(range(30))
    assert got[7].value == "Number:7"


def test_event_time_from(spark):
    from tidewater.functions.time import event_time_from
    df = spark.createDataFrame([(1, 1000, 1000000)], "s long, ms long, us long")
    r = df.select(event_time_from("s").alias("a"), event_time_from("ms", "millis").alias("b"),
                  event_time_from("us", "micros").alias("c")).first()
    assert r.a == r.b == r.c


def test_split_writer_stream(spark, events, stream_dir):
    from tidewater.streaming.split import SplitWriter
    out = scratch()
    writer = SplitWriter(out, {"s1": F.col("event_type") == "click",
                               "s2": F.col("event_type") == "purchase"})
    run_batches(stream(spark, events, stream_dir), "s_split", writer, checkpoint=scratch())
    got = {name: spark.read.parquet(f"{out}/{name}") for name in ("s1", "s2", "main")}
    assert sum(df.count() for df in got.values()) == events.count()
    assert {r.event_type for r in got["s1"].select("event_type").distinct().collect()} == {"click"}
    assert got["main"].filter(F.col("event_type").isin("click", "purchase")).count() == 0


def test_late_router_joint_watermark(spark, events):
    d = scratch()
    now = time.time() - 100
    clicks = events.filter(F.col("event_type") == "click").withColumn("side", F.lit("left"))
    buys = events.filter(F.col("event_type") == "purchase").withColumn("side", F.lit("right"))
    parts = [clicks.filter("event_id >= 500"), buys.filter("event_id < 900"),
             clicks.filter("event_id < 500"), buys.filter("event_id >= 900")]
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{d}/f{i}")
        for f in os.listdir(f"{d}/f{i}"):
            os.utime(f"{d}/f{i}/{f}", (now + i * 10, now + i * 10))
    out = scratch()
    schema = clicks.schema
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(d))
    run_batches(src, "s_router2", LateRouter(out, "ts", 3600, side="side"), checkpoint=scratch())
    late_rows = spark.read.parquet(f"{out}/late")
    # batch 0: only clicks seen -> no joint watermark yet, nothing late in batch 1;
    # batch 2 (old clicks) is judged against min(max clicks, max purchases)
    wm = min(clicks.filter("event_id >= 500").agg(F.max("ts")).first()[0],
             buys.filter("event_id < 900").agg(F.max("ts")).first()[0])
    want = parts[2].filter(F.col("ts") < F.lit(wm) - F.expr("INTERVAL 1 HOUR"))
    assert rows(late_rows, "event_id") == rows(want, "event_id")
    total = spark.read.parquet(f"{out}/on_time").count() + late_rows.count()
    assert total == clicks.count() + buys.count()
