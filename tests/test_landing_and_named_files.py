"""Arrival-time joins and named rolling files: the same result when a batch runs again."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from tidewater.operators import joins
from tidewater.sinks.files import NamedFilesWriter, named_text_sink
from tidewater.streaming import landing
from tidewater.streaming.run import run_available_now

from .test_stream_nulls import rows, stream


def forget_last_batch(checkpoint):
    """As after a crash between a batch's work and its entry in the checkpoint: it will run again."""
    last = max((f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{f}"):
            os.remove(f"{checkpoint}/commits/{f}")


def test_arrival_time_join_after_a_restart(spark):
    left, _ = stream(spark, [[("a", 1), ("b", 2)], [("a", 3), (None, 4)]], "k string, l long")
    right, _ = stream(spark, [[("a", 10)], [("b", 20), ("a", 30)]], "k string, r long")
    base = tempfile.mkdtemp(prefix="tw-landing-")
    for df, side in ((left, "l"), (right, "r")):
        landing.land(df, f"{base}/{side}", f"land_{side}", checkpoint=f"{base}/ck_{side}")

    def joined(streaming=False):
        l = landing.landed(spark, f"{base}/l", "k string, l long", streaming)
        r = landing.landed(spark, f"{base}/r", "k string, r long", streaming)
        return landing.window_join(l, r, ["k"], "10 minutes")

    first = rows(joined())
    stamps = rows(landing.landed(spark, f"{base}/l", "k string, l long"))
    assert len({r[2] for r in stamps}) == 2 and all(r[2] is not None for r in stamps)     # one stamp a batch
    want = {("a", 1, 10), ("a", 1, 30), ("a", 3, 10), ("a", 3, 30), ("b", 2, 20)}
    got = {(r[0], *[x for x in r[1:] if isinstance(x, int)]) for r in first}
    assert got <= want and (got == want or len({r[1] for r in first}) > 1)                # all, but for a window's edge between
    forget_last_batch(f"{base}/ck_l")
    landing.land(left, f"{base}/l", "land_again", checkpoint=f"{base}/ck_l")
    assert rows(landing.landed(spark, f"{base}/l", "k string, l long")) == stamps and rows(joined()) == first
    follow = landing.landed(spark, f"{base}/l", "k string, l long", streaming=True)
    run_available_now(follow, "landed_rows", checkpoint=f"{base}/ck_follow")
    assert rows(spark.table("landed_rows")) == stamps


def lines(path):
    return sorted(x for f in glob.glob(f"{path}/*/*.log") if "/_" not in f for x in open(f, encoding="utf-8").read().split("\n")[:-1])


def test_named_files_roll_by_bytes(spark):
    src, whole = stream(spark, [[(f"line {k:05d} é",) for k in range(400)], [("x",), (None,)]], "value string")
    out = tempfile.mkdtemp(prefix="tw-named-")
    ck = tempfile.mkdtemp(prefix="tw-named-ck-")

    def run(name):
        q = named_text_sink(src, out, name, prefix="anqi", suffix=".log", max_bytes=1000, checkpoint=ck, available_now=True)
        q.awaitTermination()
        assert q.exception() is None

    run("named_1")
    files = [f for f in glob.glob(f"{out}/*/*") if "/_" not in f]
    assert len(files) == 7 and all(os.path.basename(f).startswith("anqi-") and f.endswith(".log") for f in files)
    assert all(os.path.getsize(f) < 1000 + 20 for f in files) and sum(os.path.getsize(f) >= 1000 for f in files) == 5
    want = sorted((r.value or "") for r in whole.collect())
    assert lines(out) == want
    forget_last_batch(ck)                                  # the batch is written, not marked in the checkpoint
    run("named_2")
    assert lines(out) == want and not glob.glob(f"{out}/_work/*")


def test_commit_that_failed_half_way(tmp_path):
    """The stored moves are finished by the next run of the batch; what it wrote anew is dropped."""
    import json
    w = NamedFilesWriter({"path": str(tmp_path), "prefix": "p"})

    def task(texts, k=0):
        files = []
        os.makedirs(tmp_path / "_work", exist_ok=True)
        for i, t in enumerate(texts):
            name = str(tmp_path / "_work" / f"{k}-{i}")
            open(name, "w").write(t + "\n")
            files.append((name, "b", k, i))
        from tidewater.sinks.files import Written
        return Written(files)

    first = task(["one", "two"], 0)
    moves = [(f[0], str(tmp_path / "b" / f"p-7-0-{f[3]}.log")) for f in first.files]
    os.makedirs(tmp_path / "_log")
    os.makedirs(tmp_path / "b")
    (tmp_path / "_log" / "7.moves").write_text(json.dumps(moves))
    os.rename(*moves[0])                                   # crashed after the first move
    w.commit([task(["one", "two"], 1), None], 7)
    assert lines(tmp_path) == ["one", "two"] and not os.listdir(tmp_path / "_work")
    w.commit([task(["one", "two"], 2)], 7)                 # and once more, after it was done
    assert lines(tmp_path) == ["one", "two"] and not os.listdir(tmp_path / "_work")
    w.abort([task(["x"], 3), None], 8)
    assert lines(tmp_path) == ["one", "two"] and not os.listdir(tmp_path / "_work")


def test_joins_are_those_of_event_time(spark):
    """The landed join is the window join on the stamp."""
    l = spark.createDataFrame([("a", 1, 5), ("a", 2, 700)], "k string, l int, s int").withColumn("ingest_ts", F.timestamp_seconds("s")).drop("s")
    r = spark.createDataFrame([("a", 9, 8), (None, 8, 8)], "k string, r int, s int").withColumn("ingest_ts", F.timestamp_seconds("s")).drop("s")
    out = landing.window_join(l, r, ["k"], "10 seconds")
    assert [(x.k, x.l, x.r) for x in out.collect()] == [("a", 1, 9)]
    same = joins.window_join(l, r.withColumnRenamed("ingest_ts", "at"), ["k"], "ingest_ts", "at", "10 seconds")
    assert len(same.collect()) == 1
