from pyspark.sql import functions as F

from tidewater.operators import grouped, joins, topn, windows
from tidewater.operators import scan

from .conftest import join_left, join_right, rows, urls


def _secs(col):
    return F.unix_seconds(F.col(col).cast("timestamp"))


def test_window_join_pairs(spark):
    l = join_left(spark).drop("seq")
    r = join_right(spark).drop("seq")
    empty = joins.window_join(l, r.filter(F.lit(False)), ["k"], "lt", "rt", "5 seconds")
    assert empty.count() == 0
    out = joins.window_join(l, r, ["k"], "lt", "rt", "5 seconds")
    got = out.groupBy("k").count()
    assert rows(got) == [("a", 12), ("b", 4), ("e", 1)]


def both_lists(key, left, right):
    """Both sides of a (key, window) as lists; null for a side without rows."""
    l = [r["t"] for r in grouped.rows_of(left, ["t"])]
    r = [(x["t2"], x["p"]) for x in grouped.rows_of(right, ["t2", "p"])]
    yield {"left": l or None, "right": [{"t2": a, "p": b} for a, b in r] or None}


def test_window_cogroup_lists(spark):
    l = join_left(spark)
    r = join_right(spark)
    out = joins.window_cogroup_process(
        l, r, ["k"], "lt", "rt", "5 seconds", ["t"], ["t2", "p"], both_lists,
        "left array<bigint>, right array<struct<t2:bigint,p:string>>")
    got = {(x.k, int(x.window_start.timestamp()) if hasattr(x.window_start, "timestamp")
            else x.window_start): (x.left, [tuple(s) for s in x.right] if x.right else None)
           for x in out.withColumn("window_start", _secs("window_start")).collect()}
    assert got == {
        ("a", 0): ([1, 2, 3, 4], [(1, "11"), (3, "2"), (4, "2")]),
        ("b", 0): ([1, 2], [(3, "7"), (3, "8")]),
        ("b", 5): ([9], None),
        ("b", 15): (None, [(19, "1")]),
        ("e", 0): ([1], [(1, "1")]),
        ("e", 5): (None, [(9, "1")]),
    }


def test_interval_join_inclusive(spark):
    out = joins.interval_join(join_left(spark), join_right(spark).drop("seq"), ["k"],
                              "lt", "rt", -1, 1)
    assert rows(out, "k", "t", "t2", "p") == [
        ("a", 1, 1, "11"), ("a", 2, 1, "11"), ("a", 2, 3, "2"), ("a", 3, 3, "2"),
        ("a", 3, 4, "2"), ("a", 4, 3, "2"), ("a", 4, 4, "2"), ("b", 2, 3, "7"),
        ("b", 2, 3, "8"), ("e", 1, 1, "1")]


def test_interval_join_matches_plain_join(spark):
    from .conftest import SF_SMALL
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    l = ev.select("user_id", F.col("event_id").alias("a"), F.col("ts").alias("lt"))
    r = ev.select("user_id", F.col("event_id").alias("b"), F.col("ts").alias("rt"))
    got = joins.interval_join(l, r, ["user_id"], "lt", "rt", -7200, 3600, bucket_s=600)
    plain = l.join(r, "user_id").filter(
        (F.col("rt") >= F.col("lt") - F.expr("INTERVAL 2 HOURS"))
        & (F.col("rt") <= F.col("lt") + F.expr("INTERVAL 1 HOURS")))
    assert rows(got, "a", "b") == rows(plain, "a", "b")


def test_connect_join(spark):
    left = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b"), (3, "c")], "id int, v string")
    right = spark.createDataFrame([(1, "aa1", 1), (1, "aa2", 2), (2, "bb", 1), (3, "cc", 1)],
                                  "id int, w string, n int")
    assert rows(joins.connect_join(left, right, ["id"])) == [
        (1, "a1", "aa1", 1), (1, "a1", "aa2", 2), (1, "a2", "aa1", 1), (1, "a2", "aa2", 2),
        (2, "b", "bb", 1), (3, "c", "cc", 1)]


def test_session_merges_at_exactly_one_gap(spark):
    df = (spark.createDataFrame([("x", 0), ("x", 5), ("y", 0), ("y", 4)], "k string, t int")
          .withColumn("et", F.timestamp_seconds("t")))
    out = windows.session(df, ["k"], "et", "5 seconds", {"n": F.count(F.lit(1))})
    assert rows(out, "k", "n") == [("x", 2), ("y", 2)]


def test_sliding_windows_start_negative(spark):
    df = spark.createDataFrame([(1,)], "t int").withColumn("et", F.timestamp_seconds("t"))
    out = windows.sliding(df, [], "et", "5 seconds", "3 seconds", {"n": F.count(F.lit(1))})
    assert rows(out.select(_secs("window_start"), _secs("window_end"))) == [(-3, 2), (0, 5)]


def test_count_windows(spark):
    df = spark.createDataFrame([("k", i) for i in range(1, 8)], "k string, v int")
    tumble = windows.count_tumbling(df, ["k"], ["v"], 5, {"s": F.sum("v")})
    assert rows(tumble, "s") == [(15,)]
    slide = windows.count_sliding(df, ["k"], ["v"], 5, 2, {"s": F.sum("v")})
    assert rows(slide, "fire_at", "s") == [(2, 3), (4, 10), (6, 20)]
    glob = windows.global_every(df, ["k"], ["v"], 3, {"s": scan.running_sum("v")})
    assert rows(glob, "fire_at", "s") == [(3, 6), (6, 21)]


def test_count_sliding_with_gaps(spark):
    df = spark.createDataFrame([("k", i) for i in range(1, 13)], "k string, v int")
    out = windows.count_sliding(df, ["k"], ["v"], 2, 5, {"s": F.sum("v")})
    # fires after rows 5 and 10 over the last two rows
    assert rows(out, "fire_at", "s") == [(5, 9), (10, 19)]


def test_window_all_and_tumbling(spark):
    df = join_left(spark)
    out = windows.window_all(df, "lt", "5 seconds", None, {"n": F.count(F.lit(1))})
    assert rows(out.select(_secs("window_start"), "n")) == [(0, 7), (5, 1)]
    med = windows.full_window(df, ["k"], "lt", "5 seconds", {"m": F.median("t")})
    assert rows(med, "k", "m") == [("a", 2.5), ("b", 1.5), ("b", 9.0), ("e", 1.0)]


def test_topn_sliding(spark):
    out = topn.window_topn(urls(spark), "url", "et", "5 seconds", "3 seconds", 3)
    got = {}
    for r in out.select(_secs("window_start").alias("s"), "rank", "url", "cnt").collect():
        got.setdefault(r.s, []).append((r.rank, r.url, r.cnt))
    assert {k: sorted(v) for k, v in got.items()} == {
        -3: [(1, "/info", 1), (2, "/user", 1)],
        0: [(1, "/login", 2), (2, "/user", 2), (3, "/info", 1)],
        3: [(1, "/login", 2), (2, "/logout", 1), (3, "/user", 1)],
        6: [(1, "/info", 1)],
        9: [(1, "/info", 1)],
        15: [(1, "/modify", 1)],
        18: [(1, "/modify", 1)],
    }
    low = topn.window_topn(urls(spark), "url", "et", "5 seconds", "3 seconds", 3, ascending=True)
    zero = sorted((r.rank, r.url, r.cnt) for r in
                  low.filter(_secs("window_start") == 0).collect())
    assert zero == [(1, "/info", 1), (2, "/logout", 1), (3, "/login", 2)]
