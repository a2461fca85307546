"""User functions over ordered groups: reduce, folds, full-window and coGroup functions."""

import random
from collections import deque

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.operators import accumulate as acc
from tidewater.operators import grouped, joins, windows

from .conftest import SENSOR_A, SF_SMALL, rows, sensors

KEY, ORDER = ["user_id"], ["ts", "event_id"]


def mixed(a, b):
    """Not associative: twice the state plus the row."""
    return {"id": b["id"], "vc": (2 * a["vc"] + b["vc"]) % 10_007}


def trimmed_mean(key, pieces, cut=2):
    """Mean of the values in order without the first and last ``cut``; keeps ``cut`` values."""
    last, total, n = deque(), 0, 0
    for k, row in enumerate(grouped.rows_of(pieces, ["value"])):
        if k >= cut:
            last.append(row["value"])
            if len(last) > cut:
                total, n = total + last.popleft(), n + 1
    yield {"mean": total / n if n else None, "n": n}


def test_groups_across_batches():
    """Pieces of a group that goes on over batches, groups left early, nulls and NaN as keys."""
    nan = float("nan")
    keys = [None, None, 0.0, 0.0, 0.0, 1.5, nan, nan, nan]
    table = pa.table({"k": pa.array(keys, pa.float64()), "v": pa.array(range(9))})
    for size in (1, 2, 4, 9):
        got = [(k[0], [v for p in ps for v in p.column(1).to_pylist()])
               for k, ps in grouped.groups(table.to_batches(size), ["k"])]
        assert [v for _, v in got] == [[0, 1], [2, 3, 4], [5], [6, 7, 8]]
        assert got[0][0] is None and got[3][0] != got[3][0]
        assert [next(ps).column(1)[0].as_py() for _, ps in grouped.groups(table.to_batches(size), ["k"])] == [0, 2, 5, 6]


def test_ordered_reduce(spark):
    df = sensors(spark, SENSOR_A)
    out = grouped.reduce_ordered(df, ["id"], ["seq"], ["id", "vc"][1:], lambda a, b: {"vc": 10 * a["vc"] + b["vc"]}, rolling_=True)
    assert rows(out) == [("s1", 1, 1), ("s1", 2, 21), ("s2", 3, 2), ("s3", 4, 3)]
    final = grouped.reduce_ordered(df, ["id"], ["seq"], ["vc"], lambda a, b: {"vc": 10 * a["vc"] + b["vc"]})
    assert rows(final) == [("s1", 21), ("s2", 2), ("s3", 3)] and final.columns == ["id", "vc"]
    assert grouped.reduce_ordered(df.limit(0), ["id"], ["seq"], ["vc"], mixed).count() == 0


def test_ordered_reduce_against_a_loop(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, "a", "b", "c"]), k, rng.choice([None, 2 ** 53 + 1 if k < 90 else 3, k])) for k in range(3000)]
    df = spark.createDataFrame(data, "k string, t int, v long").repartition(5)

    def last_but(a, b):
        return {"v": (a["v"] or 0) - (b["v"] or 0)}

    want, state = [], {}
    for k, t, v in data:
        state[k] = v if k not in state else (state[k] or 0) - (v or 0)
        want.append((k, t, state[k]))
    got = grouped.reduce_ordered(df, ["k"], ["t"], ["v"], last_but, rolling_=True)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    every = grouped.reduce_ordered(df, [], ["t"], ["v"], last_but)
    assert every.count() == 1


def test_fold_emits_what_it_likes(spark):
    """Rows kept until three are there, then given out in reverse: no reduce can do that."""
    def step(state, row):
        state = [*state, row["t"]]
        return ([], [{"ts": state[::-1]}]) if len(state) == 3 else (state, [])

    df = spark.range(0, 20, 1, 4).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    out = grouped.fold_rows(df, ["k"], ["t"], ["t"], list, step, "ts array<bigint>")
    assert rows(out) == [(0, [4, 2, 0]), (0, [10, 8, 6]), (0, [16, 14, 12]), (1, [5, 3, 1]), (1, [11, 9, 7]), (1, [17, 15, 13])]


def test_full_window_function(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = windows.process_window(ev, ["event_type"], "ts", "1 day", ["value", "event_id"], trimmed_mean, "mean double, n long")
    want = {}
    for r in ev.select("event_type", F.date_trunc("day", "ts").alias("d"), "value").collect():
        want.setdefault((r[0], r[1]), []).append(r[2])
    got = {(r.event_type, r.window_start): (r.mean, r.n) for r in out.collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        v = sorted(v)[2:-2]
        assert got[k][1] == len(v) and (not v or abs(got[k][0] - sum(v) / len(v)) < 1e-9)
    slid = windows.process_window(ev, [], "ts", "2 days", ["ts"], lambda k, p: [{"n": sum(b.num_rows for b in p)}], "n long", "1 day")
    assert sum(r.n for r in slid.collect()) == 2 * ev.count()


def test_huge_group_streams(spark):
    """One (key, window) of 400 000 rows on each side: the function sees it in pieces, never whole."""
    df = spark.range(0, 400_000, 1, 8).select(F.lit("k").alias("k"), F.timestamp_seconds(F.lit(5)).alias("ts"), F.col("id").alias("v"))

    def widest(key, left, right):
        sizes = [p.num_rows for p in left]
        both = [p.num_rows for p in right]
        yield {"n": sum(sizes), "m": sum(both), "most": max([*sizes, *both])}

    out = joins.window_cogroup_process(df, df.withColumn("x", F.lit(1)), ["k"], "ts", "ts", "10 seconds", ["v"], ["v"], widest,
                                       "n long, m long, most long")
    (r,) = out.collect()
    assert (r.n, r.m) == (400_000, 400_000) and r.most <= 10_000


@pytest.mark.parametrize("take", ["both", "left", "right", "none"])
def test_cogroup_function_takes_what_it_wants(spark, take):
    left = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 1, None), (None, 3, 7)], "k string, t long, v long")
    right = spark.createDataFrame([("a", 3, "x"), ("c", 8, "y"), (None, 1, "z"), (None, 2, "w")], "k string, t long, v string")
    left, right = (d.withColumn("ts", F.timestamp_seconds("t")) for d in (left, right))

    def fn(key, l, r):
        yield {"l": [x["v"] for x in grouped.rows_of(l, ["v"])] if take in ("both", "left") else None,
               "r": [x["v"] for x in grouped.rows_of(r, ["v"])] if take in ("both", "right") else None}

    out = joins.window_cogroup_process(left, right, ["k"], "ts", "ts", "10 seconds", ["t"], ["t"], fn, "l array<bigint>, r array<string>")
    got = {r.k: (r.l, r.r) for r in out.collect()}
    want = {"a": ([5, 6], ["x"]), "b": ([None], []), "c": ([], ["y"]), None: ([7], ["z", "w"])}
    assert got == {k: (l if take in ("both", "left") else None, r if take in ("both", "right") else None) for k, (l, r) in want.items()}


def test_session_accumulators(spark):
    data = [("a", 0, 1), ("a", 4, 2), ("a", 9, 4), ("a", 20, 8), ("b", 3, None), (None, 1, 5), ("a", None, 7)]
    df = spark.createDataFrame(data, "k string, s int, v int").withColumn("ts", F.timestamp_seconds("s")).repartition(3)
    for hot in (0, 2, None):
        out = windows.session_accumulate(df, ["k"], "ts", "5 seconds", acc.sum_as_text("v"), ["v"], "total", "string", hot_rows=hot)
        got = sorted(((r.k or "", r.window_start.second, r.window_end.second, r.total) for r in out.collect()))
        assert got == [("", 1, 6, "5"), ("a", 0, 14, "7"), ("a", 20, 25, "8"), ("b", 3, 8, "0")]
