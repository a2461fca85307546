from pyspark.sql import functions as F

from tidewater.operators.accumulate import Accumulator, accumulate, mean_of, sum_as_text

from .conftest import SENSOR_B, SF_SMALL, rows, sensors


def test_sum_as_text_per_key(spark):
    df = sensors(spark, SENSOR_B)
    out = accumulate(df, ["id"], sum_as_text("vc"), ["vc"], "total", "string")
    assert rows(out) == [("s1", "33"), ("s2", "2"), ("s3", "3")]


def test_mean_matches_builtin_across_many_partitions(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(7)
    got = accumulate(ev, ["user_id"], mean_of("value"), ["value"], "mean", "double")
    want = ev.groupBy("user_id").agg(F.avg("value").alias("mean"))
    g, w = dict(rows(got)), dict(rows(want))
    assert g.keys() == w.keys()
    assert all(abs(g[k] - w[k]) < 1e-9 for k in g)


def test_merge_is_used_for_partial_states(spark):
    calls = spark.sparkContext.accumulator(0)

    def merge(a, b):
        calls.add(1)
        return a + b

    acc = Accumulator(zero=lambda: 0, add=lambda s, r: s + len(r["id"]), merge=merge, result=lambda s: s)
    df = spark.range(0, 100, 1, 5).withColumn("k", F.lit("x"))
    out = accumulate(df, ["k"], acc, ["id"], "n", "long")
    assert rows(out) == [("x", 100)]
    assert calls.value == 4          # five tasks -> five partial states -> four merges


def test_null_nan_and_large_keys(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(None, 1), (None, 2), (2, 4), (2, 5), (big, 7), (big + 1, 8), (None, None), (2, None)],
                               "k bigint, v int").repartition(3)
    for flush in (1, 2, 100_000):
        out = accumulate(df, ["k"], sum_as_text("v"), ["v"], "t", "string", flush_keys=flush)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(
            [(None, "3"), (2, "9"), (big, "7"), (big + 1, "8")], key=repr)
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1), (nan, 2), (0.0, 1), (-0.0, 1), (None, 5)], "k double, v int")
    out = accumulate(df, ["k"], sum_as_text("v"), ["v"], "t", "string")
    assert sorted((repr(r.k), r.t) for r in out.collect()) == [("0.0", "2"), ("None", "5"), ("nan", "3")]
    one = spark.createDataFrame([("a", 1), ("a", None), ("a", 5)], "k string, v int")
    assert rows(accumulate(one, ["k"], sum_as_text("v"), ["v"], "t", "string")) == [("a", "6")]


def test_arrays_give_what_rows_give(spark):
    """The same accumulator with and without its array form: types, nulls, groups over many batches and flushes."""
    from dataclasses import replace
    big = 2 ** 62
    df = spark.range(0, 4000, 1, 5).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 7).alias("k"), (F.col("id") % 3).cast("string").alias("g"),
        F.when(F.col("id") % 5 != 0, F.lit(big) + F.col("id")).alias("i"),
        F.when(F.col("id") % 4 != 0, (F.col("id") % 100).cast("decimal(10,2)")).alias("d"),
        (F.col("id") % 8).cast("double").alias("f"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        for column in ("i", "d", "f"):
            acc = sum_as_text(column)
            for key in (["k", "g"], ["k"], []):
                for flush in (10, 100_000):
                    fast = accumulate(df, key, acc, [column], "t", "string", flush_keys=flush)
                    slow = accumulate(df, key, replace(acc, arrays=None), [column], "t", "string", flush_keys=flush)
                    assert fast.schema == slow.schema
                    assert sorted(map(repr, fast.collect())) == sorted(map(repr, slow.collect())), (column, key, flush)
        assert accumulate(df.limit(0), ["k"], sum_as_text("i"), ["i"], "t", "string").count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_runs_where_workers_cannot_import_the_package(tmp_path):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from tidewater.session import build_session
import __spark_entry__ as e
s = build_session("local[2]", shuffle_partitions=2)
print("ROWS", e.queries()["win_accumulate"](s, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS " in got.stdout, got.stderr[-2000:]
