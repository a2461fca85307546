from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg

from .conftest import SENSOR_A, SENSOR_B, rows, sensors

K, O = ["id"], ["seq"]


def test_final_sum_max_min_keep_first_row_fields(spark):
    df = sensors(spark, SENSOR_A)
    assert rows(agg.keyed_sum(df, K, O, "vc", other=["ts"]), "id", "vc", "ts") == [
        ("s1", 12, 1), ("s2", 2, 2), ("s3", 3, 3)]
    assert rows(agg.keyed_max(df, K, O, "vc", other=["ts"]), "id", "vc", "ts") == [
        ("s1", 11, 1), ("s2", 2, 2), ("s3", 3, 3)]
    assert rows(agg.keyed_min(df, K, O, "vc", other=["ts"]), "id", "vc", "ts") == [
        ("s1", 1, 1), ("s2", 2, 2), ("s3", 3, 3)]


def test_max_by_min_by(spark):
    df = sensors(spark, SENSOR_A)
    mx = agg.extreme_row(df, K, O, "vc", ["id", "ts", "vc"], largest=True)
    assert rows(mx, "id", "ts", "vc")[0] == ("s1", 11, 11)
    mn = agg.extreme_row(df, K, O, "vc", ["id", "ts", "vc"], largest=False)
    assert rows(mn, "id", "ts", "vc")[0] == ("s1", 1, 1)


def test_rolling_max_vs_max_by_with_ties(spark):
    own = [(1, "s1", 1, 1), (2, "s1", 11, 11), (3, "s1", 21, 11), (4, "s1", 22, 5)]
    df = sensors(spark, own)
    roll = agg.keyed_max(df, K, O, "vc", other=["ts"], rolling_=True)
    assert rows(roll, "seq", "vc", "first_ts") == [(1, 1, 1), (2, 11, 1), (3, 11, 1), (4, 11, 1)]
    by = agg.extreme_row(df, K, O, "vc", ["ts", "vc"], largest=True, rolling_=True)
    assert rows(by, "at_seq", "ts", "vc") == [(1, 1, 1), (2, 11, 11), (3, 11, 11), (4, 11, 11)]


def test_reduce_rolling_and_final(spark):
    df = sensors(spark, SENSOR_B)
    roll = agg.reduce_sum_latest(df, K, O, "vc", latest=["ts"], rolling_=True)
    assert rows(roll, "id", "ts", "vc") == [("s1", 1, 1), ("s1", 11, 12), ("s1", 21, 33),
                                            ("s2", 2, 2), ("s3", 3, 3)]
    fin = agg.reduce_sum_latest(df, K, O, "vc", latest=["ts"])
    assert rows(fin, "id", "ts", "vc") == [("s1", 21, 33), ("s2", 2, 2), ("s3", 3, 3)]


def test_rolling_equals_final_at_last_row(spark):
    from .conftest import SF_SMALL
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(
        "value", F.col("value").cast("decimal(18,2)"))
    key, order = ["user_id"], ["ts", "event_id"]
    roll = agg.keyed_sum(ev, key, order, "value", rolling_=True)
    last = roll.groupBy("user_id").agg(F.max_by("value", F.struct("ts", "event_id")).alias("v"))
    fin = agg.keyed_sum(ev, key, order, "value")
    assert rows(last) == rows(fin.select("user_id", "value"))


def test_average_and_value_counts(spark):
    df = sensors(spark, SENSOR_B)
    avg = agg.average(df, K, O, "vc")
    assert rows(avg, "id", "mean") == [("s1", 11.0), ("s2", 2.0), ("s3", 3.0)]
    counts = agg.value_counts(df, K, "vc")
    assert all(r.cnt == 1 for r in counts.collect())
    rc = agg.value_counts_rolling(df.withColumn("c", F.lit(1)), K, O, "c")
    assert rows(rc, "id", "seq", "cnt") == [("s1", 1, 1), ("s1", 2, 2), ("s1", 3, 3),
                                            ("s2", 4, 1), ("s3", 5, 1)]
