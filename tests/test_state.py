from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import state

from .conftest import rows, state_kv

K, O = ["k"], ["seq"]


def test_state_table(spark):
    df = state_kv(spark)
    run = agg.rolling(df, K, O, {"s": ("sum", "v"), "n": ("count", "v")}, keep=["v"])
    got = {(r.k, r.v): (r.s, r.s / r.n) for r in run.collect()}
    assert got[("a", 31)] == (43, 43 / 3)
    assert got[("b", 99)] == (232, 232 / 3)
    assert got[("e", 111)] == (111, 111.0)
    top = state.running_topk(df, K, O, "v", k=3)
    assert {(r.k, r.v): r.top for r in top.collect()} == {
        ("a", 1): [1], ("a", 11): [11, 1], ("a", 31): [31, 11, 1], ("a", 53): [53, 31, 11],
        ("b", 52): [52], ("b", 81): [81, 52], ("b", 99): [99, 81, 52], ("e", 111): [111]}


def test_jump_alert(spark):
    out = state.value_jump_alert(state_kv(spark), K, O, "v", threshold=10, initial=0)
    assert rows(out, "k", "v", "prev") == [("a", 31, 11), ("a", 53, 31), ("b", 52, 0),
                                           ("b", 81, 52), ("b", 99, 81), ("e", 111, 0)]


def test_topk_final(spark):
    out = state.topk_final(state_kv(spark), K, O, "v", k=3)
    assert rows(out, "k", "rank", "v") == [("a", 1, 53), ("a", 2, 31), ("a", 3, 11),
                                           ("b", 1, 99), ("b", 2, 81), ("b", 3, 52),
                                           ("e", 1, 111)]


def test_ttl_on_fixture_is_always_empty(spark):
    df = state_kv(spark)
    for refresh in ("read_write", "create_write"):
        out = state.ttl_value(df, K, O, "et", "v", 5, F.col("v") > 10, refresh=refresh)
        assert all(r.state is None for r in out.collect())


def test_ttl_refresh_modes(spark):
    own = [(1, "a", 0, 20), (2, "a", 3, 5), (3, "a", 7, 1), (4, "a", 13, 30), (5, "a", 14, 2)]
    df = (spark.createDataFrame(own, "seq int, k string, t int, v int")
          .withColumn("et", F.timestamp_seconds("t")))
    rw = state.ttl_value(df, K, O, "et", "v", 5, F.col("v") > 10, refresh="read_write")
    assert rows(rw, "t", "state") == [(0, None), (3, 20), (7, 20), (13, None), (14, 30)]
    cw = state.ttl_value(df, K, O, "et", "v", 5, F.col("v") > 10, refresh="create_write")
    assert rows(cw, "t", "state") == [(0, None), (3, 20), (7, None), (13, None), (14, 30)]
