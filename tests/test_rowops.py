import pytest
from pyspark.sql import functions as F

from tidewater.functions.core import (LETTER_STREAM_TAG, NUMBER_STREAM_TAG, is_bad_sensor,
                                      parse_sensor, split_pair, split_words)
from tidewater.operators import rowops
from tidewater.operators.split import split_by

from .conftest import SENSOR_A, rows, sensors


def test_filter_and_map(spark):
    df = sensors(spark, SENSOR_A)
    assert rows(rowops.filter_equals(df, "id", "s1"), "id", "ts", "vc") == [
        ("s1", 1, 1), ("s1", 11, 11)]
    assert rows(rowops.map_rows(df.filter("seq != 2"), id=F.col("id"))) == [
        ("s1",), ("s2",), ("s3",)]


def test_filter_drops_null_keys(spark):
    df = spark.createDataFrame([("s1",), (None,)], "id string")
    assert rows(rowops.filter_equals(df, "id", "s1")) == [("s1",)]


@pytest.mark.parametrize("text,expected", [
    ("a  b ", ["a", "", "b"]),
    ("", [""]),
    (" ", []),
    ("  x", ["", "", "x"]),
    ("one", ["one"]),
])
def test_split_words(spark, text, expected):
    df = spark.createDataFrame([(text,)], "value string")
    assert df.select(split_words("value")).first()[0] == expected


def test_word_count(spark):
    df = spark.createDataFrame([("a b a",), ("b ",), ("",)], "value string")
    assert rows(rowops.word_count(df, "value")) == [("", 1), ("a", 2), ("b", 2)]


def test_parse_sensor_strict_and_permissive(spark):
    good = spark.createDataFrame([("s1,1,1",), ("s2,2,2,extra",)], "value string")
    assert rows(good.select(parse_sensor("value").alias("s")).select("s.*")) == [
        ("s1", 1, 1), ("s2", 2, 2)]
    bad = spark.createDataFrame([("kim,man,19",)], "value string")
    with pytest.raises(Exception):
        bad.select(parse_sensor("value").alias("s")).collect()
    parsed = bad.select(parse_sensor("value", permissive=True).alias("s"))
    assert parsed.filter(is_bad_sensor("s")).count() == 1
    short = spark.createDataFrame([("s1,5",)], "value string")
    out = short.select(parse_sensor("value", permissive=True).alias("s")).first()[0]
    assert out["id"] == "s1" and out["ts"] == 5 and out["vc"] is None


def test_parse_rejects_spaces_like_the_record_function(spark):
    df = spark.createDataFrame([("s1, 7,1",)], "value string")
    with pytest.raises(Exception):
        df.select(parse_sensor("value").alias("s")).collect()
    out = df.select(parse_sensor("value", permissive=True).alias("s"))
    assert out.filter(is_bad_sensor("s")).count() == 1
    ok = spark.createDataFrame([("s1,+7,-1",)], "value string")
    assert tuple(ok.select(parse_sensor("value").alias("s")).first()[0]) == ("s1", 7, -1)


def test_split_pair(spark):
    df = spark.createDataFrame([("a 1",)], "value string")
    assert tuple(df.select(split_pair("value").alias("p")).first()[0]) == ("a", "1")


def test_co_map(spark):
    nums = spark.createDataFrame([(1,), (2,), (33,)], "value int")
    letters = spark.createDataFrame([("a",), ("b",)], "value string")
    out = rowops.co_map(nums, "value", letters, "value")
    assert rows(out) == sorted([(NUMBER_STREAM_TAG + "1",), (NUMBER_STREAM_TAG + "2",),
                                (NUMBER_STREAM_TAG + "33",), (LETTER_STREAM_TAG + "a",),
                                (LETTER_STREAM_TAG + "b",)])


def test_rich_map_lifecycle(spark):
    df = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("line"))

    def open_fn(ctx):
        ctx["opened"] = True

    def body(pdf, ctx):
        import pandas as pd
        assert ctx["task_name"].endswith(f"subtask {ctx['partition_id']}")
        return pd.DataFrame({"v": pdf["line"].astype("int64") + 1,
                             "part": ctx["partition_id"],
                             "opened": ctx.get("opened", False)})

    out = rowops.rich_map(df, body, "v long, part int, opened boolean", open_fn=open_fn)
    got = out.collect()
    assert sorted(r.v for r in got) == list(range(1, 101))
    assert all(r.opened for r in got)
    assert {r.part for r in got} == {0, 1, 2, 3}


def test_increment_wraps_like_int(spark):
    df = spark.createDataFrame([("2147483647",), ("5",)], "line string")
    assert rows(df.select(rowops.increment_int("line"))) == [(-2147483648,), (6,)]


def test_split_routes_null_to_main(spark):
    df = spark.createDataFrame([("s1",), ("s2",), ("s3",), (None,)], "id string")
    out = split_by(df, {"s1": F.col("id") == "s1", "s2": F.col("id") == "s2"})
    assert rows(out["s1"]) == [("s1",)]
    assert rows(out["s2"]) == [("s2",)]
    assert sorted(out["main"].collect(), key=lambda r: str(r.id)) == sorted(
        [(None,), ("s3",)], key=lambda r: str(r[0]))
    total = sum(o.count() for o in out.values())
    assert total == df.count()


def test_rich_map_releases_after_a_failure(spark):
    opened, released, closed = (spark.sparkContext.accumulator(0) for _ in range(3))

    def run(bad):
        def body(pdf, ctx):
            if bad:
                raise ValueError("bad row")
            return pdf
        return rowops.rich_map(spark.range(0, 4, 1, 2), body, "id long", open_fn=lambda c: opened.add(1),
                               close_fn=lambda c: closed.add(1), release_fn=lambda c: released.add(1))

    assert run(False).count() == 4
    assert (opened.value, closed.value, released.value) == (2, 2, 2)
    try:
        run(True).count()
    except Exception as e:
        assert "bad row" in str(e)
    else:
        raise AssertionError("the function's error must reach the caller")
    assert closed.value == 2


def test_generate_from_a_table(spark):
    from tidewater.sources.core import generate_from, number_label
    df = spark.createDataFrame([(3, "a"), (None, "b")], "i long, x string")
    assert sorted(map(tuple, generate_from(df, "i", number_label, ["x"]).collect()), key=repr) == [
        (3, "Number:3", "a"), (None, None, "b")]
