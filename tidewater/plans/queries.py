"""The registered queries: every operator run over the test tables.

``events(event_id, ts, user_id, event_type, value, props)`` plays the
sensor stream: ``user_id`` is the key, ``value`` the measurement and
``(ts, event_id)`` the arrival order. Event-time constants are scaled to
the data (one event every few minutes): seconds in the demos become hours
here. Measurements are summed as ``decimal(18,2)`` so results are exact and
comparable digit for digit.

Every callable takes ``(spark, base_dir)`` and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import parse_sensor, split_pair
from ..functions.time import event_time_from
from ..operators import aggregates as agg
from ..operators import grouped, joins, late, partition, rowops, scan, state, topn, windows
from ..operators.accumulate import accumulate, sum_as_text
from ..operators.split import split_by
from ..sources.core import generate_from, number_label, table

KEY = ["user_id"]
ORDER = ["ts", "event_id"]
HOUR = 3600

# Scaled constants (demo seconds -> hours on the test data).
TUMBLE = "1 hour"
SLIDE_SIZE, SLIDE_STEP = "5 hours", "3 hours"
SESSION_GAP = "30 minutes"
JOIN_WINDOW = "1 day"
JOIN_BOUND_S = 1 * HOUR
LATE_DELAY_S = 1 * HOUR
TTL_S = 6 * HOUR
PARTITIONS = 4            # copies made by the broadcast partitioner

Query = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "events")


def cents(col: str = "value") -> Column:
    """Exact decimal form of a two-decimal measurement."""
    return F.col(col).cast("decimal(18,2)")


def as_double(c: Column) -> Column:
    return c.cast("double")


def mean6(total: Column, n: Column) -> Column:
    """``total / n`` rounded half-up to 6 decimals, in integers of 38 digits so
    every engine gives the same double (total is a non-negative decimal)."""
    wide = "decimal(38,0)"
    c = (total * 100).cast("decimal(30,0)").cast(wide)
    num = (c * F.lit(20000).cast("decimal(6,0)") + n.cast("decimal(20,0)")).cast(wide)
    q = F.call_function("div", num, (n * 2).cast(wide))
    return q.cast("double") / F.lit(1_000_000.0)


def arrival(df: DataFrame) -> DataFrame:
    """An out-of-order arrival sequence: event ids permuted inside blocks of 100."""
    return df.withColumn("arrival", F.floor(F.col("event_id") / 100).cast("bigint") * 100
                         + F.pmod(F.col("event_id") * 37, F.lit(100)))


# -- sources, row functions ---------------------------------------------------------

def src_datagen(spark, base):
    """The generator's rows, one for each event, beside the event's type."""
    return generate_from(events(spark, base), "event_id", number_label, keep=["event_type"])


def parse_sensor_q(spark, base):
    lines = events(spark, base).select(F.concat_ws(
        ",", F.col("user_id").cast("string"), F.col("event_id").cast("string"),
        F.floor("value").cast("int").cast("string")).alias("line"))
    return lines.select(parse_sensor("line").alias("s")).select("s.id", "s.ts", "s.vc")


def parse_pair(spark, base):
    """Lines "type millis" cut in two, the second part assigned as event time."""
    lines = events(spark, base).select("event_id", F.concat_ws(
        " ", "event_type", (F.col("event_id") * 1500).cast("string")).alias("line"))
    out = lines.select("event_id", split_pair("line").alias("p"))
    return out.select("event_id", F.col("p.k").alias("k"),
                      event_time_from(F.col("p.v").cast("bigint"), "millis").cast("timestamp_ntz").alias("at"))


def map_project(spark, base):
    return rowops.map_rows(events(spark, base), event_id=F.col("event_id"),
                           id=F.col("user_id").cast("string"))


def filter_eq(spark, base):
    return rowops.filter_equals(events(spark, base), "event_type", "click").select(
        "event_id", "user_id", "event_type", "value")


def flatmap_words(spark, base):
    return rowops.flat_map_words(table(spark, base, "documents"), "text", keep=["doc_id"])


def wordcount(spark, base):
    return rowops.word_count(table(spark, base, "documents"), "text")


def rich_map_inc(spark, base):
    """``parseInt(line) + 1`` with the lifecycle in the rows: what ``open`` stored, and that it ran once."""
    lines = events(spark, base).select("event_id", F.col("user_id").cast("string").alias("line"))

    def opened(ctx):
        ctx["opened"] = ctx.get("opened", 0) + 1
        ctx["step"] = 1

    def body(pdf, ctx):
        import pandas as pd
        inc = pd.to_numeric(pdf["line"]).astype("int64") + ctx["step"]
        wrapped = ((inc + 2**31) % 2**32) - 2**31
        return pd.DataFrame({"event_id": pdf["event_id"], "inc": wrapped.astype("int32"), "opened": ctx["opened"]})

    return rowops.rich_map(lines, body, "event_id long, inc int, opened int", open_fn=opened)


def connect_comap(spark, base):
    ev = events(spark, base)
    return rowops.co_map(ev, "user_id", ev, "event_type")


def _sides(spark, base):
    ev = events(spark, base).select("event_id", "user_id", "event_type", "value")
    return split_by(ev, {"s1": F.col("event_type") == "click",
                         "s2": F.col("event_type") == "purchase"})


def side_s1(spark, base):
    return _sides(spark, base)["s1"]


def side_s2(spark, base):
    return _sides(spark, base)["s2"]


def side_main(spark, base):
    return _sides(spark, base)["main"]


# -- partitioning -------------------------------------------------------------------

def part_broadcast(spark, base):
    copies = partition.broadcast_copies(events(spark, base).select("event_id"), PARTITIONS)
    return copies.select("event_id", F.col("subtask").cast("int").alias("subtask"),
                         F.spark_partition_id().alias("placed"))


def _subtasks(spark) -> int:
    """Parallelism for the routing queries: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def part_custom(spark, base):
    n = _subtasks(spark)
    ev = events(spark, base).select("event_id", "user_id")
    key = partition.int_key_partitioner(F.col("user_id").cast("string"))
    placed = partition.custom(ev, n, key)
    # every row sits in the partition the partitioner names (key mod n)
    ok = F.spark_partition_id() == F.pmod(key, F.lit(n))
    return placed.select("event_id", "user_id", ok.alias("placed_ok"))


def part_keyby(spark, base):
    ev = partition.key_by(events(spark, base).select("user_id"), _subtasks(spark), "user_id")
    return (ev.withColumn("_p", F.spark_partition_id())
            .groupBy("user_id")
            .agg(F.count_distinct("_p").alias("n_parts"), F.count(F.lit(1)).alias("n_rows")))


# -- keyed aggregates ---------------------------------------------------------------

def _ev_dec(spark, base):
    return events(spark, base).withColumn("value", cents())


def _final_simple(kind):
    def q(spark, base):
        out = getattr(agg, f"keyed_{kind}")(_ev_dec(spark, base), KEY, ORDER, "value",
                                            other=["ts", "event_type"])
        return out.withColumn("value", as_double(F.col("value")))
    return q


def _rolling_simple(kind):
    def q(spark, base):
        out = getattr(agg, f"keyed_{kind}")(_ev_dec(spark, base), KEY, ORDER, "value",
                                            other=["ts", "event_type"], rolling_=True)
        return out.withColumn("value", as_double(F.col("value")))
    return q


COLS = ["event_id", "ts", "event_type", "value"]


def agg_maxby(spark, base):
    return agg.extreme_row(events(spark, base), KEY, ORDER, "value", COLS, largest=True)


def agg_minby(spark, base):
    return agg.extreme_row(events(spark, base), KEY, ORDER, "value", COLS, largest=False)


def agg_maxby_roll(spark, base):
    return agg.extreme_row(events(spark, base), KEY, ORDER, "value", COLS, largest=True,
                           rolling_=True)


def agg_minby_roll(spark, base):
    return agg.extreme_row(events(spark, base), KEY, ORDER, "value", COLS, largest=False,
                           rolling_=True)


def reduce_final(spark, base):
    out = agg.reduce_sum_latest(_ev_dec(spark, base), KEY, ORDER, "value", latest=["ts"])
    return out.withColumn("value", as_double(F.col("value")))


def reduce_roll(spark, base):
    out = agg.reduce_sum_latest(_ev_dec(spark, base), KEY, ORDER, "value", rolling_=True)
    return out.withColumn("value", as_double(F.col("value")))


def state_agg_avg(spark, base):
    out = agg.average(_ev_dec(spark, base), KEY, ORDER, "value")
    return out.select(*KEY, mean6(F.col("sum"), F.col("n")).alias("mean"))


def state_agg_avg_roll(spark, base):
    out = agg.average(_ev_dec(spark, base), KEY, ORDER, "value", rolling_=True)
    return out.select(*KEY, *ORDER, mean6(F.col("sum"), F.col("n")).alias("mean"))


def state_reduce_sum(spark, base):
    out = agg.rolling(_ev_dec(spark, base), KEY, ORDER, {"run_sum": ("sum", "value")},
                      keep=["value"])
    return (out.withColumn("value", as_double(F.col("value")))
            .withColumn("run_sum", as_double(F.col("run_sum"))))


def state_map_counts(spark, base):
    return agg.value_counts(events(spark, base), KEY, "event_type")


def state_map_counts_roll(spark, base):
    return agg.value_counts_rolling(events(spark, base), KEY, ORDER, "event_type")


def state_map_rowcount(spark, base):
    return agg.rolling(events(spark, base), KEY, ORDER, {"cnt": ("count", F.lit(1))})


# -- keyed state ----------------------------------------------------------------------

def state_value_delta(spark, base):
    ev = events(spark, base).select(*KEY, *ORDER, "value")
    return state.value_jump_alert(ev, KEY, ORDER, "value", threshold=10, initial=0)


def state_list_top3(spark, base):
    out = state.running_topk(events(spark, base), KEY, ORDER, "value", k=3)
    return out.select(*KEY, *ORDER, "value", *[F.try_element_at("top", F.lit(i + 1)).alias(f"top{i + 1}")
                                               for i in range(3)])


def state_list_top3_final(spark, base):
    return state.topk_final(events(spark, base), KEY, ORDER, "value", k=3)


def _ttl(refresh):
    def q(spark, base):
        ev = events(spark, base).select(*KEY, *ORDER, "value")
        return state.ttl_value(ev, KEY, ORDER, "ts", "value", TTL_S,
                               write_when=F.col("value") > 10, refresh=refresh)
    return q


# -- windows --------------------------------------------------------------------------

def win_tumbling_sum(spark, base):
    out = windows.tumbling(_ev_dec(spark, base), KEY, "ts", TUMBLE,
                           {"total": F.sum("value"), "cnt": F.count(F.lit(1))})
    return out.withColumn("total", as_double(F.col("total")))


def win_sliding_count(spark, base):
    return windows.sliding(events(spark, base), ["event_type"], "ts", SLIDE_SIZE, SLIDE_STEP,
                           {"cnt": F.count(F.lit(1))})


def win_session(spark, base):
    out = windows.session(_ev_dec(spark, base), KEY, "ts", SESSION_GAP,
                          {"cnt": F.count(F.lit(1)), "total": F.sum("value")},
                          tiebreak=["event_id"])
    return out.withColumn("total", as_double(F.col("total")))


def win_count_tumbling(spark, base):
    out = windows.count_tumbling(_ev_dec(spark, base), KEY, ORDER, 5,
                                 {"total": F.sum("value")})
    return out.withColumn("total", as_double(F.col("total")))


def win_count_sliding(spark, base):
    out = windows.count_sliding(_ev_dec(spark, base), KEY, ORDER, 5, 2,
                                {"total": F.sum("value"), "cnt": F.count(F.lit(1))})
    return out.withColumn("total", as_double(F.col("total")))


def win_global(spark, base):
    out = windows.global_every(_ev_dec(spark, base), KEY, ORDER, 5,
                               {"total": scan.running_sum("value")})
    return out.withColumn("total", as_double(F.col("total")))


def win_all(spark, base):
    out = windows.window_all(_ev_dec(spark, base), "ts", TUMBLE, None,
                             {"cnt": F.count(F.lit(1)), "total": F.sum("value")})
    return out.withColumn("total", as_double(F.col("total")))


def win_accumulate(spark, base):
    """User accumulator (create/add/merge/result) per key and tumbling window:
    the demo's sum rendered as text, over exact cents."""
    w = F.window("ts", TUMBLE)
    framed = events(spark, base).select(
        "user_id", w.start.alias("window_start"), w.end.alias("window_end"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return accumulate(framed, ["user_id", "window_start", "window_end"], sum_as_text("cents"),
                      ["cents"], "total", "string")


def win_full_process(spark, base):
    out = windows.window_quantile(events(spark, base), ["event_type"], "ts", "1 day", "value",
                                  0.5, out="median_value")
    return out.withColumn("median_value", F.round("median_value", 4))


# -- joins ------------------------------------------------------------------------------

def _halves(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two inputs that together hold every event: even and odd event ids."""
    even = F.coalesce(F.pmod("event_id", F.lit(2)) == 0, F.lit(False))
    return ev.filter(even), ev.filter(~even)


def _join_sides(spark, base):
    left, right = _halves(events(spark, base))
    return (left.select("user_id", F.col("event_id").alias("l_event_id"), F.col("ts").alias("l_ts")),
            right.select("user_id", F.col("event_id").alias("r_event_id"), F.col("ts").alias("r_ts")))


def join_window(spark, base):
    left, right = _join_sides(spark, base)
    return joins.window_join(left, right, KEY, "l_ts", "r_ts", JOIN_WINDOW)


def join_cogroup(spark, base):
    left, right = _halves(_ev_dec(spark, base))
    out = joins.window_cogroup(
        left, right, KEY, "ts", "ts", JOIN_WINDOW,
        {"l_cnt": ("count", "*"), "l_total": ("sum", "value")},
        {"r_cnt": ("count", "*"), "r_total": ("sum", "value")})
    return (out.withColumn("l_total", as_double(F.col("l_total")))
            .withColumn("r_total", as_double(F.col("r_total"))))


def join_interval(spark, base):
    left, right = _join_sides(spark, base)
    return joins.interval_join(left, right, KEY, "l_ts", "r_ts", -JOIN_BOUND_S, JOIN_BOUND_S)


def join_connect(spark, base):
    orders = table(spark, base, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    items = table(spark, base, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    return joins.connect_join(orders, items, ["orderkey"])


LATE_COLS = ["event_id", "user_id", "ts", "arrival", late.WATERMARK]


def _late_side(side):
    """One input against its own watermark."""
    def q(spark, base):
        ev = _halves(arrival(events(spark, base).select("event_id", "user_id", "ts")))[side]
        flagged = late.flag_late(ev, "ts", ["arrival"], LATE_DELAY_S)
        return flagged.filter(F.col(late.LATE)).select(*LATE_COLS)
    return q


def _late_join(side):
    """The late outputs of a join: both inputs against the smaller of their watermarks."""
    def q(spark, base):
        left, right = _halves(arrival(events(spark, base).select("event_id", "user_id", "ts")))
        flagged = late.flag_late_pair(left, right, "ts", ["arrival"], LATE_DELAY_S, watermark="min")
        return flagged[side].filter(F.col(late.LATE)).select(*LATE_COLS)
    return q


# -- the same operators with nulls in key, value and time --------------------------------

def holes(spark, base) -> DataFrame:
    """Events with null keys, values and times: every seventh, fifth and eleventh."""
    ev = events(spark, base)
    hole = lambda c, n, k: F.when(F.pmod("event_id", F.lit(n)) != k, F.col(c)).alias(c)
    return ev.select("event_id", hole("ts", 11, 3), hole("user_id", 7, 0), "event_type", hole("value", 5, 2))


def _minby_nulls(spark, base):
    return agg.extreme_row(holes(spark, base), KEY, ["event_id"], "value", ["event_id", "value"], largest=False)


def _sum_roll_nulls(spark, base):
    ev = holes(spark, base).withColumn("value", cents())
    out = agg.rolling(ev, KEY, ["event_id"], {"run_sum": ("sum", "value"), "n": ("count", "value"), "hi": ("max", "value")})
    return out.withColumn("run_sum", as_double(F.col("run_sum"))).withColumn("hi", as_double(F.col("hi")))


def _median_nulls(spark, base):
    out = agg.exact_quantile(holes(spark, base), KEY, "value", 0.5, out="median_value")
    return out.withColumn("median_value", F.round("median_value", 4))


def _session_nulls(spark, base):
    return windows.session(holes(spark, base), KEY, "ts", SESSION_GAP, {"cnt": F.count(F.lit(1))}, tiebreak=["event_id"])


def _topk_nulls(spark, base):
    out = state.running_topk(holes(spark, base), KEY, ["event_id"], "value", k=2)
    return out.select(*KEY, "event_id", *[F.try_element_at("top", F.lit(i + 1)).alias(f"top{i + 1}") for i in range(2)])


def _accumulate_nulls(spark, base):
    ev = holes(spark, base).select("user_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return accumulate(ev, KEY, sum_as_text("cents"), ["cents"], "total", "string")


def reduce_custom(spark, base):
    """A user's reduce: the widest text of a type so far beside the sum, with its own monoid."""
    longest = scan.Monoid(F.max, F.max, lambda c, l: F.greatest(c, l))
    ev = _ev_dec(spark, base)
    out = agg.reduce_with(ev, KEY, ORDER, {"top_type": (longest, "event_type"), "total": (scan.SUM, "value")},
                          rolling_=True)
    return out.withColumn("total", as_double(F.col("total")))


def win_full_custom(spark, base):
    out = windows.full_window(events(spark, base), ["event_type"], "ts", "1 day",
                              {"cnt": F.count(F.lit(1)), "hi": F.max("value")}, {"mid": ("value", 0.5)})
    return out.withColumn("mid", F.round("mid", 4))


def win_global_pred(spark, base):
    """Global window that fires at every purchase with the key's total so far."""
    out = windows.global_when(_ev_dec(spark, base), KEY, ORDER, F.col("event_type") == "purchase",
                              {"total": scan.running_sum("value")})
    return out.withColumn("total", as_double(F.col("total")))


# -- user functions over ordered rows ------------------------------------------------------

MODULUS = 1_000_003


def _cents(spark, base) -> DataFrame:
    return events(spark, base).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


def _reduce_ordered(rolling_):
    """A reduce that is not associative: ``(2 a + b) mod m``, the type of the later row."""
    def q(spark, base):
        return grouped.reduce_ordered(
            _cents(spark, base), KEY, ORDER, ["event_type", "cents"],
            lambda a, b: {"event_type": b["event_type"], "cents": (2 * a["cents"] + b["cents"]) % MODULUS}, rolling_)
    return q


def trimmed(cut: int):
    """Full-window function: count and sum of the cents, in order, without the first and last ``cut`` rows."""
    def fn(key, pieces):
        from collections import deque
        late_ones, total, n = deque(), 0, 0
        for k, row in enumerate(grouped.rows_of(pieces, ["cents"])):
            if k < cut:
                continue
            late_ones.append(row["cents"])
            if len(late_ones) > cut:
                total, n = total + late_ones.popleft(), n + 1
        yield {"n": n, "total_cents": total, "mean_milli": 1000 * total // n if n else None}
    return fn


def win_process_trimmed(spark, base):
    return windows.process_window(_cents(spark, base), ["event_type"], "ts", "1 day", ["cents", "event_id"], trimmed(2),
                                  "n long, total_cents long, mean_milli long")


def chained(key, left, right):
    """coGroup function: both sides' ids chained in order, the right one from where the left one ended."""
    state, counts = 7, []
    for side in (left, right):
        n = 0
        for row in grouped.rows_of(side, ["event_id"]):
            state, n = (31 * state + row["event_id"]) % MODULUS, n + 1
        counts.append(n)
    yield {"l_cnt": counts[0], "r_cnt": counts[1], "chain": state}


def join_cogroup_process(spark, base):
    left, right = _halves(events(spark, base).select("user_id", "ts", "event_id"))
    return joins.window_cogroup_process(left, right, KEY, "ts", "ts", JOIN_WINDOW, ORDER, ["event_id"], chained,
                                        "l_cnt long, r_cnt long, chain long")


def win_session_accumulate(spark, base):
    return windows.session_accumulate(_cents(spark, base), KEY, "ts", SESSION_GAP, sum_as_text("cents"), ["cents"],
                                      "total", "string", tiebreak=["event_id"])


def state_map_snapshots(spark, base):
    """All entries of the map state after each row, as text ``type=count`` by type."""
    ev = events(spark, base)
    types = [r[0] for r in ev.select("event_type").distinct().orderBy("event_type").limit(state.MAP_VALUES + 1).collect()]
    out = state.value_maps_rolling(ev, KEY, ORDER, "event_type", types)
    entries = F.transform(F.array_sort(F.map_entries("counts")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return out.select(*KEY, *ORDER, F.array_join(entries, ",").alias("entries"))


# -- top-N ------------------------------------------------------------------------------

def topn_window(spark, base):
    return topn.window_topn(events(spark, base), "event_type", "ts", SLIDE_SIZE, SLIDE_STEP, 3)


def bottomn_window(spark, base):
    return topn.window_topn(events(spark, base), "event_type", "ts", SLIDE_SIZE, SLIDE_STEP, 3,
                            ascending=True)


QUERIES: dict[str, Query] = {
    "src_datagen": src_datagen,
    "parse_sensor": parse_sensor_q,
    "parse_pair": parse_pair,
    "map_project": map_project,
    "filter_eq": filter_eq,
    "flatmap_words": flatmap_words,
    "wordcount": wordcount,
    "rich_map_inc": rich_map_inc,
    "connect_comap": connect_comap,
    "side_s1": side_s1,
    "side_s2": side_s2,
    "side_main": side_main,
    "part_broadcast": part_broadcast,
    "part_custom": part_custom,
    "part_keyby": part_keyby,
    "agg_sum": _final_simple("sum"),
    "agg_sum_roll": _rolling_simple("sum"),
    "agg_max": _final_simple("max"),
    "agg_max_roll": _rolling_simple("max"),
    "agg_min": _final_simple("min"),
    "agg_min_roll": _rolling_simple("min"),
    "agg_maxby": agg_maxby,
    "agg_maxby_roll": agg_maxby_roll,
    "agg_minby": agg_minby,
    "agg_minby_roll": agg_minby_roll,
    "reduce_final": reduce_final,
    "reduce_roll": reduce_roll,
    "state_agg_avg": state_agg_avg,
    "state_agg_avg_roll": state_agg_avg_roll,
    "state_reduce_sum": state_reduce_sum,
    "state_map_counts": state_map_counts,
    "state_map_counts_roll": state_map_counts_roll,
    "state_map_rowcount": state_map_rowcount,
    "state_value_delta": state_value_delta,
    "state_list_top3": state_list_top3,
    "state_list_top3_final": state_list_top3_final,
    "state_ttl_rw": _ttl("read_write"),
    "state_ttl_w": _ttl("create_write"),
    "win_tumbling_sum": win_tumbling_sum,
    "win_sliding_count": win_sliding_count,
    "win_session": win_session,
    "win_count_tumbling": win_count_tumbling,
    "win_count_sliding": win_count_sliding,
    "win_global": win_global,
    "win_all": win_all,
    "win_accumulate": win_accumulate,
    "win_full_process": win_full_process,
    "join_window": join_window,
    "join_cogroup": join_cogroup,
    "join_interval": join_interval,
    "join_connect": join_connect,
    "late_left": _late_side(0),
    "late_right": _late_side(1),
    "late_join_left": _late_join(0),
    "late_join_right": _late_join(1),
    "agg_minby_nulls": _minby_nulls,
    "agg_sum_roll_nulls": _sum_roll_nulls,
    "quantile_nulls": _median_nulls,
    "win_session_nulls": _session_nulls,
    "state_list_top2_nulls": _topk_nulls,
    "accumulate_nulls": _accumulate_nulls,
    "reduce_custom": reduce_custom,
    "win_full_custom": win_full_custom,
    "win_global_pred": win_global_pred,
    "reduce_ordered": _reduce_ordered(False),
    "reduce_ordered_roll": _reduce_ordered(True),
    "win_process_trimmed": win_process_trimmed,
    "join_cogroup_process": join_cogroup_process,
    "win_session_accumulate": win_session_accumulate,
    "state_map_snapshots": state_map_snapshots,
    "topn_window": topn_window,
    "bottomn_window": bottomn_window,
}
