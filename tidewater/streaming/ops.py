"""Structured Streaming forms of the operators.

Built-in where Spark has a streaming plan (event-time windows with
watermarks, stream-stream joins, chained aggregation for per-window top-N),
``transformWithStateInPandas`` processors for per-row keyed state. All
functions return streaming DataFrames; start them with a sink and a
checkpoint location in the shared folder (see ``streaming.run``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import epoch_micros
from . import processors as P


def event_time(df: DataFrame, col: str, delay: str | None = None) -> DataFrame:
    """Make ``col`` a session-zone ``timestamp`` (watermarks reject
    ``timestamp_ntz``) and optionally add the watermark."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df.withWatermark(col, delay) if delay else df


def _type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def _schema(df: DataFrame, cols: Sequence[str], extra: str) -> str:
    fields = [f"`{c}` {_type(df, c)}" for c in cols]
    return ", ".join([*fields, extra]) if extra else ", ".join(fields)


def keyed(df: DataFrame, key: Sequence[str], processor, schema: str,
          mode: str = "Append", time_mode: str = "None") -> DataFrame:
    """Run ``processor`` per key. Column names reaching a processor must not
    start with an underscore (they would arrive renamed by position)."""
    return df.groupBy(*key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=mode,
        timeMode=time_mode)


# -- keyed state ------------------------------------------------------------------

def running_topk(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                 k: int = 3) -> DataFrame:
    cols = list(dict.fromkeys([*key, *order, value]))
    vt = _type(df, value)
    proc = P.RunningTopK(order, value, k, cols, vt)
    return keyed(df, key, proc, _schema(df, cols, f"top array<{vt}>"))


def jump_alert(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
               threshold: float = 10, initial: float = 0) -> DataFrame:
    cols = list(dict.fromkeys([*key, *order, value]))
    vt = _type(df, value)
    proc = P.JumpAlert(order, value, cols, threshold, initial, vt)
    return keyed(df, key, proc, _schema(df, cols, f"prev {vt}"))


def running_sum(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                every: int = 1) -> DataFrame:
    cols = list(dict.fromkeys([*key, *order, value]))
    proc = P.RunningSum(order, value, cols, every)
    return keyed(df, key, proc, _schema(df, cols, "run_sum double, n long, mean double"))


def rolling(df: DataFrame, key: Sequence[str], order: Sequence[str],
            fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Stream form of ``aggregates.rolling``: one output row per input row
    with each field's aggregate so far (sum, count, max, min, first, last)."""
    cols = list(dict.fromkeys([*key, *order]))
    state, extra = [], []
    for n, (kind, c) in fields.items():
        t = "bigint" if kind == "count" else _type(df, c)
        state += [f"seen_{n} boolean", f"acc_{n} {t}"]
        extra.append(f"`{n}` {t}")
    proc = P.RollingFields(order, cols, fields, ", ".join(state))
    return keyed(df, key, proc, _schema(df, cols, ", ".join(extra)))


def extreme_row(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                columns: Sequence[str], largest: bool = True) -> DataFrame:
    """Stream form of maxBy / minBy (rolling): key, ``at_<order>`` of the
    current row, then the chosen row's ``columns``."""
    row_cols = list(dict.fromkeys(columns))
    # integers travel as decimals: a batch with a null would turn them into floats
    whole = {c: df.schema[c].dataType for c in row_cols
             if c not in (*key, *order) and isinstance(df.schema[c].dataType, T.IntegralType)}
    df = df.withColumns({c: F.col(c).cast("decimal(20,0)") for c in whole}) if whole else df
    out = [*[k for k in key if k not in row_cols], *[f"at_{o}" for o in order], *row_cols]
    schema = ", ".join([*[f"`{k}` {_type(df, k)}" for k in key if k not in row_cols],
                        *[f"`at_{o}` {_type(df, o)}" for o in order],
                        *[f"`{c}` {_type(df, c)}" for c in row_cols]])
    state = ", ".join(f"`{c}` {_type(df, c)}" for c in row_cols)
    proc = P.ExtremeRow(order, value, row_cols, out, largest, state)
    rows = keyed(df, key, proc, schema)
    return rows.withColumns({c: F.col(c).cast(t) for c, t in whole.items()}) if whole else rows


def value_counts(df: DataFrame, key: Sequence[str], order: Sequence[str],
                 value: str) -> DataFrame:
    cols = list(dict.fromkeys([*key, *order, value]))
    proc = P.ValueCounts(order, value, cols, _type(df, value))
    return keyed(df, key, proc, _schema(df, cols, "cnt long"))


def count_window(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                 size: int, slide: int | None = None) -> DataFrame:
    proc = P.CountWindow(order, value, key, size, slide or size)
    return keyed(df, key, proc, _schema(df, key, "fire_at long, total double, cnt long"))


def late_flags_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str], ts: str,
                      delay_seconds: float) -> DataFrame:
    cols = list(dict.fromkeys([*key, *order, ts]))
    src = df.withColumn("tw_ts_us", epoch_micros(df, ts))
    proc = P.LateFlags(order, "tw_ts_us", cols, int(delay_seconds * 1_000_000))
    return keyed(src, key, proc, _schema(df, cols, "is_late boolean"))


def ttl_value(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
              ttl_ms: int, write_above: float = 10, refresh: str = "read_write") -> DataFrame:
    cols = list(dict.fromkeys([*key, *order, value]))
    vt = _type(df, value)
    proc = P.TtlValue(order, value, cols, ttl_ms, write_above, refresh, vt)
    return keyed(df, key, proc, _schema(df, cols, f"state {vt}"), time_mode="ProcessingTime")


# -- windows ----------------------------------------------------------------------

def window_agg(df: DataFrame, key: Sequence[str], ts: str, size: str, slide: str | None,
               delay: str, aggs: dict[str, Column]) -> DataFrame:
    """Event-time tumbling/sliding windows; append mode emits a window once
    the watermark passes its end."""
    src = event_time(df, ts, delay)
    w = F.window(ts, size, slide or size)
    out = src.groupBy(*key, w.alias("_w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*key, F.col("_w").start.alias("window_start"),
                      F.col("_w").end.alias("window_end"), *aggs)


def session_agg(df: DataFrame, key: Sequence[str], ts: str, gap: str, delay: str,
                aggs: dict[str, Column]) -> DataFrame:
    src = event_time(df, ts, delay)
    w = F.session_window(ts, gap)
    out = src.groupBy(*key, w.alias("_w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*key, F.col("_w").start.alias("window_start"),
                      F.col("_w").end.alias("window_end"), *aggs)


def processing_time_window(df: DataFrame, key: Sequence[str], size: str,
                           aggs: dict[str, Column], slide: str | None = None) -> DataFrame:
    """Windows on arrival time: every row is stamped with the micro-batch's
    clock (``current_timestamp`` is fixed per micro-batch). Use update mode."""
    src = df.withColumn("_pt", F.current_timestamp())
    w = F.window("_pt", size, slide or size)
    out = src.groupBy(*key, w.alias("_w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*key, F.col("_w").start.alias("window_start"),
                      F.col("_w").end.alias("window_end"), *aggs)


def window_topn(df: DataFrame, item: str, ts: str, size: str, slide: str, n: int,
                delay: str, ascending: bool = False) -> DataFrame:
    """Per-window top-N in a stream, in two stateful steps: counts per
    (item, sliding window), emitted once per window when the watermark
    passes it (append mode); then a processor keyed by window keeps only the
    n best (count, item) pairs and emits them with their rank from an
    event-time timer at the window end. Ties by item."""
    src = event_time(df, ts, delay)
    w = F.window(ts, size, slide)
    counts = (src.groupBy(F.col(item), w.alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      F.col(item).cast("string").alias(item), "cnt",
                      F.unix_millis(F.col("w.end")).alias("end_ms")))
    proc = P.WindowTopN(n, item, ascending)
    schema = (f"window_start timestamp, window_end timestamp, rank bigint, "
              f"`{item}` string, cnt bigint")
    return keyed(counts, ["window_start", "window_end"], proc, schema, time_mode="EventTime")


# -- joins ------------------------------------------------------------------------

def window_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str,
                right_ts: str, size: str, delay: str) -> DataFrame:
    """Stream-stream join on (key, tumbling window). The watermark is on the
    raw times; they become the window before the join (as its struct, so that
    a window is kept until the watermark passes its end, and a row is late
    only for a window that has closed). Output: key, window_start,
    window_end, then the remaining columns without the raw times."""
    def side(df, ts):
        return event_time(df, ts, delay).withColumn("tw_window", F.window(ts, size)).drop(ts)
    joined = side(left, left_ts).join(side(right, right_ts), [*key, "tw_window"], "inner")
    rest = [c for c in joined.columns if c not in (*key, "tw_window")]
    return joined.select(*key, F.col("tw_window.start").alias("window_start"),
                         F.col("tw_window.end").alias("window_end"), *rest)


def interval_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str,
                  right_ts: str, lower_s: float, upper_s: float, delay: str) -> DataFrame:
    """Stream-stream interval join; the time range lets Spark evict state
    older than the watermark minus the range."""
    l = event_time(left, left_ts, delay)
    r = event_time(right, right_ts, delay)

    def shifted(c: Column, secs: float) -> Column:
        iv = F.expr(f"INTERVAL '{abs(secs)}' SECOND")
        return c - iv if secs < 0 else c + iv

    cond = [l[k] == r[k] for k in key] + [F.col(right_ts) >= shifted(F.col(left_ts), lower_s),
                                          F.col(right_ts) <= shifted(F.col(left_ts), upper_s)]
    out = l.join(r, cond, "inner")
    return out.select(*[l[k] for k in key],
                      *[l[c] for c in left.columns if c not in key],
                      *[r[c] for c in right.columns if c not in key])


def window_cogroup(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str,
                   right_ts: str, size: str, delay: str, left_aggs: dict,
                   right_aggs: dict) -> DataFrame:
    """Stream window coGroup: the tagged union of both streams aggregated per
    (key, window) under one watermark; append mode emits a (key, window)
    once the watermark passes its end, with nulls for a side without rows."""
    from ..operators.joins import cogroup_union
    u, exprs = cogroup_union(left, right, key, left_ts, right_ts, left_aggs, right_aggs)
    u = event_time(u, "_ts", delay)
    out = u.groupBy(*key, F.window("_ts", size).alias("_w")).agg(*exprs)
    return out.select(*key, F.col("_w").start.alias("window_start"),
                      F.col("_w").end.alias("window_end"), *left_aggs, *right_aggs)


def stamp_ingest_time(df: DataFrame, col: str = "ingest_ts") -> DataFrame:
    """Arrival-time column for processing-time joins and windows: stamp each
    input once where it lands (write the stamped stream out, or join on it
    in the same query); joins on the stamp are then ordinary event-time joins
    and replay the same way after a restart."""
    return df.withColumn(col, F.current_timestamp())


def connect_join(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner equi-join of two streams with both sides kept in state (no
    watermark: state grows with distinct keys, as in the keyed connect)."""
    return left.join(right, list(key), "inner")
