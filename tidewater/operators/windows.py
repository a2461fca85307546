"""Windows: time (tumbling, sliding, session), count (tumbling, sliding),
global with a count trigger, non-keyed, and full-window functions.

Time windows are ``groupBy(key, window(...))`` hash aggregates: partial
aggregation runs before the shuffle, so the shuffle carries one row per
(task, key, window) rather than one per input row. Results are flattened to
``window_start`` / ``window_end``. Count windows number rows with the keyed
prefix scan and then use the same hash aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_micros
from . import grouped, scan

W = "_tw_window"


def _flatten(df: DataFrame, key: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(*key, F.col(W).start.alias("window_start"),
                     F.col(W).end.alias("window_end"), *names)


def _aliased(aggs: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def tumbling(df: DataFrame, key: Sequence[str], ts: str, size: str,
             aggs: dict[str, Column], offset: str | None = None) -> DataFrame:
    """Epoch-aligned ``[start, start + size)`` windows per key."""
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    return _flatten(df.groupBy(*key, w.alias(W)).agg(*_aliased(aggs)), key, list(aggs))


def sliding(df: DataFrame, key: Sequence[str], ts: str, size: str, slide: str,
            aggs: dict[str, Column]) -> DataFrame:
    """Overlapping windows: each row lands in ceil(size / slide) windows,
    whose starts are multiples of ``slide`` (they can be negative)."""
    w = F.window(ts, size, slide)
    return _flatten(df.groupBy(*key, w.alias(W)).agg(*_aliased(aggs)), key, list(aggs))


def session(df: DataFrame, key: Sequence[str], ts: str, gap: str,
            aggs: dict[str, Column], tiebreak: Sequence[str] = (),
            hot_rows: int | None = None) -> DataFrame:
    """Session windows closing after ``gap`` without rows; rows exactly one
    gap apart share a session. ``window_end`` = last row + gap. A row without
    a time is in no session.

    Without hot keys this is Spark's session window (shuffle by key, sort,
    merge sessions). A hot key would put all its rows in one sort, so then
    sessions are numbered with the chunked keyed scan instead (a session
    starts where the gap to the previous row exceeds ``gap``) and aggregated
    by (key, session number) with partial aggregation."""
    user_key = list(key)
    df, key = scan.keyed(df.filter(F.col(ts).isNotNull()), user_key)
    order = [ts, *tiebreak]
    plan = scan.plan_chunks(df, key, order, hot_rows)
    if plan is None:
        w = F.session_window(ts, gap)
        out = df.groupBy(*user_key, w.alias(W)).agg(*_aliased(aggs))
        return _flatten(out, user_key, list(aggs))
    numbered_ = session_numbers(df, key, ts, gap, order, plan=plan)
    out = (numbered_.groupBy(*key, "_sid")
           .agg(F.min(ts).alias("window_start"),
                (F.max(ts) + F.expr(f"INTERVAL {gap}")).alias("window_end"), *_aliased(aggs)))
    return out.select(*user_key, "window_start", "window_end", *aggs)


def gap_micros(df: DataFrame, gap: str) -> int:
    return int(df.sparkSession.sql(
        f"SELECT CAST(unix_micros(TIMESTAMP'1970-01-01 00:00:00 UTC' + INTERVAL {gap}) AS BIGINT)"
    ).first()[0])


def session_numbers(df: DataFrame, key: Sequence[str], ts: str, gap: str, order: Sequence[str],
                    hot_rows: int | None = None, plan: scan.ChunkPlan | None = None) -> DataFrame:
    """Adds ``_sid``, the number of the row's session in its key: one starts where the time
    since the previous row exceeds ``gap``. ``df`` has no row without a time."""
    gap_us = gap_micros(df, gap)
    t = epoch_micros(df, ts)
    plan = plan or scan.plan_chunks(df, key, order, hot_rows)
    df = scan.with_chunks_once(df, key, plan)
    prev = scan.keyed_prefix(df, key, order, {
        "_prev": scan.last_value(t, order, inclusive=False, ignore_nulls=False)},
        plan=plan)
    start = (F.col("_prev").isNull() | (t - F.col("_prev") > F.lit(gap_us))).cast("int")
    return scan.keyed_prefix(prev.withColumn("_start", start), key, order,
                             {"_sid": scan.running_sum("_start")}, plan=plan)


def window_all(df: DataFrame, ts: str, size: str, slide: str | None,
               aggs: dict[str, Column]) -> DataFrame:
    """Non-keyed windows: one result per window over all rows. Partial
    aggregation keeps the work parallel; only one row per task and window
    reaches the final step."""
    w = F.window(ts, size, slide or size)
    return _flatten(df.groupBy(w.alias(W)).agg(*_aliased(aggs)), [], list(aggs))


def full_window(df: DataFrame, key: Sequence[str], ts: str, size: str,
                aggs: dict[str, Column], quantiles: dict[str, tuple[str, float]] | None = None,
                hot_rows: int | None = None) -> DataFrame:
    """Full-window function: any native aggregates over all rows of a (key,
    tumbling window), and exact quantiles ``name: (column, q)``.

    The aggregates are one hash aggregation with partial combine; each
    quantile is ranked in parts (``aggregates.exact_quantile``), so no
    window's values meet in one task. All of them come in one row per window."""
    from .aggregates import exact_quantile
    w = F.window(ts, size)
    names = [*key, "window_start", "window_end"]
    framed = df.select("*", w.start.alias("window_start"), w.end.alias("window_end"))
    out = framed.groupBy(*names).agg(*_aliased(aggs or {"_n": F.count(F.lit(1))}))
    for name, (col, q) in (quantiles or {}).items():
        part = exact_quantile(framed.select(*names, col), names, col, q, hot_rows, name)
        out = scan.null_safe_join(out, part, names)
    return out.select(*names, *aggs, *(quantiles or {}))


def window_quantile(df: DataFrame, key: Sequence[str], ts: str, size: str, value: str,
                    q: float = 0.5, out: str = "quantile",
                    hot_rows: int | None = None) -> DataFrame:
    """Full-window exact quantile (the median for ``q = 0.5``) per key and
    tumbling window, computed by :func:`aggregates.exact_quantile` so no
    window's values are gathered in one task."""
    from .aggregates import exact_quantile
    w = F.window(ts, size)
    framed = df.select(*key, w.start.alias("window_start"), w.end.alias("window_end"), value)
    return exact_quantile(framed, [*key, "window_start", "window_end"], value, q, hot_rows, out)


def process_window(df: DataFrame, key: Sequence[str], ts: str, size: str, order: Sequence[str],
                   fn: Callable[[tuple, grouped.Pieces], Iterable[grouped.Row]], schema,
                   slide: str | None = None) -> DataFrame:
    """Full-window user function: ``fn((*key, window_start, window_end), pieces)`` over the rows of
    every (key, window) in ``order``, as Arrow pieces it takes one after another; no window is held.
    It yields any number of rows of ``schema``. A row without a time is in no window. Output: key,
    window_start, window_end, then ``schema``."""
    w = F.window(ts, size, slide or size)
    framed = df.withColumn(W, w).select("*", F.col(W).start.alias("window_start"),
                                        F.col(W).end.alias("window_end")).drop(W)
    return grouped.process_groups(framed, [*key, "window_start", "window_end"], order, fn, schema)


def session_accumulate(df: DataFrame, key: Sequence[str], ts: str, gap: str, acc, inputs: Sequence[str],
                       out: str, out_type, tiebreak: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """A user accumulator (``accumulate.Accumulator``) over session windows: key, window_start,
    window_end, ``out``. Partial states of one session are merged, wherever its rows were. The
    stream form is ``streaming.user.session_accumulate``."""
    from .accumulate import accumulate
    user_key = list(key)
    rows, key = scan.keyed(df.filter(F.col(ts).isNotNull()), user_key)
    numbered_ = session_numbers(rows, key, ts, gap, [ts, *tiebreak], hot_rows)
    totals = accumulate(numbered_, [*key, "_sid"], acc, inputs, out, out_type)
    spans = numbered_.groupBy(*key, "_sid").agg(
        F.min(ts).alias("window_start"), (F.max(ts) + F.expr(f"INTERVAL {gap}")).alias("window_end"))
    return scan.null_safe_join(spans, totals, [*key, "_sid"]).select(*user_key, "window_start", "window_end", out)


# -- count windows ---------------------------------------------------------------

RN = "_tw_rn"


def numbered(df: DataFrame, key: Sequence[str], order: Sequence[str],
             hot_rows: int | None = None) -> DataFrame:
    """Add ``_tw_rn``: 1-based position of the row inside its key."""
    return scan.keyed_prefix(df, key, order, {RN: scan.running_count()}, hot_rows)


def count_tumbling(df: DataFrame, key: Sequence[str], order: Sequence[str], size: int,
                   aggs: dict[str, Column], hot_rows: int | None = None) -> DataFrame:
    """Fires per key after every ``size`` rows over those rows; an
    incomplete last window never fires. Output: key, ``window_index``
    (0-based), aggregates."""
    rows = numbered(df, key, order, hot_rows)
    grouped = (rows.withColumn("window_index", F.floor((F.col(RN) - 1) / size).cast("bigint"))
               .groupBy(*key, "window_index")
               .agg(F.count(F.lit(1)).alias("_n"), *_aliased(aggs)))
    return grouped.filter(F.col("_n") == size).select(*key, "window_index", *aggs)


def count_sliding(df: DataFrame, key: Sequence[str], order: Sequence[str], size: int,
                  slide: int, aggs: dict[str, Column],
                  hot_rows: int | None = None) -> DataFrame:
    """Fires per key after every ``slide`` rows over the last ``size`` rows
    (fewer at the start). Output: key, ``fire_at`` (row number that fired),
    aggregates.

    Each row is copied to the <= ceil(size / slide) firings that include it
    and the firings are hash-aggregated; a firing exists only if its own row
    exists (max row number in the group equals ``fire_at``).
    """
    rows = numbered(df, key, order, hot_rows)
    first = (F.ceil(F.col(RN) / slide) * slide).cast("bigint")
    last = (F.floor((F.col(RN) + size - 1) / slide) * slide).cast("bigint")
    # with slide > size some rows fall in no firing (first > last)
    firings = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("bigint")))
    fires = rows.withColumn("fire_at", F.explode(firings))
    grouped = (fires.groupBy(*key, "fire_at")
               .agg(F.max(RN).alias("_last"), *_aliased(aggs)))
    return grouped.filter(F.col("_last") == F.col("fire_at")).select(*key, "fire_at", *aggs)


def global_when(df: DataFrame, key: Sequence[str], order: Sequence[str], fires: Column,
                fields: dict[str, scan.Prefix], hot_rows: int | None = None) -> DataFrame:
    """Global window with a predicate trigger: after every row for which
    ``fires`` holds, emit the aggregate over all the key's rows so far. ``fires``
    may use the row's columns, ``_tw_rn`` (its position in the key) and the
    fields' running values. Output: key, order, ``fire_at``, fields."""
    outputs = {RN: scan.running_count(), **fields}
    rows = scan.keyed_prefix(df, key, order, outputs, hot_rows)
    return (rows.filter(fires)
            .select(*dict.fromkeys([*key, *order]), F.col(RN).cast("bigint").alias("fire_at"), *fields))


def global_every(df: DataFrame, key: Sequence[str], order: Sequence[str], every: int,
                 fields: dict[str, scan.Prefix], hot_rows: int | None = None) -> DataFrame:
    """Global window (one per key, never purged) with a count trigger: after
    every ``every``-th row of a key, emit the aggregate over all its rows so
    far. Output: key, ``fire_at``, fields."""
    outputs = {RN: scan.running_count(), **fields}
    rows = scan.keyed_prefix(df, key, order, outputs, hot_rows)
    return (rows.filter(F.col(RN) % every == 0)
            .select(*key, F.col(RN).cast("bigint").alias("fire_at"), *fields))
