"""Two-input operators: tumbling-window join, window coGroup, interval join
and the keyed connect (symmetric hash) join.

The joins are equi-joins on the key plus a time term, so Spark plans a
shuffle (or broadcast, when the planner's size estimate allows) hash or
sort-merge join, and AQE splits skewed join partitions at run time. The
coGroup is not a join: both inputs are tagged, unioned and aggregated once
per (key, window).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_micros
from . import grouped

WSTART = "window_start"
WEND = "window_end"


def _window_start(ts: str, size: str) -> Column:
    return F.window(ts, size).start


def _apart(left: DataFrame, right: DataFrame, key: Sequence[str],
           right_ts: str) -> tuple[DataFrame, DataFrame, str]:
    """Renames right columns that the left side has too (but for the key)."""
    clash = [c for c in right.columns if c in left.columns and c not in key]
    right = right.select(*[F.col(c).alias(f"right_{c}") if c in clash else F.col(c) for c in right.columns])
    return left, right, f"right_{right_ts}" if right_ts in clash else right_ts


def window_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str,
                right_ts: str, size: str) -> DataFrame:
    """Inner join of rows with the same key in the same tumbling window:
    every left row pairs with every right row of its (key, window). Output:
    key, window_start, window_end, then the remaining left and right columns;
    a right column named like a left one gets the prefix ``right_``."""
    w = F.window(left_ts, size)
    left, right, right_ts = _apart(left, right, key, right_ts)
    l = left.withColumn(WSTART, w.start).withColumn(WEND, w.end)
    r = right.withColumn(WSTART, _window_start(right_ts, size))
    joined = l.join(r, [*key, WSTART], "inner")
    rest = [c for c in joined.columns if c not in (*key, WSTART, WEND)]
    return joined.select(*key, WSTART, WEND, *rest)


CoSpec = tuple[str, "str | Column"]


def _side_agg(kind: str, col: Column, present: Column) -> Column:
    if kind == "count":
        agg = F.count(col)
    elif kind == "sum":
        agg = F.sum(col)
    elif kind == "min":
        agg = F.min(col)
    elif kind == "max":
        agg = F.max(col)
    elif kind == "avg":
        agg = F.avg(col)
    else:
        raise ValueError(f"unknown coGroup aggregate {kind!r}")
    return F.when(present > 0, agg)


def cogroup_union(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str,
                  right_ts: str, left_aggs: dict[str, CoSpec],
                  right_aggs: dict[str, CoSpec]) -> tuple[DataFrame, list[Column]]:
    """Both inputs as one frame (key, ``_ts``, side flag, one column per
    aggregate input) and the side-restricted aggregate expressions."""
    def side(df, ts, aggs, tag):
        def col(c):
            if isinstance(c, str):
                return F.lit(1) if c == "*" else F.col(c)
            return c
        inputs = [col(c).alias(f"_{tag}_{n}") for n, (_, c) in aggs.items()]
        return df.select(*key, F.col(ts).alias("_ts"), F.lit(tag).alias("_side"), *inputs)
    u = side(left, left_ts, left_aggs, "l").unionByName(
        side(right, right_ts, right_aggs, "r"), allowMissingColumns=True)
    n_l = F.count(F.when(F.col("_side") == "l", 1))
    n_r = F.count(F.when(F.col("_side") == "r", 1))
    exprs = ([_side_agg(k, F.col(f"_l_{n}"), n_l).alias(n) for n, (k, _) in left_aggs.items()]
             + [_side_agg(k, F.col(f"_r_{n}"), n_r).alias(n) for n, (k, _) in right_aggs.items()])
    return u, exprs


def window_cogroup(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str,
                   right_ts: str, size: str, left_aggs: dict[str, CoSpec],
                   right_aggs: dict[str, CoSpec]) -> DataFrame:
    """Per (key, tumbling window): one result from each side's rows; a side
    without rows in that window gives nulls (full outer semantics).

    Each side's function is an aggregate spec ``name: (kind, column)`` with
    kind count (column ``"*"`` counts rows), sum, min, max or avg. The two
    inputs are tagged and unioned and a single aggregation per (key, window)
    computes both sides, with partial aggregation before its one shuffle; the
    same plan runs on streams. For any other function of both sides' rows
    see :func:`window_cogroup_process`.
    """
    u, exprs = cogroup_union(left, right, key, left_ts, right_ts, left_aggs, right_aggs)
    w = F.window("_ts", size)
    out = u.groupBy(*key, w.alias("_w")).agg(*exprs)
    return out.select(*key, F.col("_w").start.alias(WSTART), F.col("_w").end.alias(WEND),
                      *left_aggs, *right_aggs)


CoFunction = Callable[[tuple, grouped.Pieces, grouped.Pieces], Iterable[grouped.Row]]


def _two_sides(fn: CoFunction, columns: list[dict[str, str]], side: str):
    """Gives ``fn`` the pieces of a group, sorted by side, as two iterators under the sides' own names."""
    def run(key: tuple, pieces: grouped.Pieces) -> Iterator[grouped.Row]:
        waiting: list[pa.RecordBatch] = []              # the right side's first piece, found behind the left side
        rest = iter(pieces)

        def named(p: pa.RecordBatch, k: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([p.column(p.schema.get_field_index(c)) for c in columns[k].values()],
                                              names=list(columns[k]))

        def left() -> grouped.Pieces:
            while not waiting:
                p = next(rest, None)
                if p is None:
                    return
                tags = p.column(p.schema.get_field_index(side))
                n = pc.sum(pc.equal(tags, 0)).as_py() or 0
                if n < p.num_rows:
                    waiting.append(p.slice(n))
                if n:
                    yield named(p.slice(0, n), 0)

        first = left()

        def right() -> grouped.Pieces:
            for _ in first:                             # left rows not taken yet are passed over
                pass
            while waiting:
                yield named(waiting.pop(), 1)
            for p in rest:
                yield named(p, 1)

        yield from fn(key, first, right())
    return run


def window_cogroup_process(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str, right_ts: str,
                           size: str, left_order: Sequence[str], right_order: Sequence[str], fn: CoFunction,
                           schema) -> DataFrame:
    """Window coGroup with a user function: ``fn((*key, window_start, window_end), left_pieces,
    right_pieces)`` once for every (key, window) that has rows on either side.

    Both sides go through one shuffle, tagged and sorted by (key, window, side, order), and the
    function takes them as two iterators over Arrow batches of the sides' own columns, the left one
    first: rows of the left side it hasn't taken when it asks for the right one are passed over. So a
    group of any size is streamed, and only what the function keeps is held. Output: key,
    window_start, window_end, then ``schema``.
    """
    key = list(key)
    columns = [{c: f"tw{k}_{i}" for i, c in enumerate(df.columns)} for k, df in enumerate((left, right))]

    def side(df: DataFrame, ts: str, order: Sequence[str], tag: int) -> DataFrame:
        w = F.window(ts, size)
        place = F.struct(*[F.col(o) for o in order]) if order else F.lit(None).cast("struct<x:int>")
        return (df.withColumn("_tw_w", w)
                .select(*key, F.col("_tw_w").start.alias(WSTART), F.col("_tw_w").end.alias(WEND), F.lit(tag).alias("_tw_side"),
                        place.alias(f"_tw_place{tag}"), *[F.col(c).alias(n) for c, n in columns[tag].items()]))

    both = side(left, left_ts, left_order, 0).unionByName(side(right, right_ts, right_order, 1), allowMissingColumns=True)
    group = [*key, WSTART, WEND]
    return grouped.process_groups(both, group, ["_tw_side", "_tw_place0", "_tw_place1"],
                                  _two_sides(fn, columns, "_tw_side"), schema,
                                  ["_tw_side", *columns[0].values(), *columns[1].values()])


def interval_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str,
                  right_ts: str, lower_s: float, upper_s: float,
                  bucket_s: float | None = None) -> DataFrame:
    """Inner join on key with ``left_ts + lower_s <= right_ts <= left_ts + upper_s``
    (seconds, both ends inclusive).

    The time range becomes an extra equi-key: right rows are placed in one
    time bucket, left rows are copied to every bucket their range touches
    (the bucket width defaults to the range length, so two or three copies),
    and the exact range is checked after the equi-join. Each pair is found
    once, and a hot key is split by time instead of being compared
    row-by-row inside one sort-merge group. A right column named like a left
    one gets the prefix ``right_``.
    """
    left, right, right_ts = _apart(left, right, key, right_ts)
    width = int(max(1.0, bucket_s or (upper_s - lower_s)) * 1_000_000)
    lo, hi = int(lower_s * 1_000_000), int(upper_s * 1_000_000)

    lt_us = epoch_micros(left, left_ts)
    rt_us = epoch_micros(right, right_ts)

    def bucket(us: Column) -> Column:               # floor division in integers
        return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("bigint")

    r = right.withColumn("_tw_r", rt_us).withColumn("_tw_b", bucket(F.col("_tw_r")))
    l = left.withColumn("_tw_l", lt_us).withColumn(
        "_tw_b", F.explode(F.sequence(bucket(F.col("_tw_l") + lo), bucket(F.col("_tw_l") + hi))))
    joined = l.join(r, [*key, "_tw_b"], "inner")
    delta = F.col("_tw_r") - F.col("_tw_l")
    return joined.filter((delta >= lo) & (delta <= hi)).drop("_tw_b", "_tw_l", "_tw_r")


def connect_join(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keyed connect with both sides cached by key: every left row meets every
    right row with the same key exactly once = an inner equi-join."""
    return left.join(right, list(key), "inner")
