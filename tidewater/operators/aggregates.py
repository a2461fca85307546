"""Keyed aggregations in two shapes.

``final``: one row per key (what a keyed aggregate holds at end of input);
hash aggregation with map-side partial combine, so a hot key is reduced
before the shuffle.

``rolling``: one row per input row with the aggregate so far (what a keyed
stream emits on every update), via the skew-aware keyed prefix scan.

A field spec is ``(kind, column)`` with kind one of sum, count, max, min,
first, last (first/last in arrival order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import order_struct
from . import scan

Spec = tuple[str, str | Column]


def _c(expr: str | Column) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


def _final_expr(kind: str, col: Column, order: Column) -> Column:
    if kind == "sum":
        return F.sum(col)
    if kind == "count":
        return F.count(col)
    if kind == "max":
        return F.max(col)
    if kind == "min":
        return F.min(col)
    if kind == "first":
        return F.min_by(col, order)
    if kind == "last":
        return F.max_by(col, order)
    raise ValueError(f"unknown aggregate kind {kind!r}")


def _rolling_expr(kind: str, col: Column, order: Sequence[str]) -> scan.Prefix:
    if kind == "sum":
        return scan.running_sum(col)
    if kind == "count":
        return scan.running_count(col)
    if kind == "max":
        return scan.running_max(col)
    if kind == "min":
        return scan.running_min(col)
    if kind == "first":
        return scan.first_value(col, order, ignore_nulls=False)
    if kind == "last":
        return scan.last_value(col, order, ignore_nulls=False)
    raise ValueError(f"unknown aggregate kind {kind!r}")


def final(df: DataFrame, key: Sequence[str], order: Sequence[str],
          fields: dict[str, Spec]) -> DataFrame:
    """One row per key. All ``first`` fields come from one ``min`` over a
    single (order, fields) struct and all ``last`` fields from one ``max``,
    so a row is compared once per direction however many fields it carries."""
    ordering = order_struct(df, order)
    aggs, result = [], {}
    for name, (kind, col) in fields.items():
        if kind not in ("first", "last"):
            aggs.append(_final_expr(kind, _c(col), ordering).alias(name))
            result[name] = F.col(name)
    for kind, fn in (("first", F.min), ("last", F.max)):
        chosen = [(n, _c(col)) for n, (k, col) in fields.items() if k == kind]
        if chosen:
            packed = F.struct(ordering.alias("_o"),
                              *[c.alias(f"f{i}") for i, (_, c) in enumerate(chosen)])
            aggs.append(fn(packed).alias(f"_{kind}"))
            for i, (n, _) in enumerate(chosen):
                result[n] = F.col(f"_{kind}").getField(f"f{i}")
    out = df.groupBy(*key).agg(*aggs)
    return out.select(*key, *[result[n].alias(n) for n in fields])


def rolling(df: DataFrame, key: Sequence[str], order: Sequence[str],
            fields: dict[str, Spec], keep: Sequence[str] = (),
            hot_rows: int | None = None) -> DataFrame:
    """Input columns ``keep`` (plus key and order) and one running column per field."""
    base = df.select(*dict.fromkeys([*key, *order, *keep, *_refs(fields)]))
    out = scan.keyed_prefix(base, key, order,
                            {name: _rolling_expr(kind, _c(col), order)
                             for name, (kind, col) in fields.items()}, hot_rows)
    return out.select(*dict.fromkeys([*key, *order, *keep]), *fields)


def _refs(fields: dict[str, Spec]) -> list[str]:
    return [col for _, col in fields.values() if isinstance(col, str)]


# -- the keyed-stream aggregates ------------------------------------------------

def simple_fields(kind: str, value: str, other: Sequence[str],
                  rolling_: bool = False) -> dict[str, Spec]:
    """sum/max/min of ``value``; every other field keeps the key's first row
    (named ``first_<field>`` in the rolling shape, next to the current row's
    order columns)."""
    name = (lambda c: f"first_{c}") if rolling_ else (lambda c: c)
    return {value: (kind, value), **{name(c): ("first", c) for c in other}}


def keyed_sum(df, key, order, value, other=(), rolling_=False, hot_rows=None):
    fields = simple_fields("sum", value, other, rolling_)
    return (rolling(df, key, order, fields, hot_rows=hot_rows) if rolling_
            else final(df, key, order, fields))


def keyed_max(df, key, order, value, other=(), rolling_=False, hot_rows=None):
    fields = simple_fields("max", value, other, rolling_)
    return (rolling(df, key, order, fields, hot_rows=hot_rows) if rolling_
            else final(df, key, order, fields))


def keyed_min(df, key, order, value, other=(), rolling_=False, hot_rows=None):
    fields = simple_fields("min", value, other, rolling_)
    return (rolling(df, key, order, fields, hot_rows=hot_rows) if rolling_
            else final(df, key, order, fields))


def extreme_row(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                columns: Sequence[str], largest: bool = True, rolling_: bool = False,
                hot_rows: int | None = None) -> DataFrame:
    """maxBy / minBy: the whole row holding the extreme ``value``; on a tie
    the earlier row (in ``order``) is kept."""
    row = F.struct(*[F.col(c) for c in columns])
    tie = order_struct(df, order, reverse=largest)
    # a row without a value is never the extreme one; a key of such rows keeps its first
    rank = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("x"), tie.alias("t")))
    if not rolling_:
        pick = F.max_by(row, rank) if largest else F.min_by(row, rank)
        pick = F.coalesce(pick, F.min_by(row, order_struct(df, order)))
        return df.groupBy(*key).agg(pick.alias("_row")).select(*key, *[
            F.col("_row").getField(c).alias(c) for c in columns if c not in key])
    base = df.select(*dict.fromkeys([*key, *order, *columns]))
    out = scan.keyed_prefix(base, key, order, {
        "_best": scan.arg_extreme(row, rank, largest),
        "_first": scan.first_value(row, order, ignore_nulls=False)}, hot_rows)
    out = out.withColumn("_row", F.coalesce("_best", "_first"))
    # the current row's position comes first (at_<order>), then the picked row
    cur = [F.col(o).alias(f"at_{o}") for o in order]
    return out.select(*key, *cur, *[F.col("_row").getField(c).alias(c)
                                    for c in columns if c not in key])


def reduce_with(df: DataFrame, key: Sequence[str], order: Sequence[str],
                reducers: dict[str, tuple[scan.Monoid, str | Column]], rolling_: bool = False,
                keep: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """A user's associative reduce: ``name: (monoid, column)``, a :class:`scan.Monoid`
    with its aggregate over rows, its combine over partial results and its merge
    of two of them. Final (one row per key) or rolling (after each row)."""
    if not rolling_:
        return df.groupBy(*key).agg(*[m.partial(_c(c)).alias(n) for n, (m, c) in reducers.items()])
    cols = list(dict.fromkeys([*key, *order, *keep]))
    refs = [c for _, c in reducers.values() if isinstance(c, str)]
    base = df.select(*dict.fromkeys([*cols, *refs])) if len(refs) == len(reducers) else df
    out = scan.keyed_prefix(base, key, order, {
        f"_r_{n}": scan.Prefix(m, _c(c)) for n, (m, c) in reducers.items()}, hot_rows)
    return out.select(*cols, *[F.col(f"_r_{n}").alias(n) for n in reducers])


def reduce_sum_latest(df, key, order, value, latest=(), rolling_=False, hot_rows=None):
    """The demo reduce ``(id, latest ts, vc1 + vc2)``: sum of ``value`` and the
    latest value of every ``latest`` column. The first row of a key comes
    out unchanged."""
    fields = {value: ("sum", value), **{c: ("last", c) for c in latest}}
    return (rolling(df, key, order, fields, hot_rows=hot_rows) if rolling_
            else final(df, key, order, fields))


def average(df, key, order, value, rolling_=False, hot_rows=None, keep=()):
    """Mean of ``value``; ``sum`` and ``n`` are returned too so the caller can
    choose the division (exact decimal sums stay exact)."""
    fields = {"sum": ("sum", value), "n": ("count", value)}
    out = (rolling(df, key, order, fields, keep=keep, hot_rows=hot_rows) if rolling_
           else final(df, key, order, fields))
    return out.withColumn("mean", F.col("sum") / F.col("n"))


def value_counts(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Count of each value per key (final map-state content)."""
    return df.groupBy(*key, value).agg(F.count(F.lit(1)).alias("cnt"))


def value_counts_rolling(df, key, order, value, keep=(), hot_rows=None):
    """After each row: how often its value has been seen for its key so far."""
    return rolling(df, [*key, value], order, {"cnt": ("count", F.lit(1))},
                   keep=keep, hot_rows=hot_rows)


def exact_quantile(df: DataFrame, group: Sequence[str], value: str, q: float = 0.5,
                   hot_rows: int | None = None, out: str = "quantile") -> DataFrame:
    """Exact quantile per group with linear interpolation between the two
    ranks around ``q * (n - 1)`` (the median for ``q = 0.5``).

    No group is gathered in one place: rows are counted per (group, value)
    with map-side combine, cumulative counts in value order come from the
    keyed prefix scan (large groups are split into chunks), and the one or two
    values whose rank range covers the target ranks are picked by a second
    partial aggregation. Nulls are ignored; a group of nulls alone gives null,
    and a null group is a group like any other.
    """
    group = list(group)
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c")))
    ranked = scan.keyed_prefix(counts, group, [value],
                               {"_cum": scan.running_sum("_c")}, hot_rows)
    totals = df.groupBy(*group).agg(F.count(value).alias("_n"))
    pos = F.lit(float(q)) * (F.col("_n") - 1)
    lo_r, hi_r = F.floor(pos), F.ceil(pos)
    first = F.col("_cum") - F.col("_c")
    covers = lambda r: (first <= r) & (r < F.col("_cum"))
    picked = (scan.null_safe_join(totals, ranked, group)
              .groupBy(*group)
              .agg(F.max(F.when(covers(lo_r), F.col(value))).alias("_lo"),
                   F.max(F.when(covers(hi_r), F.col(value))).alias("_hi"),
                   F.first(pos).alias("_pos")))
    lo, hi, p = F.col("_lo").cast("double"), F.col("_hi").cast("double"), F.col("_pos")
    interp = F.when(F.floor(p) == F.ceil(p), lo).otherwise(
        (F.ceil(p) - p) * lo + (p - F.floor(p)) * hi)
    return picked.select(*group, interp.alias(out))
