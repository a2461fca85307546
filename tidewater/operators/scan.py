"""Keyed prefix scans: a running result per row, inside a key, in arrival order.

This is the batch form of per-key state that is updated row by row and read
after each update. It is expressed with Spark window frames
(``rowsBetween(unboundedPreceding, currentRow)``), which keep a whole key in
one task. A key may hold a large share of all rows, so hot keys are split:

1. a seeded sample of the rows gives chunk boundaries: about
   ``BOUNDS_PER_HOT`` of every ``hot_rows`` rows of a key, by all order
   columns (so rows tied on the first one are still split). Keys that get
   none are one chunk. No pass counts or shuffles the input, and nothing is
   sorted but the boundaries. The boundary table is checkpointed to the
   shared folder so that a re-run stage assigns rows to the same chunks.
2. the running frame is evaluated per (key, chunk), in parallel;
3. per (key, chunk) summaries (one row per chunk) are combined over the
   earlier chunks to a carry-in and merged into every row.

A scan of the whole input as one stream has no key to shuffle by. Its rows
are range-partitioned by the order columns and written once to the shared
folder, each with its range partition as its chunk (``ranges``); no boundary
is looked up. The chunks' summaries are combined in groups of ``CARRY_FAN``,
the groups' in groups again, so no task holds all of them.

Results - rows and types - are those of the unsplit scan for any associative
aggregate (sum, count, min, max and max/min over structs, which gives first,
last and arg-max). A null key is a key like any other. Both helper tables
have one row per chunk of a split key; Spark chooses how to join them by
their size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_path

HOT_ROWS_CONF = "tidewater.scan.hotKeyRows"
DEFAULT_HOT_ROWS = 4_000_000
BOUNDS_PER_HOT = 4         # boundaries sampled from hot_rows rows, on average
CARRY_FAN = 1024           # chunk summaries combined in one group, scanning one whole stream

CHUNK = "_tw_chunk"
HOT = "_tw_hot"
BOUNDS = "_tw_bounds"
ALL = "_tw_all"


@dataclass(frozen=True)
class Monoid:
    """An associative aggregate: window/chunk aggregate, combine, merge."""

    partial: Callable[[Column], Column]
    combine: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]


def _add(carry: Column, local: Column) -> Column:
    return (F.when(carry.isNull(), local)
            .when(local.isNull(), carry)
            .otherwise(carry + local))


SUM = Monoid(F.sum, F.sum, _add)
# a count is never null, split or not
COUNT = Monoid(F.count, F.sum, lambda c, l: F.coalesce(c + l, l, c))
MAX = Monoid(F.max, F.max, lambda c, l: F.greatest(c, l))
MIN = Monoid(F.min, F.min, lambda c, l: F.least(c, l))


@dataclass(frozen=True)
class Prefix:
    """One running output: ``monoid`` over ``expr`` for the rows up to the
    current one (``inclusive``) or strictly before it. ``field`` extracts a
    struct field from the result (used by first/last/arg-max forms)."""

    monoid: Monoid
    expr: Column
    inclusive: bool = True
    field: str | None = None


# -- convenience constructors -------------------------------------------------

def running_sum(expr: Column | str, inclusive: bool = True) -> Prefix:
    return Prefix(SUM, _c(expr), inclusive)


def running_count(expr: Column | str | None = None, inclusive: bool = True) -> Prefix:
    return Prefix(COUNT, F.lit(1) if expr is None else _c(expr), inclusive)


def running_max(expr: Column | str, inclusive: bool = True) -> Prefix:
    return Prefix(MAX, _c(expr), inclusive)


def running_min(expr: Column | str, inclusive: bool = True) -> Prefix:
    return Prefix(MIN, _c(expr), inclusive)


def last_value(expr: Column | str, order: Sequence[str], inclusive: bool = True,
               ignore_nulls: bool = True) -> Prefix:
    """Latest value in arrival order (``inclusive=False``: the previous row's)."""
    e = _c(expr)
    packed = F.struct(*[F.col(o) for o in order], e.alias("v"))
    if ignore_nulls:
        packed = F.when(e.isNotNull(), packed)
    return Prefix(MAX, packed, inclusive, "v")


def first_value(expr: Column | str, order: Sequence[str], ignore_nulls: bool = True) -> Prefix:
    e = _c(expr)
    packed = F.struct(*[F.col(o) for o in order], e.alias("v"))
    if ignore_nulls:
        packed = F.when(e.isNotNull(), packed)
    return Prefix(MIN, packed, True, "v")


def arg_extreme(row: Column, rank: Column, largest: bool = True) -> Prefix:
    """Row with the largest (or smallest) ``rank`` struct so far."""
    packed = F.when(rank.isNotNull(), F.struct(rank.alias("r"), row.alias("v")))
    return Prefix(MAX if largest else MIN, packed, True, "v")


def _c(expr: Column | str) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


# -- chunk planning -----------------------------------------------------------

@dataclass
class ChunkPlan:
    bounds: DataFrame | None   # key columns + BOUNDS array<struct(order)>, split keys only; None: one whole stream
    order: list[str]           # the order columns the boundaries are made of


def _conf_int(df: DataFrame, name: str, default: int) -> int:
    value = df.sparkSession.conf.get(name, None)
    return int(value) if value not in (None, "") else default


SAMPLE_SEED = 17


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join on same-named columns in which null equals null; keeps the left ones."""
    names = {c: f"_tw_on_{i}" for i, c in enumerate(on)}
    renamed = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    cond = F.lit(True)
    for c, other in names.items():
        cond = cond & left[c].eqNullSafe(renamed[other])
    return left.join(renamed, cond, how).drop(*names.values())


def plan_chunks(df: DataFrame, key: Sequence[str], order: Sequence[str] | str,
                hot_rows: int | None = None) -> ChunkPlan | None:
    """Boundaries that split large keys into ordered chunks.

    Every row is a boundary of its key with chance ``BOUNDS_PER_HOT / hot_rows``,
    so a key of ``hot_rows`` rows gets some four chunks and a larger one
    proportionally more; with ``hot_rows`` <= ``BOUNDS_PER_HOT`` every row is
    its own chunk. Returns ``None`` when no key got any (then the plain keyed
    window is exact and no key is far above ``hot_rows`` rows). A scan of one
    whole stream (key ``ALL``) always gets a plan, without boundaries.
    """
    hot_rows = hot_rows if hot_rows is not None else _conf_int(df, HOT_ROWS_CONF,
                                                                DEFAULT_HOT_ROWS)
    if hot_rows <= 0:            # splitting switched off: keys are known to be balanced
        return None
    key = list(key)
    order = [order] if isinstance(order, str) else list(order)
    if key == [ALL]:
        return ChunkPlan(None, order)
    pos = F.struct(*[F.col(o) for o in order])
    fraction = min(1.0, BOUNDS_PER_HOT / hot_rows)
    sample = (df.sample(withReplacement=False, fraction=fraction, seed=SAMPLE_SEED)
              .select(*key, pos.alias("_pos")))
    bounds = sample.groupBy(*key).agg(F.array_sort(F.collect_set("_pos")).alias(BOUNDS))
    # A re-run stage must see the same boundaries, so the (small) table is
    # written to the shared folder instead of being recomputed.
    ensure_checkpoint_dir(df.sparkSession)
    bounds = bounds.checkpoint(eager=True)
    if not bounds.head(1):
        return None
    return ChunkPlan(bounds, order)


def ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with CHUNK, their range partition by the order columns, and HOT.

    Written to the shared folder: the ranges are sampled, so only stored rows are
    in the same range whenever they are read. Rows tied on all order columns share one.
    """
    n = _chunks(df)
    path = shared_path(df.sparkSession, "scan", uuid.uuid4().hex)
    out = df.repartitionByRange(n, *order).withColumn(CHUNK, F.spark_partition_id()).withColumn(HOT, F.lit(True))
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def _chunks(df: DataFrame) -> int:
    """Range partitions of a whole-stream scan."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_chunks(df: DataFrame, key: Sequence[str], plan: ChunkPlan | None) -> DataFrame:
    """Add CHUNK (0 for keys that are not split) and HOT columns.

    A row's chunk is the number of its key's boundaries below its position,
    found in two steps so that no row is compared with every boundary: a
    coarse array (every ceil(sqrt(n))-th boundary, joined on the key) picks
    the block, then that block's <= sqrt(n) boundaries (joined on key and
    block) give the exact count.
    """
    if plan is None:
        return df.withColumn(CHUNK, F.lit(0)).withColumn(HOT, F.lit(False))
    if plan.bounds is None:
        return ranges(df, plan.order)
    key = list(key)
    n = F.size(F.col(BOUNDS))
    step = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    blocks = F.ceil(n / step).cast("int")
    starts = F.sequence(F.lit(0), blocks - 1)
    coarse = plan.bounds.select(
        *key, step.alias("_step"),
        F.transform(starts, lambda i: F.element_at(F.col(BOUNDS), i * step + 1)).alias("_coarse"))
    fine = (plan.bounds.select(*key, BOUNDS, step.alias("_step"), F.explode(starts).alias("_blk"))
            .select(*key, "_blk", F.slice(F.col(BOUNDS), F.col("_blk") * F.col("_step") + 1,
                                          F.col("_step")).alias("_fine")))
    pos = F.struct(*[F.col(o) for o in plan.order])
    with_blk = null_safe_join(df, coarse, key).withColumn(
        "_blk", F.size(F.filter(F.col("_coarse"), lambda b: b < pos)) - 1)
    joined = null_safe_join(with_blk, fine, [*key, "_blk"])
    below = F.col("_blk") * F.col("_step") + F.size(F.filter(F.col("_fine"), lambda b: b < pos))
    chunk = (F.when(F.col("_coarse").isNull() | (F.col("_blk") < 0), F.lit(0))
             .otherwise(below))
    return (joined.withColumn(CHUNK, chunk)
            .withColumn(HOT, F.col("_coarse").isNotNull())
            .drop("_coarse", "_step", "_blk", "_fine"))


def keyed(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``(df, key)`` with a constant key column added when ``key`` is empty,
    so a whole-stream scan can share one chunk plan across passes (drop
    ``ALL`` from the result)."""
    if key:
        return df, list(key)
    return df.withColumn(ALL, F.lit(0)), [ALL]


# -- the scan -----------------------------------------------------------------

_DETECT = object()


def keyed_prefix(df: DataFrame, key: Sequence[str], order: Sequence[str],
                 outputs: dict[str, Prefix], hot_rows: int | None = None,
                 plan: ChunkPlan | None | object = _DETECT) -> DataFrame:
    """Add one running column per entry of ``outputs`` (an output named like
    an input column replaces it).

    ``order`` must be a total order inside a key (e.g. ``ts, event_id``).
    An empty ``key`` scans the whole input as one stream (then the single
    group is split into chunks like any hot key). ``plan`` reuses a chunk
    plan made by :func:`plan_chunks` for the same input rows and key.
    """
    cols = [c for c in df.columns if c not in outputs]
    key = list(key)
    src = df
    if not key:
        src = df.withColumn(ALL, F.lit(0))
        key = [ALL]
    if plan is _DETECT:
        plan = plan_chunks(src, key, order, hot_rows)
    def frames(parts: list[str]):
        w = Window.partitionBy(*parts).orderBy(*order)
        return {True: w.rowsBetween(Window.unboundedPreceding, Window.currentRow),
                False: w.rowsBetween(Window.unboundedPreceding, -1)}

    def finish(c: Column, spec: Prefix) -> Column:
        return c.getField(spec.field) if spec.field else c

    whole = frames(key)
    plain = src.select(*cols, *[
        finish(spec.monoid.partial(spec.expr).over(whole[spec.inclusive]), spec).alias(name)
        for name, spec in outputs.items()])
    if plan is None:
        return plain

    # an input that already carries chunks (multi-pass operators assign them
    # once) is used as is
    chunked = src if CHUNK in src.columns else with_chunks(src, key, plan)
    part = frames([*key, CHUNK])
    local = chunked.select(*dict.fromkeys([*cols, *key, CHUNK, HOT]), *[
        spec.monoid.partial(spec.expr).over(part[spec.inclusive]).alias(f"_l_{name}")
        for name, spec in outputs.items()])
    summary = (chunked.filter(F.col(HOT)).groupBy(*key, CHUNK)
               .agg(*[spec.monoid.partial(spec.expr).alias(f"_s_{name}")
                      for name, spec in outputs.items()]))
    if plan.bounds is None:
        carry = _carry_tree(summary, outputs, _chunks(df))
    else:
        carry = _carries(summary, key, CHUNK, outputs)
    merged = null_safe_join(local, carry, [*key, CHUNK])
    # merging may widen a type (a sum of sums); the unsplit scan's types hold
    types = {f.name: f.dataType for f in plain.schema.fields}
    return merged.select(*cols, *[
        finish(spec.monoid.merge(F.col(f"_c_{name}"), F.col(f"_l_{name}")), spec)
        .cast(types[name]).alias(name) for name, spec in outputs.items()])


def _carries(summary: DataFrame, parts: Sequence[str], chunk: str, outputs: dict[str, Prefix]) -> DataFrame:
    """What the earlier chunks of the same ``parts`` add up to, for each chunk."""
    earlier = Window.partitionBy(*parts).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*dict.fromkeys([*parts, chunk]), *[
        spec.monoid.combine(F.col(f"_s_{name}")).over(earlier).alias(f"_c_{name}")
        for name, spec in outputs.items()])


def _carry_tree(summary: DataFrame, outputs: dict[str, Prefix], chunks: int, chunk: str = CHUNK) -> DataFrame:
    """:func:`_carries` of one whole stream, in groups of CARRY_FAN chunks; groups are chunks of groups."""
    group = f"{chunk}_g"
    grouped = summary.withColumn(group, F.floor(F.col(chunk) / CARRY_FAN).cast("int"))
    inside = _carries(grouped, [ALL, group], chunk, outputs)
    if chunks <= CARRY_FAN:
        return inside.drop(group)
    sums = grouped.groupBy(ALL, group).agg(*[
        spec.monoid.combine(F.col(f"_s_{name}")).alias(f"_s_{name}") for name, spec in outputs.items()])
    above = _carry_tree(sums, outputs, -(-chunks // CARRY_FAN), group)
    above = above.select(ALL, group, *[F.col(f"_c_{name}").alias(f"_a_{name}") for name in outputs])
    return inside.join(above, [ALL, group]).select(ALL, chunk, *[
        spec.monoid.merge(F.col(f"_a_{name}"), F.col(f"_c_{name}")).alias(f"_c_{name}") for name, spec in outputs.items()])


def with_chunks_once(df: DataFrame, key: Sequence[str], plan: ChunkPlan | None) -> DataFrame:
    """Assign chunks up front for several passes of :func:`keyed_prefix`
    over the same rows (drop CHUNK and HOT from the final result)."""
    return df if plan is None else with_chunks(df, key, plan)
