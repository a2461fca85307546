"""Ready keyed-state operators, batch form.

Each one answers, for every row, what a per-key state cell would give after
(or before) that row: a jump alert from a value cell, a running top-k from a
list cell, value counts from a map cell, sums and means from reducing and
aggregating cells, and a value cell with time-to-live. Running forms go
through the skew-aware keyed prefix scan with native window frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_micros
from . import scan


def _c(expr: str | Column) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


# -- value state: jump alert ----------------------------------------------------

def value_jump_alert(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                     threshold: float = 10, initial: float = 0,
                     hot_rows: int | None = None) -> DataFrame:
    """Rows whose value differs from the key's previous value (``initial``
    before the first row) by more than ``threshold``; column ``prev`` holds
    the previous value. The state is updated on every row."""
    out = scan.keyed_prefix(df, key, order,
                            {"prev": scan.last_value(value, order, inclusive=False,
                                                     ignore_nulls=False)}, hot_rows)
    prev = F.coalesce(F.col("prev"), F.lit(initial).cast(df.schema[value].dataType))
    return (out.withColumn("prev", prev)
            .filter(F.abs(F.col(value) - F.col("prev")) > F.lit(threshold)))


# -- list state: running top-k --------------------------------------------------

def running_topk(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                 k: int = 3, keep: Sequence[str] = (), hot_rows: int | None = None,
                 out: str = "top") -> DataFrame:
    """After each row: the ``k`` largest values of its key so far, largest
    first, duplicates kept (nulls are skipped).

    The j-th largest value of a prefix is the running maximum of
    ``min(v, (j-1)-th largest before the row)``: for j = 1 the running max,
    for j > 1 the latest of the top j rows paired with the (j-1)-th largest
    before it. So a row's list is j window frames over one exchange and one
    sort, with no per-row Python. Where keys are split, that gives the list
    inside each chunk; a chunk's last list is its summary, the summaries'
    values go through the same frames to give each chunk the list of all
    earlier ones, and a row's list is the best k of both: the input is
    scanned twice whatever k is.
    """
    cols = list(dict.fromkeys([*key, *order, value, *keep]))
    cur, key = scan.keyed(df.select(*cols), key)
    plan = scan.plan_chunks(cur, key, order, hot_rows)
    if plan is None:
        return _levels(cur, key, order, value, k).select(*cols, _listed(k).alias(out))
    parts = [*key, scan.CHUNK]
    local = _levels(scan.with_chunks(cur, key, plan), parts, order, value, k)
    # a level only grows along a chunk, so its largest value is that of the chunk's last row
    last = (local.filter(F.col(scan.HOT)).groupBy(*parts)
            .agg(*[F.max(f"_t{j}").alias(f"_t{j}") for j in range(1, k + 1)]))
    values = last.select(*parts, F.posexplode(F.array(*[F.col(f"_t{j}") for j in range(1, k + 1)])).alias("_at", "_v"))
    upto = _levels(values, key, [scan.CHUNK, "_at"], "_v", k).groupBy(*parts).agg(
        *[F.max(f"_t{j}").alias(f"_t{j}") for j in range(1, k + 1)])
    carry = upto.select(*parts, F.lag(_listed(k)).over(Window.partitionBy(*key).orderBy(scan.CHUNK)).alias("_carry"))
    both = F.concat(_listed(k), F.coalesce("_carry", F.array().cast(f"array<{df.schema[value].dataType.simpleString()}>")))
    joined = scan.null_safe_join(local, carry, parts)
    return joined.select(*cols, F.slice(F.sort_array(both, asc=False), 1, k).alias(out))


def _levels(df: DataFrame, parts: Sequence[str], order: Sequence[str], value: str, k: int) -> DataFrame:
    """Adds ``_t1`` .. ``_tk``: the j-th largest ``value`` of each row's prefix inside ``parts``."""
    w = Window.partitionBy(*parts).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    v = F.col(value)
    for j in range(1, k + 1):
        level = v if j == 1 else F.when(v.isNotNull() & F.col("_p").isNotNull(), F.least(v, F.col("_p")))
        df = df.withColumn("_c", level)
        df = df.withColumns({f"_t{j}": F.max("_c").over(upto), "_p": F.max("_c").over(before)})
    return df.drop("_c", "_p")


def _listed(k: int) -> Column:
    return F.filter(F.array(*[F.col(f"_t{j}") for j in range(1, k + 1)]), lambda x: x.isNotNull())


def topk_final(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
               k: int = 3) -> DataFrame:
    """Final list-state content: the k largest values per key with their
    rank (ties broken by arrival). Planned as a per-partition top-k limit
    before the shuffle plus a final rank after it."""
    w = Window.partitionBy(*key).orderBy(F.col(value).desc(), *[F.col(o) for o in order])
    return (df.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select(*key, F.col("rank").cast("bigint").alias("rank"), value))


# -- map state: all entries after each row ------------------------------------------

MAP_VALUES = 1000


def value_maps_rolling(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, values: Sequence,
                       hot_rows: int | None = None, out: str = "counts") -> DataFrame:
    """After each row: the whole map of its key, value -> how often so far, for the listed ``values``
    (at most MAP_VALUES: a row carries its map). A value that is not listed, or null, is counted under
    no entry, and a value not yet seen has none. One running count a value, all in one scan, so hot keys
    are split like in any other. For values that are not known use ``streaming.user.value_maps`` or
    ``grouped.fold_rows``."""
    if len(values) > MAP_VALUES:
        raise ValueError(f"{len(values)} values: a row would carry a map of up to that many entries")
    cols = list(dict.fromkeys([*key, *order, value]))
    names = {f"_n{i}": v for i, v in enumerate(v for v in values if v is not None)}
    rows = scan.keyed_prefix(df.select(*cols), key, order, {
        n: scan.running_count(F.when(F.col(value) == F.lit(v), F.lit(1))) for n, v in names.items()}, hot_rows)
    vt = df.schema[value].dataType
    entries = F.array(*[F.struct(F.lit(v).cast(vt).alias("key"), F.col(n).alias("value")) for n, v in names.items()])
    seen = F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))
    return rows.select(*cols, (seen if names else F.create_map()).cast(f"map<{vt.simpleString()},bigint>").alias(out))


# -- value state with time-to-live ---------------------------------------------

def ttl_value(df: DataFrame, key: Sequence[str], order: Sequence[str], ts: str,
              value: str, ttl_seconds: float, write_when: Column,
              refresh: str = "read_write", hot_rows: int | None = None) -> DataFrame:
    """Per row: the value state *before* the row (``state``), then the row
    writes ``value`` when ``write_when`` holds.

    ``refresh="read_write"``: every row reads the state, so the last access is
    the key's previous row and the state lapses only after a gap of at least
    ``ttl_seconds`` between consecutive rows. ``refresh="create_write"``: only
    writes refresh; the state lapses ``ttl_seconds`` after the last write.
    Event time stands in for the processing clock, so results are
    deterministic.
    """
    ttl_us = int(ttl_seconds * 1_000_000)
    tnum = epoch_micros(df, ts)
    pos = F.struct(*[F.col(o) for o in order])
    written = F.when(F.coalesce(write_when, F.lit(False)),
                     F.struct(pos.alias("at"), tnum.alias("t"), F.col(value).alias("v")))
    if refresh == "create_write":
        out = scan.keyed_prefix(df, key, order, {
            "_lw": scan.last_value(written, order, inclusive=False)}, hot_rows)
        last = F.col("_lw")
        alive = last.isNotNull() & (tnum - last.getField("t") < ttl_us)
        return out.withColumn("state", F.when(alive, last.getField("v"))).drop("_lw")
    if refresh != "read_write":
        raise ValueError("refresh must be 'read_write' or 'create_write'")
    # one chunk plan for both passes (the second input is derived from the first)
    cols = list(df.columns)
    df, key = scan.keyed(df, key)
    plan = scan.plan_chunks(df, key, order, hot_rows)
    df = scan.with_chunks_once(df, key, plan)
    gaps = scan.keyed_prefix(df, key, order, {
        "_prev_t": scan.last_value(tnum, order, inclusive=False, ignore_nulls=False)},
        hot_rows, plan=plan)
    lapse = F.col("_prev_t").isNull() | (tnum - F.col("_prev_t") >= ttl_us)
    out = scan.keyed_prefix(gaps, key, order, {
        "_brk": scan.last_value(F.when(lapse, pos), order),
        "_lw": scan.last_value(written, order, inclusive=False)}, hot_rows, plan=plan)
    alive = F.col("_lw").isNotNull() & (F.col("_lw").getField("at") >= F.col("_brk"))
    state = F.when(alive, F.col("_lw").getField("v"))
    return out.withColumn("state", state).select(*cols, "state")
