"""User-defined incremental aggregates (accumulators) with map-side combine.

An :class:`Accumulator` has the four parts of an incremental aggregate:
``zero`` (create), ``add`` (the rows of one key in one batch, as Arrow
columns), ``merge`` (two partial states) and ``result``. :func:`accumulate`
runs it in two steps:

1. every task folds its rows into states per key (``mapInArrow``): a batch is
   grouped by key with exact types, and ``add`` is called once per key and
   batch. When a task holds ``FLUSH_KEYS`` keys it emits their partial states
   and goes on with none, so its memory is bounded;
2. the partial states are hash-partitioned by key, sorted by key inside each
   partition, and merged in one pass over consecutive states of a key;
   ``result`` then turns each state into the output value.

A key's second step sees its partial states, never its rows, and holds one
state at a time. States travel as pickled bytes. A null key is a key like any
other, and so is NaN.

An accumulator may also say how it works on arrays (:class:`Arrays`): then
``add``, ``merge`` and ``result`` each take all groups of a batch at once, states
are Arrow columns, and no Python runs per group.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from . import grouped

FLUSH_KEYS = 100_000

Columns = dict[str, pa.Array]


@dataclass(frozen=True)
class Arrays:
    """An accumulator over arrays. ``ids`` gives every row (or state) its group, 0 .. n - 1, each
    of which occurs; ``add`` and ``merge`` give the states of the n groups, as columns of ``state``
    (its names and Arrow types, from the input columns' types)."""

    state: Callable[[pa.Schema], pa.Schema]
    add: Callable[[Columns, np.ndarray, int], Columns]
    merge: Callable[[Columns, np.ndarray, int], Columns]
    result: Callable[[Columns], pa.Array]


@dataclass(frozen=True)
class Accumulator:
    zero: Callable[[], Any]
    add: Callable[[Any, dict[str, pa.Array]], Any]
    merge: Callable[[Any, Any], Any]
    result: Callable[[Any], Any]
    arrays: Arrays | None = None


def _same(v):
    """Keys compare as Spark groups them: every NaN is one value, -0.0 is 0.0."""
    if isinstance(v, float):
        return "NaN" if v != v else v + 0.0
    return v


def _value(v):
    return float("nan") if isinstance(v, str) and v == "NaN" else v


def accumulate(df: DataFrame, key: Sequence[str], acc: Accumulator, inputs: Sequence[str],
               out: str, out_type: T.DataType | str, flush_keys: int = FLUSH_KEYS) -> DataFrame:
    """Apply ``acc`` per ``key`` over the rows' ``inputs`` columns; output:
    key columns and ``out``."""
    key, inputs = list(key), list(inputs)
    src = df.select(*dict.fromkeys([*key, *inputs]))
    if acc.arrays:
        return _accumulate_arrays(src, key, acc.arrays, inputs, out, out_type, flush_keys)
    key_fields = [src.schema[k] for k in key]
    floats = [isinstance(f.dataType, (T.FloatType, T.DoubleType)) for f in key_fields]
    partial_schema = T.StructType([*key_fields, T.StructField("_state", T.BinaryType())])
    otype = T._parse_datatype_string(out_type) if isinstance(out_type, str) else out_type
    out_schema = T.StructType([*key_fields, T.StructField(out, otype)])
    last = to_arrow_type(otype)

    def plain(keys: list[tuple], types: list[pa.DataType]) -> list[pa.Array]:
        return [pa.array([_value(k[i]) if floats[i] else k[i] for k in keys], types[i])
                for i in range(len(key))]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        types: list[pa.DataType] = []

        def emit():
            blobs = pa.array([pickle.dumps(s) for s in states.values()], pa.binary())
            return pa.RecordBatch.from_arrays([*plain(list(states), types), blobs], names=[*key, "_state"])

        for b in batches:
            if not b.num_rows:
                continue
            types = [b.schema.field(k).type for k in key]
            if not key:
                whole = {c: b.column(b.schema.get_field_index(c)) for c in inputs}
                states[()] = acc.add(states[()] if states else acc.zero(), whole)
                continue
            t = pa.Table.from_batches([b]).append_column("_at", pa.array(range(b.num_rows), pa.int64()))
            rows = t.group_by(key, use_threads=False).aggregate([("_at", "list")])
            keys = zip(*[rows.column(k).to_pylist() for k in key])
            columns = {c: b.column(b.schema.get_field_index(c)) for c in inputs}
            for k, at in zip(keys, rows.column("_at_list").combine_chunks()):
                k = tuple(map(_same, k))
                part = {c: v.take(at.values) for c, v in columns.items()}
                states[k] = acc.add(states[k] if k in states else acc.zero(), part)
            if len(states) >= flush_keys:
                yield emit()
                states.clear()
        if states:
            yield emit()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur, state, types = None, None, []
        for b in batches:
            types = [b.schema.field(k).type for k in key]
            keys = zip(*[b.column(i).to_pylist() for i in range(len(key))]) if key else [()] * b.num_rows
            done, values = [], []
            for k, blob in zip(keys, b.column(len(key)).to_pylist()):
                k, s = tuple(map(_same, k)), pickle.loads(blob)
                if k == cur:
                    state = acc.merge(state, s)
                    continue
                if cur is not None:
                    done.append(cur)
                    values.append(acc.result(state))
                cur, state = k, s
            if done:
                yield pa.RecordBatch.from_arrays([*plain(done, types), pa.array(values, last)], names=[*key, out])
        if cur is not None:
            yield pa.RecordBatch.from_arrays([*plain([cur], types), pa.array([acc.result(state)], last)],
                                             names=[*key, out])

    return _by_key(src.mapInArrow(fold, partial_schema), key).mapInArrow(finish, out_schema)


def _by_key(states: DataFrame, key: list[str]) -> DataFrame:
    """Partial states of a key together; without a key all of them, one or a few of each task."""
    return states.repartition(*key).sortWithinPartitions(*key) if key else states.repartition(1)


# -- accumulators over arrays ---------------------------------------------------

def group_ids(columns: Sequence[pa.Array], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's group by equal values of all columns, and the first row of every group."""
    ids = np.zeros(rows, np.int64)
    first = np.zeros(min(rows, 1), np.int64)
    for c in columns:
        if isinstance(c, pa.ChunkedArray):
            c = c.combine_chunks()
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, first, ids = np.unique(ids * (int(codes.max(initial=0)) + 1) + codes, return_index=True, return_inverse=True)
    return ids, first


def group_sums(values: pa.Array, ids: np.ndarray, n: int) -> pa.Array:
    """The sum of each group's values (nulls add nothing)."""
    sums = pa.table({"i": ids, "v": values}).group_by("i", use_threads=False).aggregate([("v", "sum")])
    out = sums.column("v_sum").combine_chunks().take(pa.array(np.argsort(sums.column("i").to_numpy())))
    return pc.fill_null(out, pa.scalar(0).cast(out.type))


def _accumulate_arrays(src: DataFrame, key: list[str], acc: Arrays, inputs: list[str], out: str,
                       out_type: T.DataType | str, flush_keys: int) -> DataFrame:
    src = grouped.key_columns(src, key)
    otype = T._parse_datatype_string(out_type) if isinstance(out_type, str) else out_type
    key_fields = [src.schema[k] for k in key]
    state = acc.state(to_arrow_schema(T.StructType([src.schema[c] for c in inputs])))
    names = {c: f"_s_{c}" for c in state.names}
    from pyspark.sql.pandas.types import from_arrow_type
    partial_type = T.StructType([*key_fields, *[T.StructField(names[f.name], from_arrow_type(f.type)) for f in state]])
    whole_type = T.StructType([*key_fields, T.StructField(out, otype)])

    def column(t, name):
        c = t.column(t.schema.get_field_index(name))
        return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c

    def states(t) -> Columns:
        return {c: column(t, n) for c, n in names.items()}

    def packed(keys: list[pa.Array], made: Columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*keys, *[made[c].cast(state.field(c).type) for c in names]], names=[*key, *names.values()])

    def merged(t) -> pa.RecordBatch:
        ids, first = group_ids([column(t, k) for k in key], t.num_rows)
        return packed([column(t, k).take(pa.array(first)) for k in key], acc.merge(states(t), ids, len(first)))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            ids, first = group_ids([column(b, k) for k in key], b.num_rows)
            made = acc.add({c: column(b, c) for c in inputs}, ids, len(first))
            held.append(packed([column(b, k).take(pa.array(first)) for k in key], made))
            if sum(h.num_rows for h in held) >= flush_keys:
                held = [merged(pa.Table.from_batches(held))]
                if held[0].num_rows >= flush_keys // 2:         # merging no longer pays: out they go
                    yield held.pop()
        if held:
            yield merged(pa.Table.from_batches(held))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(t: pa.RecordBatch) -> pa.RecordBatch:
            value = acc.result(states(t))
            return pa.RecordBatch.from_arrays([*[column(t, k) for k in key], value.cast(to_arrow_type(otype))], names=[*key, out])

        carry: pa.RecordBatch | None = None                     # the last key's state: it may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            # sorted by key: after merging, the batch's last key is found by its last row
            t = b if carry is None else pa.Table.from_batches([carry, b]).combine_chunks().to_batches()[0]
            cuts = grouped._cuts(t, key)
            ids = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
            firsts = pa.array(cuts[:-1], pa.int64())
            t = packed([column(t, k).take(firsts) for k in key], acc.merge(states(t), ids, len(cuts) - 1))
            carry = t.slice(t.num_rows - 1)
            if t.num_rows > 1:
                yield done(t.slice(0, t.num_rows - 1))
        if carry is not None:
            yield done(carry)

    return _by_key(src.mapInArrow(fold, partial_type), key).mapInArrow(finish, whole_type)


# -- ready accumulators ---------------------------------------------------------

def _sum_state(column: str) -> Callable[[pa.Schema], pa.Schema]:
    def state(inputs: pa.Schema) -> pa.Schema:
        t = inputs.field(column).type
        return pa.schema([("s", pa.decimal128(38, 0) if pa.types.is_integer(t) else
                           pa.decimal128(38, t.scale) if pa.types.is_decimal(t) else pa.float64())])
    return state


def _wide(v: pa.Array) -> pa.Array:
    """Values whose sums stay exact."""
    if pa.types.is_integer(v.type):
        return v.cast(pa.int64()).cast(pa.decimal128(38, 0))
    return v.cast(pa.decimal128(38, v.type.scale)) if pa.types.is_decimal(v.type) else v.cast(pa.float64())


def _as_text(v: pa.Array) -> pa.Array:
    return pa.array([str(x) for x in v.to_pylist()]) if pa.types.is_floating(v.type) else v.cast(pa.string())


def sum_as_text(column: str) -> Accumulator:
    """The demo window aggregate: sums a numeric column, returns it as text (nulls add nothing)."""
    return Accumulator(zero=lambda: 0,
                       add=lambda s, rows: s + sum(rows[column].drop_null().to_pylist()),
                       merge=lambda a, b: a + b,
                       result=lambda s: str(s),
                       arrays=Arrays(state=_sum_state(column),
                                     add=lambda c, ids, n: {"s": group_sums(_wide(c[column]), ids, n)},
                                     merge=lambda c, ids, n: {"s": group_sums(c["s"], ids, n)},
                                     result=lambda c: _as_text(c["s"])))


def mean_of(column: str) -> Accumulator:
    """Average from a (sum, count) state: sum * 1.0 / count."""
    def add(s, rows):
        v = rows[column].drop_null()
        return (s[0] + (pc.sum(v).as_py() or 0), s[1] + len(v))
    return Accumulator(zero=lambda: (0, 0), add=add,
                       merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
                       result=lambda s: (s[0] * 1.0 / s[1]) if s[1] else None)
