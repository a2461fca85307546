"""User functions over the rows of a group, in order, without holding the group.

The rows are shuffled by key and sorted by (key, order); a task then walks through its
partition as Arrow batches, and each group reaches the user's function as an iterator over
pieces of those batches. Spark's sort spills, and a function that keeps little sees a group
of any size in bounded memory. Such a function has no merge, so one group is the work of one
task: for functions that do have one use ``accumulate`` or ``aggregates.reduce_with``, which
split hot keys.

Rows of a group reach the function in ``order`` (nulls first); a null key is a key like any
other, NaN equals NaN and 0.0 equals -0.0. Rows that the function doesn't take are passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, groupby
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

OUT_ROWS = 4096             # result rows that go out as one batch

Row = dict[str, Any]
Pieces = Iterator[pa.RecordBatch]


def key_columns(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Floating keys as they are grouped: 0.0 and -0.0 are one."""
    floats = {k: F.col(k) + F.lit(0.0).cast(df.schema[k].dataType) for k in key
              if isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType))}
    return df.withColumns(floats) if floats else df


def _cuts(batch: pa.RecordBatch, key: Sequence[str]) -> list[int]:
    """Where the key changes, from 0 to the number of rows."""
    change = np.zeros(batch.num_rows, bool)
    for k in key:
        c = batch.column(batch.schema.get_field_index(k))
        if pa.types.is_nested(c.type):
            values = c.to_pylist()
            change[1:] |= np.array([a != b for a, b in zip(values[1:], values)], bool)
            continue
        a, b = c.slice(1), c.slice(0, max(len(c) - 1, 0))
        other = pc.fill_null(pc.not_equal(a, b), False)
        other = pc.or_(other, pc.xor(a.is_null(), b.is_null()))
        if pa.types.is_floating(c.type):
            other = pc.and_not(other, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        change[1:] |= other.to_numpy(zero_copy_only=False)
    return [0, *np.flatnonzero(change).tolist(), batch.num_rows]


def _alike(a: tuple, b: tuple) -> bool:
    return all(x == y or (x is not None and y is not None and x != x and y != y) for x, y in zip(a, b))


def groups(batches: Iterable[pa.RecordBatch], key: Sequence[str]) -> Iterator[tuple[tuple, Pieces]]:
    """(key, pieces) of batches sorted by key; a group's pieces can be taken until the next group is asked for."""
    def numbered():
        number, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(b.schema.get_field_index(k)) for k in key]
            cuts = _cuts(b, key)
            for s, e in zip(cuts, cuts[1:]):
                now = tuple(c[s].as_py() for c in columns)
                if last is None or not _alike(now, last):
                    number, last = number + 1, now
                yield number, now, b.slice(s, e - s)

    for _, pieces in groupby(numbered(), key=lambda p: p[0]):
        first = next(pieces)
        yield first[1], (p[2] for p in chain([first], pieces))


def rows_of(pieces: Pieces, columns: Sequence[str]) -> Iterator[Row]:
    """The rows of some pieces as dicts of ``columns``."""
    for p in pieces:
        values = [p.column(p.schema.get_field_index(c)).to_pylist() for c in columns]
        for v in zip(*values) if values else ((),) * p.num_rows:
            yield dict(zip(columns, v))


def struct_type(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def process_groups(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
                   fn: Callable[[tuple, Pieces], Iterable[Row]], schema: T.StructType | str,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """``fn(key, pieces)`` for every group of ``key``; it yields rows of ``schema``.

    ``pieces`` are Arrow batches of ``columns`` (default: all of ``df``) and the key. Output: key
    columns, then ``schema``. The shuffle has the session's number of partitions: they aren't put
    together by size, as the function's work is not known by it.
    """
    key = list(key)
    df = key_columns(df, key)
    out = struct_type(schema)
    whole = T.StructType([*[df.schema[k] for k in key], *out.fields])
    names = out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(whole)
        held: list[list] = [[] for _ in whole.fields]

        def emit() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(held, types)], schema=types)
            for v in held:
                v.clear()
            return batch

        for k, pieces in groups(batches, key):
            for row in fn(k, pieces):
                for v, x in zip(held, (*k, *[row[n] for n in names])):
                    v.append(x)
                if len(held[0]) >= OUT_ROWS:
                    yield emit()
        if held and held[0]:
            yield emit()

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(n, *key) if key else df.repartition(1)
    placed = placed.sortWithinPartitions(*key, *order) if key or order else placed
    if columns is not None:
        placed = placed.select(*dict.fromkeys([*key, *columns]))
    return placed.mapInArrow(run, whole)


def fold_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str],
              zero: Callable[[], Any], step: Callable[[Any, Row], tuple[Any, Iterable[Row]]],
              schema: T.StructType | str) -> DataFrame:
    """A stateful function over a key's rows in order: ``step(state, row)`` gives the next
    state and the rows to emit. ``row`` has ``columns``; any state and any function will do.
    Output: key columns, then ``schema``. The stream form is ``streaming.user.fold_rows``."""
    columns = list(columns)

    def fn(key_: tuple, pieces: Pieces) -> Iterator[Row]:
        state = zero()
        for row in rows_of(pieces, columns):
            state, out = step(state, row)
            yield from out

    src = df.select(*dict.fromkeys([*key, *order, *columns]))
    return process_groups(src, key, order, fn, schema, columns)


def reduce_step(fn: Callable[[Row, Row], Row]) -> Callable[[Row | None, Row], tuple[Row, list[Row]]]:
    """The running step of a reduce: the first row comes out unchanged, then ``fn(state, row)``."""
    def step(state: Row | None, row: Row) -> tuple[Row, list[Row]]:
        state = row if state is None else fn(state, row)
        return state, [state]
    return step


def reduce_ordered(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str],
                   fn: Callable[[Row, Row], Row], rolling_: bool = False) -> DataFrame:
    """A user's reduce ``(a, b) -> c`` over rows of ``columns``, in arrival order; it needs no merge.

    Type-preserving: ``fn`` takes and gives rows of the same columns. Rolling: after each row,
    key, ``at_<order>`` of the row and the reduced columns; final: one row per key.
    """
    columns = list(columns)
    fields = [T.StructField(c, df.schema[c].dataType) for c in columns]
    at = [T.StructField(f"at_{o}", df.schema[o].dataType) for o in order]
    step = reduce_step(fn)

    def run(key_: tuple, pieces: Pieces) -> Iterator[Row]:
        state = None
        for p in pieces:
            places = rows_of(iter([p]), list(order))
            for place, row in zip(places, rows_of(iter([p]), columns)):
                state, _ = step(state, row)
                if rolling_:
                    yield {**{f"at_{o}": place[o] for o in order}, **state}
        if not rolling_:
            yield state

    src = df.select(*dict.fromkeys([*key, *order, *columns]))
    return process_groups(src, key, order, run, T.StructType([*at, *fields] if rolling_ else fields))
