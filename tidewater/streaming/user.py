"""Stream operators with user code: ordered folds and reduces, accumulators over merging
sessions and processing-time windows, full-window and coGroup functions.

They take the same user functions as the batch operators (``operators.grouped``,
``operators.accumulate``, ``operators.windows``, ``operators.joins``). A row's columns travel
as one struct, so values keep their types whatever a batch holds; user state is stored pickled
in the state store and checkpointed with the query. Rows of a key are in order within a
micro-batch and micro-batches follow each other, as in every keyed stream operator here.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..operators.accumulate import Accumulator
from ..operators.grouped import Row, reduce_step, struct_type
from ..operators.windows import gap_micros
from .ops import event_time, keyed

PIECE_ROWS = 10_000         # rows of one Arrow piece given to a window function
ROW = "tw_row"


def _rows(frames: Iterator[pd.DataFrame]) -> list[Row]:
    return [_plain(r) for f in frames for r in f[ROW]]


def _plain(row) -> Row:
    return row if isinstance(row, dict) else row.asDict()


def _place(order: Sequence[str]) -> Callable[[Row], tuple]:
    """Sorts rows by their order columns, nulls first."""
    return lambda r: tuple((r[o] is not None, r[o]) if r[o] is not None else (False,) for o in order)


def _frame(rows: list[Row], names: Sequence[str]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series([r[n] for r in rows], dtype=object) for n in names})


def _packed(df: DataFrame, key: Sequence[str], columns: Sequence[str], *extra) -> DataFrame:
    return df.select(*[F.col(k) for k in key], F.struct(*[F.col(c) for c in dict.fromkeys(columns)]).alias(ROW), *extra)


def _fields(df: DataFrame, columns: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(c, df.schema[c].dataType) for c in columns]


# -- ordered folds ------------------------------------------------------------------

class FoldRows(StatefulProcessor):
    """One pickled state a key, updated row by row in order."""

    def __init__(self, key: Sequence[str], order: Sequence[str], zero, step, names: Sequence[str]):
        self.key, self.order, self.zero, self.step, self.names = list(key), list(order), zero, step, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "s binary")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        taken = sorted(_rows(rows), key=_place(self.order))
        if not taken:
            return
        state = pickle.loads(self.state.get()[0]) if self.state.exists() else self.zero()
        out = []
        for row in taken:
            state, more = self.step(state, row)
            out += [{**dict(zip(self.key, key)), **r} for r in more]
        self.state.update((pickle.dumps(state),))
        if out:
            yield _frame(out, [*self.key, *self.names])

    def close(self) -> None:
        pass


def fold_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str],
              zero: Callable[[], Any], step: Callable[[Any, Row], tuple[Any, Iterable[Row]]], schema) -> DataFrame:
    """Stream form of ``grouped.fold_rows``: ``step(state, row)`` gives the next state and rows to emit."""
    out = struct_type(schema)
    whole = T.StructType([*_fields(df, key), *out.fields])
    proc = FoldRows(key, order, zero, step, out.fieldNames())
    return keyed(_packed(df, key, [*order, *columns]), key, proc, whole)


def reduce_ordered(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str],
                   fn: Callable[[Row, Row], Row]) -> DataFrame:
    """Stream form of ``grouped.reduce_ordered`` (rolling): any ``(a, b) -> c`` in arrival order."""
    columns, order = list(columns), list(order)
    reduced = reduce_step(fn)

    def step(state, row):
        state, _ = reduced(state, {c: row[c] for c in columns})
        return state, [{**{f"at_{o}": row[o] for o in order}, **state}]

    at = [T.StructField(f"at_{o}", df.schema[o].dataType) for o in order]
    return fold_rows(df, key, order, columns, lambda: None, step, T.StructType([*at, *_fields(df, columns)]))


def global_when(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str],
                zero: Callable[[], Any], add: Callable[[Any, Row], Any], fires: Callable[[Row, Any, int], bool],
                result: Callable[[Any], Row], schema) -> DataFrame:
    """Global window with a predicate trigger: the state of all rows so far, and after every row
    for which ``fires(row, state, n)`` holds (n: the row's position in its key) one result. The
    trigger is asked between the rows of a micro-batch. Output: key, order, ``fire_at``, ``schema``."""
    order = list(order)

    def step(held, row):
        n, state = held
        state = add(state, row)
        emit = [{**{o: row[o] for o in order}, "fire_at": n + 1, **result(state)}] if fires(row, state, n + 1) else []
        return (n + 1, state), emit

    out = T.StructType([*_fields(df, order), T.StructField("fire_at", T.LongType()), *struct_type(schema).fields])
    return fold_rows(df, key, order, columns, lambda: (0, zero()), step, out)


def value_maps(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Map state shown whole after each row: key, order, ``counts`` (value -> how often so far).
    A null value is counted under no entry."""
    order = list(order)

    def step(state, row):
        if row[value] is not None:
            state[row[value]] = state.get(row[value], 0) + 1
        return state, [{**{o: row[o] for o in order}, "counts": dict(state)}]

    vt = df.schema[value].dataType
    out = T.StructType([*_fields(df, order), T.StructField("counts", T.MapType(vt, T.LongType()))])
    return fold_rows(df, key, order, [value], dict, step, out)


# -- accumulators over merging sessions ---------------------------------------------

class SessionAccumulate(StatefulProcessor):
    """Open sessions of a key in map state, first time -> (last time, accumulator state).

    The rows of a micro-batch are cut into sessions of their own first; each then takes in
    the open sessions it touches, which a late row may bridge into one. A timer closes a
    session once the watermark is past its last time plus the gap.
    """

    def __init__(self, key, acc: Accumulator, inputs: Sequence[str], types: list[pa.DataType], gap_us: int, out: str):
        self.key, self.acc, self.inputs, self.types = list(key), acc, list(inputs), types
        self.gap, self.out = gap_us, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "first long", "last long, state binary")

    def _closes(self, last: int) -> int:
        return (last + self.gap) // 1000 + 1

    def _local(self, rows: list[Row]) -> list[tuple[int, int, Any]]:
        """Sessions of the rows alone: first, last, state."""
        out, start = [], 0
        for k in range(1, len(rows) + 1):
            if k == len(rows) or rows[k]["tw_us"] - rows[k - 1]["tw_us"] > self.gap:
                part = rows[start:k]
                columns = {c: pa.array([r[c] for r in part], t) for c, t in zip(self.inputs, self.types)}
                out.append((part[0]["tw_us"], part[-1]["tw_us"], self.acc.add(self.acc.zero(), columns)))
                start = k
        return out

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        taken = sorted(_rows(rows), key=lambda r: r["tw_us"])
        if not taken:
            return iter([])
        now = timerValues.getCurrentWatermarkInMs()
        held = {k[0]: (v[0], v[1]) for k, v in self.open.iterator()} if self.open.exists() else {}
        for first, last, state in self._local(taken):
            touched = [f for f, (l, _) in held.items()
                       if f <= last + self.gap and l + self.gap >= first and self._closes(l) > now]
            if not touched and self._closes(last) <= now:
                continue                                # late: its session has closed (its timer may be due yet)
            before = [held.pop(f) for f in sorted(touched)]
            for f, (l, _) in zip(sorted(touched), before):
                self.open.removeKey((f,))
                self.handle.deleteTimer(self._closes(l))
            for _, blob in before:
                state = self.acc.merge(pickle.loads(blob), state)
            first, last = min([first, *touched]), max([last, *[l for l, _ in before]])
            held[first] = (last, pickle.dumps(state))
            self.open.updateValue((first,), held[first])
        for last, _ in held.values():
            self.handle.registerTimer(self._closes(last))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = expiredTimerInfo.getExpiryTimeInMs()
        held = [(k[0], v[0], v[1]) for k, v in self.open.iterator()] if self.open.exists() else []
        out = []
        for first, last, blob in held:
            if self._closes(last) <= due:
                self.open.removeKey((first,))
                out.append({**dict(zip(self.key, key)), "tw_first": first, "tw_last": last + self.gap,
                            self.out: self.acc.result(pickle.loads(blob))})
        if out:
            yield _frame(out, [*self.key, "tw_first", "tw_last", self.out])

    def close(self) -> None:
        pass


def _arrow_types(df: DataFrame, columns: Sequence[str]) -> list[pa.DataType]:
    return [f.type for f in to_arrow_schema(T.StructType(_fields(df, columns)))]


def session_accumulate(df: DataFrame, key: Sequence[str], ts: str, gap: str, delay: str, acc: Accumulator,
                       inputs: Sequence[str], out: str, out_type) -> DataFrame:
    """Stream form of ``windows.session_accumulate``: key, window_start, window_end, ``out``, when the
    watermark has passed a session's end. Rows that come for a closed session are dropped."""
    src = event_time(df.filter(F.col(ts).isNotNull()), ts, delay)
    src = src.withColumn("tw_us", F.unix_micros(ts))
    otype = T._parse_datatype_string(out_type) if isinstance(out_type, str) else out_type
    proc = SessionAccumulate(key, acc, inputs, _arrow_types(df, inputs), gap_micros(df, gap), out)
    whole = T.StructType([*_fields(df, key), T.StructField("tw_first", T.LongType()),
                          T.StructField("tw_last", T.LongType()), T.StructField(out, otype)])
    rows = keyed(_packed(src, key, ["tw_us", *inputs]), key, proc, whole, time_mode="EventTime")
    return rows.select(*key, F.timestamp_micros("tw_first").alias("window_start"),
                       F.timestamp_micros("tw_last").alias("window_end"), out)


# -- processing-time windows that close ----------------------------------------------

class ClosingWindow(StatefulProcessor):
    """One accumulator state a (key, window); a processing-time timer at the window's end emits and clears it."""

    def __init__(self, key, acc: Accumulator, inputs: Sequence[str], types: list[pa.DataType], out: str):
        self.key, self.acc, self.inputs, self.types, self.out = list(key), acc, list(inputs), types, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "s binary")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        taken = _rows(rows)
        if taken:
            state = pickle.loads(self.state.get()[0]) if self.state.exists() else self.acc.zero()
            columns = {c: pa.array([r[c] for r in taken], t) for c, t in zip(self.inputs, self.types)}
            self.state.update((pickle.dumps(self.acc.add(state, columns)),))
            self.handle.registerTimer(key[-1] // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            state = pickle.loads(self.state.get()[0])
            self.state.clear()
            yield _frame([{**dict(zip(self.key, key)), self.out: self.acc.result(state)}], [*self.key, self.out])

    def close(self) -> None:
        pass


def processing_window(df: DataFrame, key: Sequence[str], size: str, acc: Accumulator, inputs: Sequence[str],
                      out: str, out_type, slide: str | None = None) -> DataFrame:
    """Tumbling or sliding windows on the processing clock that close: append output of key,
    window_start, window_end, ``out``, once each window's end has passed. A row's time is that of its
    micro-batch."""
    framed = (df.withColumn("tw_now", F.current_timestamp()).withColumn("tw_w", F.window("tw_now", size, slide or size))
              .withColumns({"tw_start": F.unix_micros("tw_w.start"), "tw_end": F.unix_micros("tw_w.end")}))
    group = [*key, "tw_start", "tw_end"]
    otype = T._parse_datatype_string(out_type) if isinstance(out_type, str) else out_type
    whole = T.StructType([*_fields(framed, group), T.StructField(out, otype)])
    proc = ClosingWindow(group, acc, inputs, _arrow_types(df, inputs), out)
    rows = keyed(_packed(framed, group, inputs), group, proc, whole, time_mode="ProcessingTime")
    return rows.select(*key, F.timestamp_micros("tw_start").alias("window_start"),
                       F.timestamp_micros("tw_end").alias("window_end"), out)


# -- full-window and coGroup functions -------------------------------------------------

class WindowFunction(StatefulProcessor):
    """Buffers a (key, window)'s rows in list state and calls the function when the watermark passes the end."""

    def __init__(self, key, fn, orders: list[list[str]], schemas: list[pa.Schema], names: Sequence[str]):
        self.key, self.fn, self.orders, self.schemas, self.names = list(key), fn, orders, schemas, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = [handle.getListState(f"side{k}", "rows binary") for k in range(len(self.orders))]

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        end_ms = key[-1] // 1000
        if end_ms > timerValues.getCurrentWatermarkInMs():          # else late: the window has closed
            taken: list[list[Row]] = [[] for _ in self.orders]
            for r in _rows(rows):
                taken[r["tw_side"]].append(_plain(r[f"tw_of{r['tw_side']}"]))
            for buffer, part in zip(self.buffer, taken):
                if part:
                    buffer.appendValue((pickle.dumps(part),))
            self.handle.registerTimer(end_ms)
        return iter([])

    def _pieces(self, k: int) -> Iterator[pa.RecordBatch]:
        held = [r for (blob,) in self.buffer[k].get() for r in pickle.loads(blob)] if self.buffer[k].exists() else []
        held.sort(key=_place(self.orders[k]))
        for at in range(0, len(held), PIECE_ROWS):
            yield pa.RecordBatch.from_pylist(held[at:at + PIECE_ROWS], schema=self.schemas[k])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        from datetime import datetime, timedelta
        start, end = (datetime(1970, 1, 1) + timedelta(microseconds=us) for us in key[-2:])
        named = (*key[:-2], start, end)
        out = [{**dict(zip(self.key, key)), **r} for r in self.fn(named, *[self._pieces(k) for k in range(len(self.orders))])]
        for b in self.buffer:
            b.clear()
        if out:
            yield _frame(out, [*self.key, *self.names])

    def close(self) -> None:
        pass


def _windows(sides: list[tuple[DataFrame, str, Sequence[str]]], key: Sequence[str], size: str, slide: str | None,
             delay: str, fn, schema) -> DataFrame:
    parts, orders, schemas = [], [], []
    for k, (df, ts, order) in enumerate(sides):
        src = event_time(df.filter(F.col(ts).isNotNull()), ts, delay).withColumn("tw_w", F.window(ts, size, slide or size))
        mine = T.StructType(_fields(src, df.columns))
        schemas.append(to_arrow_schema(mine))
        orders.append(list(order))
        others = [F.lit(None).cast(T.StructType(_fields(event_time(d, t), d.columns))) if j != k
                  else F.struct(*df.columns) for j, (d, t, _) in enumerate(sides)]
        parts.append(src.select(*key, F.unix_micros("tw_w.start").alias("tw_start"), F.unix_micros("tw_w.end").alias("tw_end"),
                                F.struct(F.lit(k).alias("tw_side"), *[o.alias(f"tw_of{j}") for j, o in enumerate(others)]).alias(ROW)))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    group = [*key, "tw_start", "tw_end"]
    out = struct_type(schema)
    proc = WindowFunction(group, fn, orders, schemas, out.fieldNames())
    done = keyed(rows, group, proc, T.StructType([*_fields(rows, group), *out.fields]), time_mode="EventTime")
    return done.select(*key, F.timestamp_micros("tw_start").alias("window_start"),
                       F.timestamp_micros("tw_end").alias("window_end"), *out.fieldNames())


def process_window(df: DataFrame, key: Sequence[str], ts: str, size: str, delay: str, order: Sequence[str], fn,
                   schema, slide: str | None = None) -> DataFrame:
    """Stream form of ``windows.process_window``. The rows of a (key, window) wait in list state; the
    one window that fires is sorted and given to ``fn`` in Arrow pieces."""
    return _windows([(df, ts, order)], key, size, slide, delay, fn, schema)


def window_cogroup_process(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str, right_ts: str, size: str,
                           delay: str, left_order: Sequence[str], right_order: Sequence[str], fn, schema) -> DataFrame:
    """Stream form of ``joins.window_cogroup_process``: both streams under their joint watermark."""
    return _windows([(left, left_ts, left_order), (right, right_ts, right_order)], key, size, None, delay, fn, schema)
