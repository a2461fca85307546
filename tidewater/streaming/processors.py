"""Keyed stateful processors for ``transformWithStateInPandas``.

These are the streaming forms of the keyed-state operators: running top-k
(list state), jump alert (value state), running sum/mean (value state),
value counts (map state), count windows (list buffer), late flags per key
(value state), rolling fields and maxBy rows (value state), a value cell with
time-to-live, and per-window top-N with event-time timers.

Spark does not order rows inside a key within a micro-batch, so each
processor sorts the key's rows of the current micro-batch by the order
columns (this holds at most one micro-batch of one key; bound it with
``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``). The update itself is
vectorized over those rows (numpy/pandas: cumulative sums and maxima,
shifts, prefix differences) with the state read once before and written
once after, never row by row. State survives across micro-batches in the
state store (RocksDB) and is checkpointed with the query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import (StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)


def _ordered(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    pdf = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
    return pdf.sort_values(list(order), kind="stable").reset_index(drop=True)


def _py(v):
    """numpy scalar -> Python value for a state tuple (NaN -> None)."""
    if v is None:
        return None
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, float) and v != v:
        return None
    return v


def _numeric(s: pd.Series) -> tuple[np.ndarray, np.ndarray, object]:
    """(values, valid mask, 'minus infinity' sentinel) of a numeric column."""
    valid = s.notna().to_numpy()
    if pd.api.types.is_integer_dtype(s.dtype):
        return s.to_numpy(dtype=np.int64), valid, np.iinfo(np.int64).min
    return s.to_numpy(dtype=np.float64, na_value=np.nan), valid, -np.inf


def _as_objects(a: np.ndarray, mask: np.ndarray) -> list:
    """Column values with ``None`` where ``mask`` is false."""
    return [_py(x) if m else None for x, m in zip(a.tolist(), mask.tolist())]


class RunningTopK(StatefulProcessor):
    """After each row: the k largest values of the key so far (list state).

    The j-th largest of a prefix is the running max of min(v, (j-1)-th
    largest before the row); the stored top-k enters as k earlier rows."""

    def __init__(self, order: Sequence[str], value: str, k: int, columns: Sequence[str],
                 value_type: str = "double", out: str = "top"):
        self.order, self.value, self.k = list(order), value, k
        self.columns, self.value_type, self.out = list(columns), value_type, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", f"v {self.value_type}")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        x, valid, lo = _numeric(pdf[self.value])
        carry = np.array([t[0] for t in self.top.get()] if self.top.exists() else [],
                         dtype=x.dtype)
        xs = np.concatenate([carry, np.where(valid, x, lo)])
        levels, before = [], None
        for _ in range(self.k):
            cand = xs if before is None else np.where(
                (xs != lo) & (before != lo), np.minimum(xs, before), lo)
            level = np.maximum.accumulate(cand)
            levels.append(level)
            before = np.concatenate([np.array([lo], dtype=xs.dtype), level[:-1]])
        grid = np.stack(levels, axis=1)[len(carry):]
        tops = [[_py(v) for v in r[r != lo]] for r in grid]
        self.top.put([(_py(v),) for v in grid[-1][grid[-1] != lo]])
        yield pdf.assign(**{self.out: tops})[[*self.columns, self.out]]

    def close(self) -> None:
        pass


class JumpAlert(StatefulProcessor):
    """Rows whose value differs from the key's previous one by more than
    ``threshold`` (the previous value starts at ``initial``)."""

    def __init__(self, order: Sequence[str], value: str, columns: Sequence[str],
                 threshold: float = 10, initial: float = 0, value_type: str = "double"):
        self.order, self.value, self.columns = list(order), value, list(columns)
        self.threshold, self.initial, self.value_type = threshold, initial, value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getValueState("prev", f"v {self.value_type}")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        first = self.prev.get()[0] if self.prev.exists() else None
        vals = pdf[self.value]
        prev = vals.shift(1).astype(object)
        prev.iloc[0] = first
        # before the first row, and after a row without a value, the state is the initial one
        prev = prev.where(prev.notna(), self.initial).infer_objects()
        self.prev.update((_py(vals.iloc[-1]),))
        out = pdf.assign(prev=pd.to_numeric(prev))
        keep = (out[self.value] - out["prev"]).abs() > self.threshold
        yield out[keep][[*self.columns, "prev"]]

    def close(self) -> None:
        pass


class RunningSum(StatefulProcessor):
    """Running sum, count and mean of a value per key (value state);
    with ``every`` only every ``every``-th row of a key is emitted (a global
    window with a count trigger)."""

    def __init__(self, order: Sequence[str], value: str, columns: Sequence[str],
                 every: int = 1):
        self.order, self.value, self.columns, self.every = list(order), value, list(columns), every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "s double, n long, r long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        s0, n0, r0 = self.acc.get() if self.acc.exists() else (0.0, 0, 0)
        x, valid, _ = _numeric(pdf[self.value])
        sums = s0 + np.cumsum(np.where(valid, x, 0).astype(np.float64))
        counts = n0 + np.cumsum(valid.astype(np.int64))
        at = r0 + np.arange(1, len(pdf) + 1)        # the trigger counts rows, with or without a value
        self.acc.update((float(sums[-1]), int(counts[-1]), int(at[-1])))
        out = pdf.assign(run_sum=sums, n=counts)
        out["mean"] = out["run_sum"] / out["n"].where(out["n"] > 0)
        if self.every > 1:
            out = out[at % self.every == 0]
        yield out[[*self.columns, "run_sum", "n", "mean"]]

    def close(self) -> None:
        pass


class ValueCounts(StatefulProcessor):
    """After each row: how often its value has been seen for its key (map state)."""

    def __init__(self, order: Sequence[str], value: str, columns: Sequence[str],
                 value_type: str = "string"):
        self.order, self.value, self.columns = list(order), value, list(columns)
        self.value_type = value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", f"v {self.value_type}", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        vals = pdf[self.value]
        base = {v: (self.counts.getValue((_py(v),))[0]
                    if self.counts.containsKey((_py(v),)) else 0)
                for v in vals.unique()}
        cnt = vals.groupby(vals, sort=False).cumcount() + 1 + vals.map(base)
        last = cnt.groupby(vals, sort=False).last()
        for v, n in last.items():
            self.counts.updateValue((_py(v),), (int(n),))
        yield pdf.assign(cnt=cnt.astype(np.int64))[[*self.columns, "cnt"]]

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """Count window per key: after every ``slide`` rows, the sum and count of
    the last ``size`` rows (``slide == size``: tumbling, an incomplete last
    window never fires). The buffer holds at most ``size`` values; window
    sums are prefix-sum differences over buffer + new rows."""

    def __init__(self, order: Sequence[str], value: str, key_cols: Sequence[str],
                 size: int, slide: int):
        self.order, self.value, self.key_cols = list(order), value, list(key_cols)
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("buf", "v double")
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        buf = np.array([t[0] for t in self.buf.get()] if self.buf.exists() else [],
                       dtype=np.float64)
        n0 = self.seen.get()[0] if self.seen.exists() else 0
        x = pdf[self.value].to_numpy(dtype=np.float64, na_value=0.0)
        seq = np.concatenate([buf, x])
        prefix = np.concatenate([[0.0], np.cumsum(seq)])
        number = n0 + np.arange(1, len(x) + 1)            # row number inside the key
        pos = len(buf) + np.arange(len(x))                 # index in seq
        fire = number % self.slide == 0
        end = pos[fire] + 1
        start = np.maximum(0, end - self.size)
        n = n0 + len(x)
        if self.slide == self.size:
            rest = n % self.size
            keep = seq[len(seq) - rest:] if rest else seq[:0]
        else:
            keep = seq[-self.size:]
        if len(keep):
            self.buf.put([(float(v),) for v in keep])
        else:
            self.buf.clear()
        self.seen.update((int(n),))
        if fire.any():
            out = pd.DataFrame({c: [kv] * int(fire.sum()) for c, kv in zip(self.key_cols, key)})
            out["fire_at"] = number[fire].astype(np.int64)
            out["total"] = prefix[end] - prefix[start]
            out["cnt"] = (end - start).astype(np.int64)
            yield out[[*self.key_cols, "fire_at", "total", "cnt"]]

    def close(self) -> None:
        pass


class LateFlags(StatefulProcessor):
    """Per-key watermark: a row is late when its event time (epoch micros
    column ``ts_us``) is below the key's largest earlier event time minus
    ``delay_us``."""

    def __init__(self, order: Sequence[str], ts_us: str, columns: Sequence[str], delay_us: int):
        self.order, self.ts_us, self.columns, self.delay_us = list(order), ts_us, list(columns), delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.maxts = handle.getValueState("max_ts", "t long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        lo = np.iinfo(np.int64).min
        t = pdf[self.ts_us].to_numpy(dtype=np.int64)
        top = self.maxts.get()[0] if self.maxts.exists() else lo
        running = np.maximum.accumulate(np.concatenate([np.array([top], dtype=np.int64), t]))
        before = running[:-1]
        late = (before != lo) & (t < before - self.delay_us)
        self.maxts.update((int(running[-1]),))
        yield pdf.assign(is_late=late)[[*self.columns, "is_late"]]

    def close(self) -> None:
        pass


class TtlValue(StatefulProcessor):
    """Value cell with processing-time TTL: emit each row with the state
    before it, then store the row's value when it exceeds ``write_above``.
    The processing clock stands still within a micro-batch, so the state
    before a row is the last value written earlier in the batch, else the
    stored value. ``refresh="read_write"`` re-stores a value that was read,
    so reads extend its life as writes do (the TTL restarts on update)."""

    def __init__(self, order: Sequence[str], value: str, columns: Sequence[str], ttl_ms: int,
                 write_above: float = 10, refresh: str = "read_write",
                 value_type: str = "double"):
        self.order, self.value, self.columns = list(order), value, list(columns)
        self.ttl_ms, self.write_above, self.refresh = ttl_ms, write_above, refresh
        self.value_type = value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cell = handle.getValueState("cell", f"v {self.value_type}", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        stored = self.cell.get()[0] if self.cell.exists() else None
        vals = pdf[self.value]
        writes = vals.notna() & (vals > self.write_above)
        before = vals.where(writes).shift(1).ffill()
        if stored is not None:
            before = before.fillna(stored)
        if writes.any():
            self.cell.update((_py(vals[writes].iloc[-1]),))
        elif stored is not None and self.refresh == "read_write":
            self.cell.update((stored,))
        state = _as_objects(before.to_numpy(dtype=object), before.notna().to_numpy())
        yield pdf.assign(state=state)[[*self.columns, "state"]]

    def close(self) -> None:
        pass


class RollingFields(StatefulProcessor):
    """Keyed rolling aggregate: after each row, every field's aggregate over
    the key's rows so far. Kinds: sum, count, max, min, first, last (first
    and last in order, nulls included, as a keyed stream keeps them). State:
    a (seen, value) pair per field in one value cell."""

    def __init__(self, order: Sequence[str], columns: Sequence[str],
                 fields: dict[str, tuple[str, str]], state_schema: str):
        self.order, self.columns, self.fields = list(order), list(columns), dict(fields)
        self.state_schema = state_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", self.state_schema)

    @staticmethod
    def _running(kind: str, s: pd.Series, seen: bool, acc):
        """(per-row outputs, new accumulator) for one field."""
        valid = s.notna()
        if kind == "count":
            out = (acc or 0) + valid.cumsum().astype(np.int64)
            return out, int(out.iloc[-1])
        if kind == "last":
            return s, _py(s.iloc[-1])
        if kind == "first":
            v = acc if seen else _py(s.iloc[0])
            return pd.Series([v] * len(s), index=s.index, dtype=object), v
        if kind == "sum":
            out = (acc if acc is not None else 0) + s.fillna(0).cumsum()
            if acc is None:
                out = out.where(valid.cumsum() > 0)
        elif kind in ("max", "min"):
            ext = s if acc is None else pd.concat([pd.Series([acc], dtype=s.dtype if s.dtype == object else None), s],
                                                  ignore_index=True)
            run = (ext.cummax() if kind == "max" else ext.cummin()).ffill()
            out = run if acc is None else run.iloc[1:].set_axis(s.index)
        else:
            raise ValueError(f"unknown rolling kind {kind!r}")
        last = out.iloc[-1]
        return out, (None if pd.isna(last) else _py(last))

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        names = list(self.fields)
        cur = list(self.acc.get()) if self.acc.exists() else [None] * (2 * len(names))
        outs = {}
        for j, n in enumerate(names):
            kind, col = self.fields[n]
            vals, new_acc = self._running(kind, pdf[col], bool(cur[2 * j]), cur[2 * j + 1])
            outs[n] = _as_objects(vals.to_numpy(dtype=object), vals.notna().to_numpy())
            cur[2 * j], cur[2 * j + 1] = True, new_acc
        self.acc.update(tuple(cur))
        yield pdf.assign(**outs)[[*self.columns, *names]]

    def close(self) -> None:
        pass


class ExtremeRow(StatefulProcessor):
    """maxBy / minBy: after each row, the whole row with the largest (or
    smallest) value so far; an earlier row keeps its place on a tie (only a
    strictly better value takes over)."""

    def __init__(self, order: Sequence[str], value: str, row_cols: Sequence[str],
                 out_cols: Sequence[str], largest: bool, state_schema: str):
        self.order, self.value, self.row_cols = list(order), value, list(row_cols)
        self.out_cols, self.largest, self.state_schema = list(out_cols), largest, state_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.state_schema)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        pdf = _ordered(rows, self.order)
        if pdf.empty:
            return
        best = tuple(self.best.get()) if self.best.exists() else None
        vi = self.row_cols.index(self.value)
        # ranks of the values (with the kept one) compare as the values do, in any type
        vals = [None if best is None else best[vi], *(_py(v) for v in pdf[self.value].tolist())]
        distinct = sorted({v for v in vals if v is not None}, reverse=not self.largest)
        rank = {v: i + 1 for i, v in enumerate(distinct)}
        score = np.array([rank.get(v, 0) for v in vals], dtype=np.int64)
        running = np.maximum.accumulate(score)
        better = score[1:] > running[:-1]
        if best is None and not better[0]:
            better[0] = True                        # a key of rows without a value keeps its first
        x = score[1:]
        pick = np.maximum.accumulate(np.where(better, np.arange(len(x)), -1))
        rows_new = pdf[self.row_cols].reset_index(drop=True)
        chosen = rows_new.iloc[np.maximum(pick, 0)].reset_index(drop=True).astype(object)
        if (pick < 0).any():
            fill = best if best is not None else (None,) * len(self.row_cols)
            chosen.loc[pick < 0, :] = [list(fill)] * int((pick < 0).sum())
        if pick[-1] >= 0:
            # column by column: a mixed-type row as one Series would turn ints into floats
            last = int(pick[-1])
            self.best.update(tuple(_py(rows_new[c].iloc[last]) for c in self.row_cols))
        at = pdf[self.order].rename(columns={o: f"at_{o}" for o in self.order})
        rest = [c for c in self.out_cols if c not in self.row_cols and not c.startswith("at_")]
        out = pd.concat([pdf[rest].reset_index(drop=True), at.reset_index(drop=True), chosen],
                        axis=1)
        yield out[self.out_cols]

    def close(self) -> None:
        pass


class WindowTopN(StatefulProcessor):
    """Per-window top-N after a windowed count: keyed by window, keeps only
    the n best (count, item) pairs in list state and emits them with their
    rank when the watermark passes the window end (event-time timer).
    State per open window is O(n), however many items the window has."""

    def __init__(self, n: int, item: str, ascending: bool = False, end_ms: str = "end_ms"):
        self.n, self.item, self.ascending, self.end_ms = n, item, ascending, end_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", "c long, i string")

    def _best(self, frame: pd.DataFrame) -> pd.DataFrame:
        # count first, ties by item with a null item first (as in the batch ordering)
        return frame.sort_values(["c", "i"], ascending=[self.ascending, True],
                                 na_position="first", kind="stable").head(self.n)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        kept = list(self.best.get()) if self.best.exists() else []
        best = pd.DataFrame(kept, columns=["c", "i"]) if kept else None
        end_ms = None
        for pdf in rows:                            # one frame at a time: never more than n rows are kept
            if len(pdf):
                part = pd.DataFrame({"c": pdf["cnt"].to_numpy(), "i": pdf[self.item].to_numpy(dtype=object)})
                best = self._best(part if best is None else pd.concat([best, part], ignore_index=True))
                end_ms = int(pdf[self.end_ms].iloc[0])
        if end_ms is not None:
            self.best.put([(int(c), i) for c, i in zip(best["c"], best["i"])])
        if end_ms is not None:
            self.handle.registerTimer(end_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        kept = list(self.best.get()) if self.best.exists() else []
        self.best.clear()
        if kept:
            best = self._best(pd.DataFrame(kept, columns=["c", "i"]))
            yield pd.DataFrame({"window_start": [key[0]] * len(best),
                                "window_end": [key[1]] * len(best),
                                "rank": np.arange(1, len(best) + 1, dtype=np.int64),
                                self.item: best["i"].tolist(),
                                "cnt": best["c"].astype(np.int64).tolist()})

    def close(self) -> None:
        pass
