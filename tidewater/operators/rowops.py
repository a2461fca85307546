"""Row operators: map, filter, flatMap, rich (lifecycle) map, two-input co-map."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import LETTER_STREAM_TAG, NUMBER_STREAM_TAG, split_words, tag


def map_rows(df: DataFrame, **exprs: Column) -> DataFrame:
    """1 -> 1 projection (each keyword becomes an output column)."""
    return df.select(*[e.alias(name) for name, e in exprs.items()])


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows whose ``column`` equals ``value``; a null column never
    matches (it is dropped). Pushed down to the scan as an equality filter."""
    return df.filter(F.col(column) == F.lit(value))


def flat_map_words(df: DataFrame, text: str, keep: list[str] | None = None,
                   sep: str = " ", with_position: bool = False) -> DataFrame:
    """1 -> n: one row per token of ``text`` (see ``split_words``)."""
    keep = keep or []
    if with_position:
        return df.select(*keep, F.posexplode(split_words(text, sep)).alias("pos", "word"))
    return df.select(*keep, F.explode(split_words(text, sep)).alias("word"))


def word_count(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """(word, count) over all lines; partial counts are combined map-side."""
    return (flat_map_words(df, text, sep=sep)
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def rich_map(df: DataFrame, fn: Callable[[pd.DataFrame, dict], pd.DataFrame],
             schema: T.StructType | str,
             open_fn: Callable[[dict], None] | None = None,
             close_fn: Callable[[dict], None] | None = None,
             release_fn: Callable[[dict], None] | None = None) -> DataFrame:
    """Batch-wise map with a per-task lifecycle.

    ``open_fn(ctx)`` runs once per task before the first batch, ``close_fn``
    once after the last one (only on normal completion, as a failed task is
    retried from scratch). ``release_fn`` runs at the task's end in any case,
    after a failure of ``open_fn`` or ``fn`` too: it gives back what
    ``open_fn`` took. ``ctx`` carries ``partition_id`` (the subtask
    index), ``task_name``, ``attempt`` and ``stage_id`` from the task context,
    plus anything ``open_fn`` stores.
    ``fn`` gets Arrow-backed pandas batches.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tc = TaskContext.get()
        ctx = {"partition_id": tc.partitionId() if tc else 0,
               "attempt": tc.attemptNumber() if tc else 0,
               "stage_id": tc.stageId() if tc else 0}
        ctx["task_name"] = f"stage {ctx['stage_id']} subtask {ctx['partition_id']}"
        try:
            if open_fn:
                open_fn(ctx)
            for pdf in batches:
                yield fn(pdf, ctx)
            if close_fn:
                close_fn(ctx)
        finally:
            if release_fn:
                release_fn(ctx)

    return df.mapInPandas(run, schema)


def increment_int(line: Column | str) -> Column:
    """``parseInt(line) + 1`` as a native expression (wraps like a 32-bit int)."""
    c = F.col(line) if isinstance(line, str) else line
    v = c.cast("int").cast("bigint") + 1
    return (((v + 2**31) % 2**32) - 2**31).cast("int")


def co_map(numbers: DataFrame, number_col: str, letters: DataFrame, letter_col: str,
           number_label: str = NUMBER_STREAM_TAG,
           letter_label: str = LETTER_STREAM_TAG) -> DataFrame:
    """Two inputs of different types -> one string stream, each side mapped
    by its own function. No shuffle: a union of two projections."""
    left = numbers.select(tag(number_col, number_label).alias("value"))
    right = letters.select(tag(letter_col, letter_label).alias("value"))
    return left.unionByName(right)
