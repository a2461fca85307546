"""Late-row routing.

A row is late when its event time is below the watermark at its arrival; the
watermark before a row is ``max(event time of earlier arrivals) - delay - 1
ms``, so a row ``delay`` and 1 ms behind is still on time. Spark's streaming operators drop such rows and only count them, so
this is computed explicitly: in batch with the keyed prefix scan (for the
whole stream, the single group is split into ordered chunks, so no task
sees more than the chunk size), and in streams by ``streaming.late``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_micros, from_epoch_micros
from . import scan
from .split import split_by

WATERMARK = "watermark"
LATE = "is_late"
MARGIN_US = 1_000       # a bounded watermark trails the largest time by the delay and one millisecond


def flag_late(df: DataFrame, ts: str, arrival: Sequence[str], delay_seconds: float,
              key: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Add ``watermark`` (null before the first arrival) and ``is_late``.

    ``key=()`` is one watermark for the whole input (the stream semantics);
    a key gives every key its own watermark.
    """
    delay_us = int(delay_seconds * 1_000_000) + MARGIN_US
    tnum = epoch_micros(df, ts)
    out = scan.keyed_prefix(df, key, arrival,
                            {"_max": scan.running_max(tnum, inclusive=False)}, hot_rows)
    wm = F.col("_max") - F.lit(delay_us)
    return (out.withColumn(WATERMARK, from_epoch_micros(df, wm, df.schema[ts].dataType))
            .withColumn(LATE, F.coalesce(tnum < wm, F.lit(False)))
            .drop("_max"))


def split_late(df: DataFrame, ts: str, arrival: Sequence[str], delay_seconds: float,
               key: Sequence[str] = (), hot_rows: int | None = None) -> dict[str, DataFrame]:
    """``{"on_time": ..., "late": ...}``; the two outputs partition the input."""
    flagged = flag_late(df, ts, arrival, delay_seconds, key, hot_rows)
    return split_by(flagged, {"late": F.col(LATE)}, main="on_time")


def flag_late_pair(left: DataFrame, right: DataFrame, ts: str, arrival: Sequence[str],
                   delay_seconds: float, watermark: str = "own",
                   hot_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Late flags for the two inputs of a join that share one arrival order.

    ``watermark="own"``: each input against its own watermark.
    ``watermark="min"``: against the join's watermark, the smaller of the two
    inputs' watermarks at that point of arrival (an input that has seen no
    row yet holds the joint watermark back)."""
    if watermark == "own":
        return (flag_late(left, ts, arrival, delay_seconds, hot_rows=hot_rows),
                flag_late(right, ts, arrival, delay_seconds, hot_rows=hot_rows))
    if watermark != "min":
        raise ValueError("watermark must be 'own' or 'min'")
    delay_us = int(delay_seconds * 1_000_000) + MARGIN_US
    tnum = epoch_micros(left, ts)
    both = (left.withColumn("_side", F.lit("L"))
            .unionByName(right.withColumn("_side", F.lit("R")), allowMissingColumns=True))
    out = scan.keyed_prefix(both, (), arrival, {
        "_ml": scan.running_max(F.when(F.col("_side") == "L", tnum), inclusive=False),
        "_mr": scan.running_max(F.when(F.col("_side") == "R", tnum), inclusive=False)},
        hot_rows)
    wm = F.when(F.col("_ml").isNotNull() & F.col("_mr").isNotNull(),
                F.least(F.col("_ml"), F.col("_mr")) - F.lit(delay_us))
    flagged = (out.withColumn(WATERMARK, from_epoch_micros(left, wm, left.schema[ts].dataType))
               .withColumn(LATE, F.coalesce(tnum < wm, F.lit(False)))
               .drop("_ml", "_mr"))
    l = flagged.filter(F.col("_side") == "L").select(*left.columns, WATERMARK, LATE)
    r = flagged.filter(F.col("_side") == "R").select(*right.columns, WATERMARK, LATE)
    return l, r
