"""Top-N items per window (count per item and sliding window, then rank)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import sliding


def window_topn(df: DataFrame, item: str, ts: str, size: str, slide: str, n: int = 3,
                ascending: bool = False) -> DataFrame:
    """Per window: the ``n`` items with the highest count (``ascending``: the
    lowest), ties by item. Output: window_start, window_end, rank, item, cnt.

    Two exchanges, as in the keyed form: (item, window) for the partially
    aggregated counts, then window_end for the rank; the rank filter becomes
    a per-partition group limit placed before the second shuffle, so only
    ``n`` rows per window and task move.
    """
    counts = sliding(df, [item], ts, size, slide, {"cnt": F.count(F.lit(1))})
    by_count = F.col("cnt").asc() if ascending else F.col("cnt").desc()
    w = Window.partitionBy("window_end", "window_start").orderBy(by_count, F.col(item).asc())
    return (counts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n)
            .select("window_start", "window_end", F.col("rank").cast("bigint").alias("rank"),
                    item, "cnt"))
