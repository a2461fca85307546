"""Side outputs for streams: one query, every branch written per micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.split import ROUTE, route_column


class SplitWriter:
    """``foreachBatch`` callable writing ``<out>/<branch>/batch_id=N`` for every
    branch of :func:`operators.split.split_by` (plus ``main``). The batch is
    routed once and persisted, so the source is read once per micro-batch;
    a replayed batch id overwrites its own files (idempotent)."""

    def __init__(self, out: str, branches: dict[str, Column], main: str = "main",
                 fmt: str = "parquet"):
        self.out, self.branches, self.main, self.fmt = out.rstrip("/"), branches, main, fmt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        routed = batch.withColumn(ROUTE, route_column(self.branches, self.main)).persist()
        try:
            for name in [*self.branches, self.main]:
                (routed.filter(F.col(ROUTE) == name).drop(ROUTE)
                 .write.mode("overwrite").format(self.fmt)
                 .save(f"{self.out}/{name}/batch_id={batch_id}"))
        finally:
            routed.unpersist()
