"""Late-row routing for streams (whole-stream watermark).

Inside a micro-batch the watermark is fixed: it is the largest event time
of all earlier micro-batches minus the delay and one millisecond (a row delay and 1 ms behind is on time). Rows below it are late. Spark
drops such rows in stateful operators and only counts them; this writer
keeps them: every micro-batch is split into an on-time and a late output,
and the running maximum is stored per batch id in a small table, so a
replayed batch (same id after a failure) rewrites the same files and sees
the same watermark.

With ``side`` (a column naming the input, for the two inputs of a join), the
running maximum is kept per input and the watermark is the smaller of the
inputs' watermarks (none until every input has been seen).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_micros


class LateRouter:
    """``foreachBatch`` callable: writes ``<out>/on_time/batch_id=N`` and
    ``<out>/late/batch_id=N`` and keeps the running max in ``<out>/_max``."""

    def __init__(self, out: str, ts: str, delay_seconds: float, fmt: str = "parquet",
                 side: str | None = None, sides: tuple[str, ...] = ("left", "right")):
        self.out, self.ts, self.delay_us, self.fmt = out.rstrip("/"), ts, int(delay_seconds * 1e6), fmt
        self.side, self.sides = side, tuple(sides) if side else ("all",)

    def _previous_max(self, spark, batch_id: int) -> dict[str, int]:
        """Running max per input after the previous batch (one tiny file per
        batch id; batch ids are consecutive, so only the previous one is read)."""
        if batch_id == 0:
            return {}
        try:
            rows = spark.read.parquet(f"{self.out}/_max/batch_id={batch_id - 1}").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}               # nothing was written before this batch
        return {r["side"]: r["max_us"] for r in rows if r["max_us"] is not None}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = self._previous_max(spark, batch_id)
        tnum = epoch_micros(batch, self.ts)
        seen_all = all(s in prev for s in self.sides)
        if not seen_all:
            flagged = batch.withColumn("is_late", F.lit(False))
        else:
            wm = min(prev[s] for s in self.sides) - self.delay_us - 1_000
            flagged = batch.withColumn("is_late", F.coalesce(tnum < F.lit(wm), F.lit(False)))
        flagged = flagged.persist()
        try:
            for name, cond in (("on_time", ~F.col("is_late")), ("late", F.col("is_late"))):
                (flagged.filter(cond).drop("is_late").write.mode("overwrite")
                 .format(self.fmt).save(f"{self.out}/{name}/batch_id={batch_id}"))
            side = F.col(self.side) if self.side else F.lit("all")
            cur = {r["s"]: r["m"] for r in
                   flagged.groupBy(side.alias("s")).agg(F.max(tnum).alias("m")).collect()}
            merged = {s: max(v for v in (prev.get(s), cur.get(s)) if v is not None)
                      for s in set(prev) | set(cur)
                      if prev.get(s) is not None or cur.get(s) is not None}
            rows = [(s, m) for s, m in merged.items()] or [("all", None)]
            (spark.createDataFrame(rows, "side string, max_us long").coalesce(1)
             .write.mode("overwrite").parquet(f"{self.out}/_max/batch_id={batch_id}"))
        finally:
            flagged.unpersist()
