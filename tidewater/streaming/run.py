"""Starting and finishing streaming queries.

Checkpoints always live under the session's shared ``spark.checkpoint.dir``
(the same folder every executor and a restarted driver can reach).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_path


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "streams", name)


def run_available_now(df: DataFrame, name: str, mode: str = "append",
                      sink: str = "memory", path: str | None = None,
                      checkpoint: str | None = None, timeout_s: float | None = None,
                      options: dict[str, str] | None = None,
                      processing_time: bool = False) -> StreamingQuery:
    """Process everything available now, then stop. ``sink="memory"``
    registers the result as table ``name``. It runs as long as it needs, or at
    most ``timeout_s``. ``processing_time=True`` (queries
    with processing-time state or TTL) turns off no-data micro-batches,
    which would otherwise keep such a query running after its input ends."""
    spark = df.sparkSession
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key, "true")
    if processing_time:
        spark.conf.set(key, "false")
    writer = (df.writeStream.outputMode(mode).queryName(name)
              .option("checkpointLocation", checkpoint or checkpoint_for(spark, name))
              .trigger(availableNow=True))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    try:
        q = writer.format("memory").start() if sink == "memory" else writer.format(sink).start(path)
    finally:
        spark.conf.set(key, before)
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q


def run_batches(df: DataFrame, name: str, fn: Callable[[DataFrame, int], None],
                checkpoint: str | None = None, timeout_s: float | None = None) -> StreamingQuery:
    """``foreachBatch`` with availableNow; ``fn(batch, batch_id)`` must be
    idempotent per batch id (a retried batch is replayed with the same id)."""
    spark = df.sparkSession
    q = (df.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_for(spark, name))
         .trigger(availableNow=True).foreachBatch(fn).start())
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q


def closing_rows(df: DataFrame, ts: str, key: list[str], far: str = "2999-01-01") -> DataFrame:
    """One row per key far in the future, to append to a bounded input so
    that the watermark passes every open window and timer (a bounded
    stream gets no final watermark of its own). Marked ``_closing`` so it can
    be dropped from the results."""
    ks = df.select(*key).distinct() if key else df.limit(1).select()
    extra = ks.withColumn(ts, F.lit(far).cast(df.schema[ts].dataType))
    for f in df.schema.fields:
        if f.name not in extra.columns:
            extra = extra.withColumn(f.name, F.lit(None).cast(f.dataType))
    return extra.select(*df.columns)
