"""Processing-time joins of streams: arrival times that a replay doesn't change.

A row's arrival time is the clock when its micro-batch first ran. ``land`` writes a stream's
micro-batches to a table, each stamped once: the stamp of a batch id is stored before its rows,
and a batch that runs again after a failure finds it and writes the same rows with the same time.
Joins and windows on the landed tables are then ordinary event-time operators on ``ingest_ts``,
and give the same result whenever they are run again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import joins
from ..sinks.files import filesystem, write_new
from .run import run_batches

INGEST = "ingest_ts"


def stamp_of(path: str, batch_id: int) -> int:
    """The arrival time of a batch (epoch microseconds): the one stored for it, else now, which is stored."""
    fs, base = filesystem(path)
    name = f"{base}/_stamps/{batch_id}"
    write_new(fs, name, json.dumps(time.time_ns() // 1000))
    with fs.open_input_stream(name) as f:
        return json.loads(f.read())


def land(df: DataFrame, path: str, name: str, checkpoint: str | None = None, col: str = INGEST) -> StreamingQuery:
    """Lands everything available now under ``path``, with the arrival time as column ``col``."""
    def batch(rows: DataFrame, batch_id: int) -> None:
        stamp = stamp_of(path, batch_id)
        rows.withColumn(col, F.timestamp_micros(F.lit(stamp))).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run_batches(df, name, batch, checkpoint)


def landed(spark: SparkSession, path: str, schema, streaming: bool = False, col: str = INGEST) -> DataFrame:
    """The landed rows of a stream with ``schema``, with their arrival time, as a table or as a stream."""
    whole = spark.createDataFrame([], schema).withColumn(col, F.lit(None).cast("timestamp")).schema
    reader = (spark.readStream if streaming else spark.read).schema(whole)
    return reader.option("basePath", path).parquet(f"{path}/batch=*").drop("batch")


def window_join(left: DataFrame, right: DataFrame, key: Sequence[str], size: str, col: str = INGEST) -> DataFrame:
    """Inner join of two landed tables: rows of a key that arrived in the same tumbling window."""
    return joins.window_join(left, right.withColumnRenamed(col, f"right_{col}"), key, col, f"right_{col}", size)
