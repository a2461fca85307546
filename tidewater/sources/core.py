"""Sources: tables, text lines, message-log records and generated sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One test table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def text_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """One string per line (``value``), bounded (batch) or a directory stream."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def decode_records(records: DataFrame, topics: Sequence[str] | str | None = None,
                   starting_offsets: dict | str | None = None,
                   watermark: str | None = "3 seconds") -> DataFrame:
    """Decode a frame in the message-log schema (key, value, topic, partition,
    offset, timestamp) into ``value string`` rows.

    ``starting_offsets`` is the start position, and committed group offsets
    play no part in it: ``"earliest"`` (or ``None``) keeps every record;
    ``"latest"`` keeps none of the records already in a batch frame (only
    records that arrive later, i.e. on a stream); a dict gives the first
    offset to keep as ``{topic: {partition: offset}}`` (or ``{partition: offset}``
    when one topic is read). The frame may be a batch or a stream from
    ``read[Stream].format("kafka")``.
    """
    out = records
    if topics is not None:
        names = [topics] if isinstance(topics, str) else list(topics)
        out = out.filter(F.col("topic").isin(names))
    if starting_offsets == "latest" and not out.isStreaming:
        out = out.filter(F.lit(False))
    elif isinstance(starting_offsets, str) and starting_offsets not in ("earliest", "latest"):
        raise ValueError("starting_offsets must be 'earliest', 'latest' or a dict")
    if isinstance(starting_offsets, dict) and starting_offsets:
        # {topic: {partition: offset}}, or {partition: offset} when one topic is read
        by_topic = {t: o for t, o in starting_offsets.items() if isinstance(o, dict)}
        if len(by_topic) != len(starting_offsets):
            one = topics if isinstance(topics, str) else (list(topics)[0] if topics and len(topics) == 1 else None)
            if by_topic or one is None:
                raise ValueError("offsets of several topics are {topic: {partition: offset}}")
            by_topic = {one: starting_offsets}
        keep, known = F.lit(False), F.lit(False)
        for topic, parts in by_topic.items():
            for part, first in parts.items():
                at = (F.col("topic") == topic) & (F.col("partition") == int(part))
                keep, known = keep | (at & (F.col("offset") >= first)), known | at
        out = out.filter(keep | ~known)
    out = out.select(F.col("value").cast("string").alias("value"),
                     F.col("timestamp").cast("timestamp").alias("timestamp"))
    if watermark and out.isStreaming:
        out = out.withWatermark("timestamp", watermark)
    return out


def generate(spark: SparkSession, n: int, fn, num_partitions: int = 2,
             start: int = 0) -> DataFrame:
    """Bounded generator: ``fn(index Column) -> Column`` over ``[start, start+n)``.

    The index range is split evenly over ``num_partitions`` (with 2 parts,
    0-49 and 50-99 for n=100).
    """
    ids = spark.range(start, start + n, 1, num_partitions)
    return ids.select(F.col("id").alias("index"), fn(F.col("id")).alias("value"))


def generate_from(df: DataFrame, index: str, fn, keep: list[str] | None = None) -> DataFrame:
    """The generator's function over the rows of a table, batch or stream: ``fn(index Column) ->
    Column`` for every row's ``index``, beside the columns ``keep``."""
    return df.select(F.col(index).alias("index"), fn(F.col(index)).alias("value"), *(keep or []))


def generate_stream(spark: SparkSession, fn, rows_per_batch: int = 1000,
                    num_partitions: int = 2, rows_per_second: int | None = None) -> DataFrame:
    """Unbounded generator: a fixed number of rows per micro-batch, or (with
    ``rows_per_second``) a fixed rate on the processing clock."""
    if rows_per_second:
        src = (spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second))
               .option("numPartitions", str(num_partitions)).load())
    else:
        src = (spark.readStream.format("rate-micro-batch")
               .option("rowsPerBatch", str(rows_per_batch))
               .option("numPartitions", str(num_partitions)).load())
    return src.select(F.col("value").alias("index"), fn(F.col("value")).alias("value"))


def number_label(index: Column) -> Column:
    # Fixed value: the generator's text form is "Number:" followed by the index.
    return F.concat(F.lit("Number:"), index.cast("string"))
