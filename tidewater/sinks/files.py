"""Rolling text-file sink for streams.

Rows are written as UTF-8 lines into time-bucket directories
(``bucket=yyyy-MM-dd HH`` by default, from the processing clock), a new set
of files per trigger (time rolling) and at most ``max_records_per_file``
lines per file (size rolling by record count). Output is exactly-once: the
file sink commits each micro-batch in its metadata log under the output
folder and the query checkpoint, so a restarted query neither loses nor
duplicates lines. File names are chosen by the committer.

:func:`named_text_sink` writes files with a name prefix and suffix that roll
by bytes. It is a streaming data source with a commit protocol of its own:
tasks write files of other names under ``_work``; a batch's commit stores
its list of moves under ``_log``, makes them, and marks the batch as done. A
batch that runs again after a failure finishes the stored moves and drops
what it wrote anew, so no line is lost or written twice, and a reader of the
buckets never sees a file that is still being written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..streaming.run import checkpoint_for

BUCKET = "bucket"


def rolling_text_sink(df: DataFrame, path: str, name: str, value: str = "value",
                      bucket_format: str = "yyyy-MM-dd HH", roll_every: str = "1 minute",
                      max_records_per_file: int | None = None,
                      checkpoint: str | None = None, available_now: bool = False,
                      bucket_col: str | None = None) -> StreamingQuery:
    """Start the sink; ``bucket_col`` buckets by a given timestamp column
    instead of the processing clock."""
    stamp = F.col(bucket_col) if bucket_col else F.current_timestamp()
    out = df.select(F.col(value).cast("string").alias("value"),
                    F.date_format(stamp, bucket_format).alias(BUCKET))
    writer = (out.writeStream.format("text").queryName(name).outputMode("append")
              .partitionBy(BUCKET)
              .option("path", path)
              .option("checkpointLocation", checkpoint or checkpoint_for(df.sparkSession, name)))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=roll_every))
    return writer.start()


# -- files with names and a byte limit ------------------------------------------------

def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _exists(fs: pafs.FileSystem, name: str) -> bool:
    return fs.get_file_info(name).type != pafs.FileType.NotFound


def write_new(fs: pafs.FileSystem, name: str, text: str) -> bool:
    """Writes a small file whole or not at all; leaves one that is there. Was it new?"""
    if _exists(fs, name):
        return False
    folder, last = name.rsplit("/", 1)
    fs.create_dir(folder, recursive=True)
    made = f"{folder}/.{last}.{uuid.uuid4().hex}"
    with fs.open_output_stream(made) as f:
        f.write(text.encode())
    fs.move(made, name)
    return True


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: (work file, bucket, task, number in its task and bucket)."""

    files: list[tuple[str, str, int, int]]


class NamedFilesWriter(DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.prefix, self.suffix = options.get("prefix", "part"), options.get("suffix", ".log")
        self.max_bytes = int(options.get("max_bytes", str(1 << 20)))

    def write(self, rows: Iterator) -> Written:
        """Lines of the rows (value, bucket) to work files; a file ends with the line that fills it."""
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        fs, base = filesystem(self.path)
        fs.create_dir(f"{base}/_work", recursive=True)
        open_: dict[str, tuple] = {}            # bucket: stream, bytes
        files, count = [], {}

        def new(bucket: str):
            name = f"{base}/_work/{uuid.uuid4().hex}"
            k = count[bucket] = count.get(bucket, -1) + 1
            files.append((name, bucket, task, k))
            return fs.open_output_stream(name), 0

        try:
            for value, bucket in rows:
                line = ((value or "") + "\n").encode("utf-8")
                out, size = open_.pop(bucket, None) or new(bucket)
                out.write(line)
                if size + len(line) >= self.max_bytes:
                    out.close()
                else:
                    open_[bucket] = out, size + len(line)
        finally:
            for out, _ in open_.values():
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        fs, base = filesystem(self.path)
        files = [f for m in messages if m for f in m.files]
        moves = [(work, f"{base}/{bucket}/{self.prefix}-{batchId}-{task}-{k}{self.suffix}") for work, bucket, task, k in files]
        done, plan = f"{base}/_log/{batchId}.done", f"{base}/_log/{batchId}.moves"
        if _exists(fs, done) or not write_new(fs, plan, json.dumps(moves)):
            self._drop(fs, [w for w, _ in moves])           # an earlier run of this batch got this far
        if not _exists(fs, done):
            with fs.open_input_stream(plan) as f:
                stored = json.loads(f.read())
            for work, name in stored:
                if _exists(fs, work):
                    fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    fs.move(work, name)
            write_new(fs, done, "")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._drop(filesystem(self.path)[0], [f[0] for m in messages if m for f in m.files])

    @staticmethod
    def _drop(fs: pafs.FileSystem, names: list[str]) -> None:
        for n in names:
            if _exists(fs, n):
                fs.delete_file(n)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def streamWriter(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options)


def named_text_sink(df: DataFrame, path: str, name: str, value: str = "value", prefix: str = "part",
                    suffix: str = ".log", max_bytes: int = 1 << 20, bucket_format: str = "yyyy-MM-dd--HH",
                    roll_every: str = "1 minute", checkpoint: str | None = None, available_now: bool = False,
                    bucket_col: str | None = None) -> StreamingQuery:
    """Starts a sink of files ``<bucket>/<prefix>-<batch>-<task>-<number><suffix>``, each of at most one
    line over ``max_bytes``, a new set every ``roll_every``. ``path`` is a path or URI that driver and
    executors share. A null line is an empty one."""
    df.sparkSession.dataSource.register(NamedFiles)
    stamp = F.col(bucket_col) if bucket_col else F.current_timestamp()
    out = df.select(F.col(value).cast("string").alias("value"),
                    F.coalesce(F.date_format(stamp, bucket_format), F.lit("none")).alias(BUCKET))
    writer = (out.writeStream.format("named_files").queryName(name).outputMode("append")
              .options(path=path, prefix=prefix, suffix=suffix, max_bytes=str(max_bytes))
              .option("checkpointLocation", checkpoint or checkpoint_for(df.sparkSession, name)))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=roll_every)).start()
