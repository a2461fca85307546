"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import pickle
import re
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_path

#: A word: a run of characters other than space, tab, newline, VT, FF, CR.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the whole text (null: empty), whatever else the table has."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def remainder(column: str, mod: int):
    """crc32(id as text) mod ``mod``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(mod)


def held_out(column: str, mod: int):
    """Is the row held out of training (a row without id is not, but never trains either)?"""
    return F.coalesce(remainder(column, mod) == 0, F.lit(False))


def hash_bound(share: float) -> int | None:
    """A 64-bit hash is below this with the chance ``share``; None where all are."""
    return -(1 << 63) + int(share * 2.0 ** 64) if share < 1 else None


def strings(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    """The texts of a column one at a time, so that only one is a Python string at once."""
    for x in batch.column(batch.schema.get_field_index(name)):
        yield x.as_py()


class Shipped:
    """A broadcast object of one of our classes, for executors without a copy of the package.

    ``Broadcast`` pickles classes by reference; here the object goes as bytes that hold its class.
    """

    def __init__(self, spark: SparkSession, value: Any):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self) -> Any:
        """The object, in a task: load it once."""
        return pickle.loads(self.sent.value)


def lean(run: Callable) -> Callable:
    """A task function that gives its memory back at the end: Python workers outlive their tasks."""
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):       # another C library: nothing to trim
            pass
    return wrapped


class Scratch:
    """Tables written under ``spark.checkpoint.dir`` to cut lineage: any executor can reread them.

    A lost executor only repeats the tasks of the step it was in. ``drop`` removes
    a table that is no longer needed, ``release`` lets Spark's cleaner remove the
    shuffle files of finished steps.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str, codec: str = "zstd", narrow: bool = False) -> DataFrame:
        """``narrow``: a table of a few numbers a row, written as a few files for each core."""
        path = f"{self.base}/{name}"
        if narrow:
            df = df.coalesce(4 * self.spark.sparkContext.defaultParallelism)
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def release(self) -> None:
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)


def components(edges: DataFrame, scratch: Scratch, name: str = "cc", src: str = "a",
               dst: str = "b") -> DataFrame:
    """Connected components of an edge list: (node, component = smallest node of it).

    Alternating large-star and small-star steps; each is one map-side combined
    minimum per node and one join, so a node with very many edges is only a
    skewed join key (AQE splits it). Ends when every node points to its root.
    """
    def canonical(e: DataFrame) -> DataFrame:
        return (e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u <> v").distinct())

    def done(e: DataFrame) -> bool:
        """Every node has one edge to a root, or is a root."""
        ends = e.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
            e.select("v", F.lit(0), F.lit(1)))
        many = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
        return not many.filter("out > 1 or (out = 1 and in = 1)").head(1)

    now = scratch.write(canonical(edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))), f"{name}0", narrow=True)
    rnd = 0
    while not done(now):
        rnd += 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node's smaller neighbours and itself go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = scratch.write(canonical(small), f"{name}{rnd}", narrow=True)
        scratch.drop(f"{name}{rnd - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node")))


def groups(batches, keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of a stream sorted by ``keys``; holds one group at a time.

    Keys are non-null numbers or strings.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            v = c.to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            key = tuple(c[s].as_py() for c in cols)
            if key != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield last, pa.Table.from_batches(held)


def least_labels(linked: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix of links: the least name in each row's component."""
    label = names.copy()
    while True:
        reach = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(label, reach)
        if (new == label).all():
            return label
        label = new


def joined_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n rows and links (i, j) between them: the first row of each row's component."""
    label = np.arange(n)
    while True:
        old = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == old).all():
            return label


def spread(rows: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """Adds (lo, hi, side) so that every two members of a bucket meet in exactly one small group.

    ``rows`` has the bucket's size n. A bucket of up to ``block`` members is one group
    (0, 0). A larger one is cut into blocks by a hash of the member, and block i meets
    block j >= i in group (i, j): no group holds more than about two blocks, however
    large the bucket is.
    """
    return (rows.withColumn("of", F.ceil(F.col("n") / block).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64(member, key), F.col("of")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .withColumn("side", (F.col("own") == F.col("hi")).cast("int"))
            .drop("of", "own", "other", "n"))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    return hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all of them (one to one)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(h: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hashes of all n consecutive words, from the words' hashes (a polynomial, then mixed)."""
    width = len(h) - n + 1
    if width <= 0:
        return np.zeros(0, np.uint64)
    out, base = h[:width].copy(), np.uint64(base)
    for k in range(1, n):
        out *= base
        out += h[k:k + width]
    return mixed(out)
