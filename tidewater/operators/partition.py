"""Routing of rows to parallel tasks (the physical partitioners)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUBTASK = "subtask"


def shuffle(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Uniform random placement (seeded, so a retried stage places rows alike)."""
    return df.repartition(n, F.floor(F.rand(seed) * n))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round robin over ``n`` partitions; evens out skewed sources."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Cheaper local regrouping: merge neighbouring partitions without a
    shuffle when shrinking, round robin when growing."""
    if n <= df.rdd.getNumPartitions():
        return df.coalesce(n)
    return df.repartition(n)


def broadcast_copies(df: DataFrame, n: int) -> DataFrame:
    """Every row to every one of ``n`` subtasks (``n`` copies, column
    ``subtask`` = the partition that holds the copy)."""
    copies = df.withColumn(SUBTASK, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col(SUBTASK))


def to_global(df: DataFrame, n: int) -> DataFrame:
    """All rows to subtask 0 of ``n``. Serial by definition; use only for
    already-reduced results."""
    return df.repartitionById(n, F.lit(0))


def key_by(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Hash placement: equal keys share a partition (many keys per partition)."""
    return df.repartition(n, *keys)


def custom(df: DataFrame, n: int, partition_of: Column) -> DataFrame:
    """Place each row in the partition computed by ``partition_of`` (taken
    modulo ``n`` with a non-negative remainder)."""
    return df.repartitionById(n, F.pmod(partition_of, F.lit(n)))


def int_key_partitioner(key: Column | str) -> Column:
    """The demo partitioner: the key parsed as an integer."""
    c = F.col(key) if isinstance(key, str) else key
    return c.cast("int")
