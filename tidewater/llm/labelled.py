"""Bounded samples of labelled rows, and the features of exactly those documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_bound, remainder

FOLDS = 5


def training_labels_all(labels: DataFrame, column: str, folds: int = FOLDS) -> DataFrame:
    """(doc_id, y) of every training row: ids whose crc32 remainder is not 0.

    A document labelled more than once counts as 1 if any label says so; null ids
    and labels other than 0 and 1 are left out.
    """
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
            .filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
            .filter(remainder("doc_id", folds) != 0))


def training_labels(labels: DataFrame, column: str, per_class: int, folds: int = FOLDS) -> DataFrame:
    """At most ``per_class`` training rows of each class: those with the least hashes of the id.

    The hashes are bounded by the class's size first, so that some ``2 * per_class`` rows
    leave all tasks together, not ``per_class`` rows each of them.
    """
    y = training_labels_all(labels, column, folds).withColumn("h", F.xxhash64("doc_id"))
    counts, pick = class_counts(labels, column, folds), []
    for c in (0, 1):
        one = y.filter(F.col("y") == c)
        bound = hash_bound((2 * per_class + 64) / max(counts.get(c, 0), 1))
        if bound is not None:
            one = one.filter(F.col("h") < bound)
        pick.append(one.orderBy("h", "doc_id").limit(per_class))
    return pick[0].union(pick[1]).drop("h")


def class_counts(labels: DataFrame, column: str, folds: int = FOLDS) -> dict[int, int]:
    """All training rows of each class (the sample's rates are corrected by them)."""
    return {r["y"]: r["count"] for r in training_labels_all(labels, column, folds).groupBy("y").count().collect()}
