"""The corpus pipeline: five stages over ``documents``, each by one of the training-data operators.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, chosen_path, latent, quality, recompress
from tidewater.llm.common import table
from tidewater.llm.queries import vocabulary
from tidewater.session import shared_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant rejects go."""
    return quality.passing(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return chosen_path.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that a smaller document has go; n_chars follows the text."""
    out = recompress.cleaned(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go."""
    return latent.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of what is left, with digests of ids and decoded text."""
    return bpe.digests(docs, vocabulary("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The stages fit models and search approximately: not expressible in SQL (see tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to ids."""
    base = shared_path(spark, "pipeline", uuid.uuid4().hex)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
