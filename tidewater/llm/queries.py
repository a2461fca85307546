"""The registered queries of the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, caps, chosen_path, html, latent, lattice, merkle, quality, recompress, repetition, runs, shards,
               toxicity)
from .common import table
from .oracle import ORACLE

#: Folder of the public tokenizer files, those of the installed package unless another is named.
TOKENIZERS = os.environ.get("TIDEWATER_TOKENIZERS") or os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))


def vocabulary(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


def op2_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near(table(spark, sf_dir, "documents"))


def op3_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.scores(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near(table(spark, sf_dir, "embeddings"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.manifest(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op8_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.digests(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.rules(table(spark, sf_dir, "documents")).drop("n_repeats")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(table(spark, sf_dir, "documents")).drop("source", "idx")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_chosen_path": op2_chosen_path,
    "op3_latent": op3_latent,
    "op4_lattice": op4_lattice,
    "op5_toxicity": op5_toxicity,
    "op6_caps": op6_caps,
    "op7_shards": op7_shards,
    "op8_recompress": op8_recompress,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_repetition": op11_repetition,
    "op12_merkle": op12_merkle,
    "op13_runs": op13_runs,
}

LLM_ORACLE: dict[str, str] = dict(ORACLE)
