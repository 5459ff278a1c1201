"""From raw documents to packed sequences: five stages, each written and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelflens.llm import binary_packing, line_edit_dedup, pivotal_mix, repetition_rules, simhash_pivots
from shelflens.llm.queries import TOKENIZER
from shelflens.staging import stage, unstage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return repetition_rules.keep_by_repetition(docs, repetition_rules.FALLING)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal or near to an earlier line go; the documents stay."""
    return line_edit_dedup.without_repeated_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return simhash_pivots.drop_near_duplicates(docs, shingle=3, max_distance=2)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go, stay or repeat so that the sources meet their targets."""
    return pivotal_mix.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of one document each, without padding."""
    return binary_packing.piece_digests(binary_packing.pack(docs, public_tokenizers.path(TOKENIZER)))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Rounding, components and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, one after another."""
    docs, staged = spark.read.parquet(f"{sf_dir}/documents.parquet"), False
    for name, function in STAGES[:-1]:
        kept = stage(function(spark, docs, sf_dir), name)
        if staged:
            unstage(docs)
        docs, staged = kept, True
    return STAGES[-1][1](spark, docs, sf_dir)
