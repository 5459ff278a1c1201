"""The operators of this subpackage as queries over the supplied tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    binary_packing, bpe_codec, centroid_clusters, chat_snapshots, checks, kneser_ney, line_edit_dedup, pivotal_mix,
    repetition_rules, simhash_pivots, topk_pivots, toxicity_mil, url_equivalence, whitening,
)

# ---- fixed values: the url rules (host, path, action) and the tokenizer ----
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector."""
    found = topk_pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)
    return found.select(
        F.col("query_id").cast("long"), F.col("rank").cast("int"), F.col("vec_id").cast("long"), "score"
    )


@query
def op2_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, repetition coverage and verdict of every document."""
    return repetition_rules.repetition_report(table(spark, sf_dir, "documents"), repetition_rules.FALLING)


@query
def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    return kneser_ney.judge_by_perplexity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_line_edit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those dropped as equal or near to an earlier one, links, and what stays."""
    docs = table(spark, sf_dir, "documents")
    done = line_edit_dedup.dedup_lines(docs)
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_links", "n_exact", "n_near",
        F.char_length("lines_kept").cast("long").alias("kept_chars"), F.md5("lines_kept").alias("kept_md5"),
    )


@query
def op5_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat_snapshots.format_chats(table(spark, sf_dir, "conversations"))


@query
def op6_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, and the sentence most to blame."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_mil.train(docs, table(spark, sf_dir, "labels"))
    return toxicity_mil.score_documents(docs, model).select(
        "doc_id", toxicity_mil.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score",
    )


@query
def op7_url_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return url_equivalence.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return pivotal_mix.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        F.when(~F.col("none"), F.col("name")).alias("source"), "copies",
    )


@query
def op9_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash_pivots.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


@query
def op10_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document."""
    pieces = binary_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return binary_packing.piece_digests(pieces)


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distances and centroid of every vector of 64 components."""
    found = centroid_clusters.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed="1")
    return centroid_clusters.clustering_report(found).withColumn("vec_id", F.col("vec_id").cast("long"))


@query
def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe_codec.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe_codec.codec_digests(encoded, ranks, pattern)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first four whitening components."""
    vectors = table(spark, sf_dir, "embeddings")
    models = whitening.fit(vectors, components=4)
    return whitening.whiten(vectors, models).withColumn("vec_id", F.col("vec_id").cast("long")).drop("dim")


# The other operators (perplexities, edit distances over all lines, learned weights, rounding, fingerprints, tokens)
# are beyond SQL or too slow in it: tests compare them with brute force.
CHECKS.update({
    "op1_topk_pivots": checks.TOPK,
    "op2_repetition_rules": checks.repetition(repetition_rules.FALLING.ngrams, repetition_rules.FALLING.lines),
    "op5_chat_snapshots": checks.CHATS,
    "op7_url_equivalence": checks.urls(URL_RULES),
    "op11_centroid_clusters": checks.clusters(),
})
