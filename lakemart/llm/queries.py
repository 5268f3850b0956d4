"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    bpe, centroids, chat_format, content_sort, fingerprints, mixing, near_dedup, pii, quality_rules, secrets, source_divergence, substring_dedup, token_counts,
)
from lakemart.llm.common import read_documents

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
SURROGATE_KEY = b"key of the sample runs"  # a real run passes its own


def substring_removal(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeated(read_documents(spark, folder), digests=True)


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(read_documents(spark, folder))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_documents(spark, folder), carry=("doc_id",))


def fixed_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold the template's own control strings."""
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    made = chat_format.format_paths(chat_format.chains(turns.unionByName(fixed_conversation(spark))))
    read = chat_format.read_turns(F.col("formatted"))
    line = F.lit("\n")
    whole = F.array_join(F.transform(F.col("turns"), lambda t: F.concat(t["role"], line, t["text"], line)), "")
    return (
        made.withColumns({"turns": read, "loss": chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))})
        .select(
            F.col("tree").alias("conv_id"),
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(whole, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_decode(read_documents(spark, folder), public_tokenizers.path(WORD_BPE), digests=True)


def host_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(read_documents(spark, folder))
    return judged.select("doc_id", *quality_rules.FIGURES, "base_failed", "kept", "host_rate")


def merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read_documents(spark, folder))


def pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    replaced = pii.pseudonymize(read_documents(spark, folder), SURROGATE_KEY)
    return replaced.select("doc_id", "n_entities", "spans", "text")


def piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read_documents(spark, folder), public_tokenizers.path(PIECE_BPE))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(read_documents(spark, folder))


def divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(read_documents(spark, folder))


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return content_sort.content_groups(read_documents(spark, folder))


def centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": substring_removal,
        "op2_secret_scan": secret_scan,
        "op3_source_mixing": source_mixing,
        "op4_chat_formatting": chat_formatting,
        "op5_bpe_round_trip": bpe_round_trip,
        "op6_host_quality": host_quality,
        "op7_merkle_fingerprints": merkle_fingerprints,
        "op8_pii_surrogates": pii_surrogates,
        "op9_token_counts": piece_counts,
        "op10_near_dedup": near_duplicates,
        "op11_source_divergence": divergence_audit,
        "op12_exact_dedup": exact_dedup,
        "op13_centroid_clustering": centroid_clustering,
    }
