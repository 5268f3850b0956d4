"""The corpus pipeline: five operators, each stage written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import bpe, mixing, near_dedup, quality_rules, secrets
from lakemart.llm.common import read_documents, stored
from lakemart.llm.queries import WORD_BPE

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apply_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own or their host's verdict keeps."""
    return quality_rules.keep(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.keep_first(docs).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    redacted = secrets.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: whole copies, and one document of a source in part."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document of the mix, as digests."""
    return bpe.encode_decode(docs, public_tokenizers.path(WORD_BPE), digests=True)


STAGES = [
    ("quality_rules", apply_quality),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents."""
    docs = read_documents(spark, sf_dir)
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


# SQL cannot express BPE and the weighted samples; tests/llm/test_pipeline.py runs a plain version.
ORACLE_SQL = None
