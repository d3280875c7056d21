"""The corpus pipeline: documents in, clean documents with their token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next stage's documents. All stages but
the last return the columns of documents.

Defined cases, in every stage: a null text is an empty one, which no stage removes or changes; texts
of any length are read whole; null and repeated ids stay, with one decision per row (of
equal texts, one row stays); columns of other names, also those that operators use
inside, pass through; empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillmart.llm import byte_bpe, decontaminate, jaccard, secrets, toxicity
from quillmart.llm.common import stage, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier rejects go. It learns from the labels of the
    stage's own documents."""
    return toxicity.drop_toxic(spark, docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays."""
    return jaccard.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: live-looking credentials are masked; copied examples (see ``secrets``) and all documents stay."""
    return secrets.mask_live(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: each document's ids and the digests of ids and decoded bytes."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANKS))
    return byte_bpe.id_digest(docs, spark, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scan", mask_secrets),
    ("byte-level BPE", encode),
]
# Learned weights and merges by rank are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(spark, apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
