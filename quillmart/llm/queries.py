"""The queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm import (
    byte_bpe, decontaminate, fingerprints, jaccard, lines, pivots, quality, rollup, secrets, substrings, toxicity, walsh,
    wavelet)
from quillmart.llm.common import dealt_anew, table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
END_ID = 1


def _json(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item, similarity and place of the best span."""
    return decontaminate.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's findings and their verdicts by ownership (repository: doc_id, owner: source)."""
    return secrets.secret_scan(spark, table(spark, sf_dir, "documents"))


def op3_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits: all documents are inserted; then blank lines and trailing blanks
    are cleaned away (revised counts) and exact copies of an earlier document deleted; the last
    batch is committed once more, and a fourth deletes what is left of empty documents."""
    documents = table(spark, sf_dir, "documents")
    json_text = _json(BYTE_BPE)

    def counted(df, op, seq):
        return rollup.count_tokens(spark, df, json_text, "byte_bpe_50k").withColumns(
            {"op": F.lit(op), "seq": F.lit(seq)})

    cleaned = F.regexp_replace(F.regexp_replace("text", r"[ \t]+(\n|$)", "$1"), r"\n{2,}", "\n")
    revised = documents.where(cleaned != F.col("text")).withColumn("text", cleaned)
    digest = documents.select("doc_id", "source", "lang", F.xxhash64("text").alias("a"), F.md5("text").alias("b"))
    first = digest.groupBy("a", "b").agg(F.min("doc_id").alias("first")).select(dealt_anew("a"), "b", "first")
    copies = (digest.join(first, ["a", "b"]).where(F.col("doc_id") > F.col("first"))
              .select("doc_id", "source", "lang", F.lit("byte_bpe_50k").alias("tokenizer_version"),
                      F.lit(0).cast("long").alias("n_tokens"), F.lit("delete").alias("op"), F.lit(2).alias("seq")))
    changes = counted(revised, "revise", 1).unionByName(copies)
    ledger = rollup.TokenLedger(spark)
    ledger.commit(1, counted(documents, "insert", 0))
    ledger.commit(2, changes)
    ledger.commit(2, changes)
    empty = (ledger.documents().where(F.col("n_tokens") == 0)
             .select("doc_id", "source", "lang", "tokenizer_version", "n_tokens",
                     F.lit("delete").alias("op"), F.lit(0).alias("seq")))
    ledger.commit(3, empty)
    return ledger.totals()


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    return quality.quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, number and crc32 of each one's ids."""
    return wavelet.token_files(spark, table(spark, sf_dir, "documents"), _json(WORD_BPE), END_ID,
                               digest=True, lower=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    return toxicity.toxicity_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of similar documents."""
    return jaccard.jaccard_join(spark, table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path(MULTI_RANKS))
    return byte_bpe.id_digest(table(spark, sf_dir, "documents"), spark, ranks, public_tokenizers.PATTERN)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when repeated windows of 35 words go."""
    return substrings.substring_dedup(spark, table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and what the two and the next one share."""
    return fingerprints.fingerprint_edits(spark, table(spark, sf_dir, "documents"))


def op11_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight centroids over all vectors of 64 components."""
    return walsh.cluster(spark, table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the document of the smallest id."""
    return lines.dedup_lines(table(spark, sf_dir, "documents"), digest=True)


def op13_pivot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four code bytes for every vector."""
    return pivots.part_codes(spark, table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_secret_ownership, op3_token_rollup, op4_quality_cnn, op5_wavelet_files,
    op6_toxicity, op7_jaccard_join, op8_byte_bpe, op9_substring_dedup, op10_fingerprints,
    op11_walsh_clusters, op12_line_dedup, op13_pivot_codes,
)}
ORACLE: dict[str, str] = {
    "op11_walsh_clusters": walsh.ORACLE, "op12_line_dedup": lines.ORACLE, "op13_pivot_codes": pivots.ORACLE,
}
