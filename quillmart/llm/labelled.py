"""The labelled rows that a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. Null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def training_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int, most_chars: int) -> DataFrame:
    """(text, y): at most ``rows`` labelled documents outside fold 0, those with the smallest hash of
    their id, so the sample is spread over the table and the same on every run.

    Texts over ``most_chars`` are passed over (not cut), which bounds what the driver
    gets to rows x most_chars. Null labels and ids teach nothing; of several
    labels of one id the largest counts.
    """
    y = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold() != 0))
         .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    chosen = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return (documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .where(F.length("text") <= most_chars)
            .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
            .orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "y"))
