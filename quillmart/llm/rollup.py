"""Token counts as delta-maintained rollups.

The state is a table of totals by source, language and tokenizer version, and beside it the
documents counted in them, in buckets of their key's hash. A batch of inserts, deletes
and revised counts reads the buckets of its own keys only; what these documents counted
before is taken away and what they count now added, as signed rows, and the totals are
updated by the sums of these. So a small batch costs its own buckets and the small totals
table, whatever came before.

A commit writes the signed rows, the touched buckets and the new totals to new folders; one
small file (``quillmart.sources.versions``) then puts them in place with the batch's id. A
crash before leaves the old state, and committing an id again changes nothing.

Defined cases: null ids, sources, languages and counts are values of their own
(a null count is 0); a delete or a revision of a document that is not
held is a no-op or an insert; of several changes of one key in a batch the
last by ``seq`` counts, and among equal ``seq`` the one with the largest count;
an empty batch commits nothing but its id; null and empty texts have no tokens, texts of
any length are counted whole; an empty table gives no totals. Other columns are ignored.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import shuffle_partitions, text_arrays
from quillmart.llm.tokens import ChunkEncoder
from quillmart.session import scratch_path
from quillmart.sources.versions import Versions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ["doc_id", "tokenizer_version"]
GROUPS = ["source", "lang", "tokenizer_version"]
HELD = "doc_id long, tokenizer_version string, source string, lang string, n_tokens long"
TOTALS = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"
BUCKET = "_bucket"
LEDGER = "doc_id long, source string, lang string, tokenizer_version string, d_docs long, d_tokens long"


def count_tokens(spark: SparkSession, documents: DataFrame, json_text: str, version: str,
                 lower: bool = False, keeps_space: bool = True, text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, n_tokens) of whole texts."""
    shared = spark.sparkContext.broadcast(json_text)  # one vocabulary, a few MB

    def per_partition(batches):
        encoder = ChunkEncoder(shared.value, keeps_space=keeps_space, lower=lower)
        for rows, texts in text_arrays(batches):
            _, first = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [rows[c].combine_chunks() for c in ("doc_id", "source", "lang")] + [
                    pa.array([version] * rows.num_rows, pa.string()), pa.array(first[1:] - first[:-1], pa.int64())],
                names=["doc_id", "source", "lang", "tokenizer_version", "n_tokens"])

    return documents.select("doc_id", "source", "lang", F.col(text_col).alias("text")).mapInArrow(
        per_partition, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long")


class TokenLedger:
    """Totals and documents under ``path`` (a folder that driver and executors share)."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "token-ledger")
        self.states, self.buckets = Versions(spark, self.path), buckets or max(64, shuffle_partitions(spark))

    def committed(self, batch_id: int) -> bool:
        return int(batch_id) in self.states.current().info.get("batches", [])

    def _read(self, schema: str, state, parts) -> DataFrame:
        paths = self.states.paths(state, parts)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _parts(self, state, prefix: str) -> set[str]:
        return {p for p in state.folders if p.startswith(prefix)}

    def ledger(self) -> DataFrame:
        """The signed rows of all committed batches."""
        state = self.states.current()
        return self._read(LEDGER, state, self._parts(state, "batch-"))

    def documents(self) -> DataFrame:
        """What is counted now: one row per document and tokenizer version."""
        state = self.states.current()
        return self._read(HELD, state, self._parts(state, "bucket-"))

    def totals(self) -> DataFrame:
        """Totals by source, language and tokenizer version; groups without documents go."""
        return self._read(TOTALS, self.states.current(), {"totals"})

    def _written(self, df: DataFrame, *by: str) -> str:
        folder = self.states.new_folder()
        writer = df.write.partitionBy(*by) if by else df.write
        writer.parquet(f"{self.path}/{folder}")
        return folder

    def _buckets_in(self, folder: str) -> list[int]:
        found = self.states.fs.listStatus(self.states._new(f"{self.path}/{folder}"))
        return sorted(int(f.getPath().getName().split("=")[1]) for f in found if f.isDirectory())

    def commit(self, batch_id: int, changes: DataFrame) -> bool:
        """Apply ``changes`` (doc_id, source, lang, tokenizer_version, n_tokens, op, seq), where op is
        'insert', 'revise' or 'delete'. False if this batch was committed before."""
        now, spark = self.states.current(), self.spark
        if int(batch_id) in now.info.get("batches", []):
            return False
        bucket = F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int").alias(BUCKET)
        last = (changes.groupBy(*KEYS).agg(F.max(F.struct(
            "seq", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "op", "source", "lang")).alias("c"))
            .select(*KEYS, "c.source", "c.lang", "c.n_tokens", (F.col("c.op") == "delete").alias("gone"), bucket))
        incoming = self._written(last.hint("rebalance", BUCKET), BUCKET)  # else every task writes a file per bucket
        touched = self._buckets_in(incoming)
        info = {"batches": [*now.info.get("batches", []), int(batch_id)]}
        if not touched:
            self.states.commit(now, now.folders, **info)
            return True
        last = spark.read.schema(f"{HELD}, gone boolean, {BUCKET} int").parquet(f"{self.path}/{incoming}")
        held = self._read(HELD, now, {f"bucket-{b:06d}" for b in touched})
        h, c = held.alias("h"), last.select(*KEYS).alias("c")
        same = [F.col(f"h.{k}").eqNullSafe(F.col(f"c.{k}")) for k in KEYS]
        new = last.where(~F.col("gone"))
        signed = lambda df, sign: df.select(
            "doc_id", "source", "lang", "tokenizer_version", F.lit(sign).cast("long").alias("d_docs"),
            (sign * F.col("n_tokens")).alias("d_tokens"))
        delta = self._written(signed(new, 1).unionByName(signed(h.join(c, same, "left_semi"), -1)))
        kept = h.join(c, same, "left_anti").select("h.*", bucket).unionByName(new.drop("gone"))
        documents = self._written(kept.hint("rebalance", BUCKET), BUCKET)
        sums = spark.read.schema(LEDGER).parquet(f"{self.path}/{delta}").groupBy(*GROUPS).agg(
            F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        totals = self._written(self._read(TOTALS, now, {"totals"}).unionByName(sums).groupBy(*GROUPS)
                               .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                               .where(F.col("n_docs") != 0))
        left = {p: f for p, f in now.folders.items() if p not in {f"bucket-{b:06d}" for b in touched}}
        fresh = {f"bucket-{b:06d}": f"{documents}/{BUCKET}={b}" for b in self._buckets_in(documents)}
        self.states.commit(now, {**left, **fresh, f"batch-{int(batch_id)}": delta, "totals": totals}, **info)
        self.states.vacuum(keep=2)
        return True
