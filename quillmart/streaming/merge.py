"""Keyed merge of increments into a table, latest row wins.

The target's rows lie in buckets of their key's hash. A micro-batch touches the buckets of its
own keys only: those are read, merged with the batch and written to a new folder, and
one commit (``sources.versions``) names the new folders of the touched buckets and the
old ones of all others. The commit also holds the batch id, so a batch that is delivered
again after a crash changes nothing, and one that died before its commit starts anew.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.operators.reports import dedupe_latest
from quillmart.session import release_shuffles
from quillmart.sources.versions import State, VersionedTable

BUCKET = "_bucket"
PART_ROWS = 50_000_000  # rows that a merge brings together at once


class KeyedTable(VersionedTable):
    """One row per key: the latest by ``order`` (of equal ones the largest row)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], buckets: int = 64):
        super().__init__(spark, path)
        self.keys, self.order, self.buckets = keys, order, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _parts(self, now: State, new: dict[int, int]) -> list[list[int]]:
        """The touched buckets in parts of at most ``PART_ROWS`` rows (or one bucket), held ones included."""
        held = self.read(now)
        each = held.count() / self.buckets if held is not None else 0  # from footers; buckets are about equal
        parts, size = [[]], 0
        for bucket, n in sorted(new.items()):
            if parts[-1] and size + n + each > PART_ROWS:
                parts.append([])
                size = 0
            parts[-1].append(bucket)
            size += n + each
        return parts

    def merge(self, batch: DataFrame, batch_id: int | None = None) -> list[int]:
        """Merge ``batch``; the buckets written (none for a batch that is empty or merged before).

        The batch is read again, first its keys and then its rows, so it must give the same rows each time.
        Buckets are merged in parts of about ``PART_ROWS`` rows, so that only these are in motion.
        """
        now = self.current()
        if batch_id is not None and now.info.get("batch_id", -1) >= batch_id:
            return []
        new = {r[0]: r[1] for r in batch.groupBy(self.bucket().alias(BUCKET)).count().collect()}  # buckets at most
        touched = sorted(new)
        if touched:
            merged = self.new_folder()
            for part in self._parts(now, new):
                held = self.read(now, {str(b) for b in part})
                rows = batch.withColumn(BUCKET, self.bucket())
                rows = rows if len(part) == len(touched) else rows.where(F.col(BUCKET).isin(part))
                both = rows if held is None else rows.unionByName(held.withColumn(BUCKET, self.bucket()))
                # Rows are written where the dedupe has put them: they move once.
                (dedupe_latest(both, [BUCKET, *self.keys], self.order)
                 .write.mode("append").option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.path}/{merged}"))
                release_shuffles(self.spark)
            found = [s.getPath().getName().split("=")[1] for s in self.fs.listStatus(self._new(f"{self.path}/{merged}")) if s.isDirectory()]
            if sorted(map(int, found)) != touched:
                raise RuntimeError(f"the batch gave other rows when it was read again: buckets {touched}, then {found}")
            folders = now.folders | {str(b): f"{merged}/{BUCKET}={b}" for b in touched}
            schema = now.schema or batch.schema.json()
            if T.StructType.fromJson(json.loads(schema)).names != batch.columns:
                raise ValueError(f"columns {batch.columns} differ from the table's")
            self.commit(now, folders, schema, batch_id=now.info.get("batch_id", -1) if batch_id is None else batch_id)
        return touched


def merge_stream(table: KeyedTable, source_dir: str, checkpoint: str, schema: T.StructType) -> State:
    """Merge every Parquet drop under ``source_dir`` that ``checkpoint`` has not recorded yet, then stop."""
    query = (table.spark.readStream.schema(schema).parquet(source_dir).writeStream
             .foreachBatch(lambda batch, number: table.merge(batch, number) and None)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return table.current()
