"""Token-id output: a wavelet matrix per shard.

Each document's ids are written once, as bit-planes: plane 0 holds the top bit
of every id in order, each next plane the next bit after a stable partition by
the bit before. With one running count per 512 bits, access, rank (how often an
id occurs before a position) and select (where its k-th occurrence is) need a
few look-ups per plane, on the compressed file alone.

Shards are ranges of ascending document id. A shard's file (Parquet, zstd) has
one row per segment with its planes and document table; a segment ends after
``SEGMENT_IDS`` ids, so a task never holds more than that plus one document.

Defined cases: a null text is an empty one (only the end id); a text of any length is one
document of one segment; equal document
ids keep one entry per row, in any order among themselves; null document ids
come first; an empty table writes no segment and reads back as no rows.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmart.llm.common import byte_view, shuffle_partitions, text_arrays
from quillmart.llm.tokens import ChunkEncoder, largest_id
from quillmart.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_IDS = 4 << 20
BLOCK_BITS = 512
FILE = ("shard int, segment int, n long, zeros array<long>, bits array<binary>, ranks array<binary>, "
        "doc_ids array<long>, doc_sizes array<long>")
# Row groups of about one segment: a reader's task gets few of them.
ROW_GROUP_BYTES = 16 << 20
NO_ID = np.iinfo(np.int64).min


def _bit_sums(bits: np.ndarray) -> np.ndarray:
    """Ones before each block of 512 bits, one entry more than blocks."""
    ones = np.bitwise_count(bits.view(np.uint64)).astype(np.uint32)
    return np.concatenate([[0], np.cumsum(ones.reshape(-1, BLOCK_BITS // 64).sum(axis=1))]).astype(np.uint32)


class WaveletMatrix:
    """Planes of ``n`` ids below 2**levels."""

    def __init__(self, n: int, zeros: list[int], bits: list[np.ndarray], sums: list[np.ndarray]):
        self.n, self.zeros, self.bits, self.sums, self.levels = n, zeros, bits, sums, len(bits)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        ids = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        n, padded = len(ids), -(-len(ids) // BLOCK_BITS) * BLOCK_BITS
        zeros, bits, sums = [], [], []
        for level in range(levels - 1, -1, -1):
            bit = (ids >> level) & 1 != 0
            packed = np.packbits(np.concatenate([bit, np.zeros(padded - n, bool)]), bitorder="little")
            bits.append(packed)
            sums.append(_bit_sums(packed))
            low = ids[~bit]
            zeros.append(len(low))
            ids = np.concatenate([low, ids[bit]])
        return cls(n, zeros, bits, sums)

    def _plane(self, level: int) -> np.ndarray:
        return np.unpackbits(self.bits[level], count=self.n, bitorder="little").view(bool)

    def all(self) -> np.ndarray:
        """Every id in order: the partitions are undone from the last plane up."""
        ids = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bit, before = self._plane(level), ids
            ids = np.empty_like(before)
            ids[~bit] = before[: self.zeros[level]]
            ids[bit] = before[self.zeros[level]:] | ids.dtype.type(1 << (self.levels - 1 - level))
        return ids

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        at = np.asarray(at, np.int64)
        block = at // BLOCK_BITS
        total = self.sums[level][block].astype(np.int64)
        words = self.bits[level].view(np.uint64)
        for k in range(BLOCK_BITS // 64):
            word = block * (BLOCK_BITS // 64) + k
            left = np.clip(at - word * 64, 0, 64)
            value = words[np.minimum(word, max(len(words) - 1, 0))] if len(words) else np.zeros(at.shape, np.uint64)
            mask = np.where(left == 64, np.uint64(0xFFFFFFFFFFFFFFFF),
                            (np.uint64(1) << np.minimum(left, 63).astype(np.uint64)) - np.uint64(1))
            total += np.bitwise_count(value & mask).astype(np.int64)
        return total

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.bits[level][at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0

    def access(self, at) -> np.ndarray:
        """The ids at positions ``at``."""
        at = np.asarray(at, np.int64)
        out = np.zeros(at.shape, np.uint32)
        for level in range(self.levels):
            bit, ones = self._bit(level, at), self._ones(level, at)
            out = (out << np.uint32(1)) | bit
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return out

    def _run(self, value: int) -> tuple[int, list[int]]:
        """Where ``value`` starts after the last plane, and the range's start in each plane."""
        start, starts = 0, []
        for level in range(self.levels):
            starts.append(start)
            ones = int(self._ones(level, np.array([start]))[0])
            one = value >> (self.levels - 1 - level) & 1
            start = self.zeros[level] + ones if one else start - ones
        return start, starts

    def rank(self, value: int, stop: int) -> int:
        """How often ``value`` occurs before position ``stop``."""
        if not 0 <= value < 1 << self.levels:
            return 0
        at = np.array([min(max(stop, 0), self.n)])
        for level in range(self.levels):
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if value >> (self.levels - 1 - level) & 1 else at - ones
        return int(at[0]) - self._run(value)[0]

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _select_bit(self, level: int, one: bool, k: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        blocks = self.sums[level].astype(np.int64)
        before = blocks if one else np.arange(len(blocks)) * BLOCK_BITS - blocks
        block = int(np.searchsorted(before, k, "right")) - 1
        part = np.unpackbits(self.bits[level][block * BLOCK_BITS // 8: (block + 1) * BLOCK_BITS // 8],
                             bitorder="little").view(bool)
        return block * BLOCK_BITS + int(np.flatnonzero(part == one)[k - before[block]])

    def select(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``value``, -1 if there are fewer."""
        if k < 0 or k >= self.count(value):
            return -1
        at = self._run(value)[0] + k
        for level in range(self.levels - 1, -1, -1):
            one = bool(value >> (self.levels - 1 - level) & 1)
            at = self._select_bit(level, one, at - self.zeros[level] if one else at)
        return at

    def occurrences(self, value: int) -> np.ndarray:
        return np.array([self.select(value, k) for k in range(self.count(value))], np.int64)


def _segment_row(shard: int, segment: int, ids: np.ndarray, doc_ids: pa.Array, sizes: np.ndarray,
                 levels: int) -> pa.RecordBatch:
    m = WaveletMatrix.build(ids, levels)
    one = np.array([0, len(sizes)], np.int32)
    longs, blobs = pa.list_(pa.int64()), pa.list_(pa.binary())
    return pa.RecordBatch.from_arrays([
        pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([m.n], pa.int64()),
        pa.array([m.zeros], longs), pa.array([[b.tobytes() for b in m.bits]], blobs),
        pa.array([[r.tobytes() for r in m.sums]], blobs), pa.ListArray.from_arrays(one, doc_ids), pa.ListArray.from_arrays(one, pa.array(sizes, pa.int64())),
    ], names=["shard", "segment", "n", "zeros", "bits", "ranks", "doc_ids", "doc_sizes"])


def read_matrix(row: dict) -> WaveletMatrix:
    """The wavelet matrix in one row of a file."""
    return WaveletMatrix(row["n"], row["zeros"], [np.frombuffer(b, np.uint8) for b in row["bits"]],
                         [np.frombuffer(r, np.uint32) for r in row["ranks"]])


def write_token_files(spark: SparkSession, documents: DataFrame, json_text: str, end_id: int, path: str,
                      shards: int | None = None, lower: bool = False) -> None:
    """Encode whole texts and write one wavelet-matrix file per shard under ``path``; as many
    planes as the vocabulary's largest id (or ``end_id``) has bits.

    Shards are equal parts of the documents by id (from the id column alone);
    only ids are shuffled, two or four bytes each.
    """
    shards = shards or max(1, shuffle_partitions(spark))
    cuts = documents.agg(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)] or [0.5],
                                             100 * shards).alias("c")).head()["c"] or []
    cuts = sorted(set(cuts)) if shards > 1 else []
    levels = max(end_id, largest_id(json_text)).bit_length()
    width = np.uint16 if levels <= 16 else np.uint32
    shared = spark.sparkContext.broadcast((json_text, cuts))  # one vocabulary and a cut per shard

    def encode(batches):
        json_text, cuts = shared.value
        encoder = ChunkEncoder(json_text, keeps_space=False, lower=lower)
        for rows, texts in text_arrays(batches):
            ids, first = encoder.encode(texts, end=end_id)
            data = ids.astype(width).view(np.uint8)
            blobs = pa.BinaryArray.from_buffers(pa.binary(), rows.num_rows, [
                None, pa.py_buffer((first * width().itemsize).astype(np.int32)), pa.py_buffer(data)])
            own = rows["doc_id"].combine_chunks()
            shard = np.searchsorted(np.array(cuts, np.int64), own.fill_null(NO_ID).to_numpy(), "left")
            yield pa.RecordBatch.from_arrays([own, pa.array(shard, pa.int32()), blobs], names=["doc_id", "shard", "ids"])

    def build(batches):
        shard, segment, total = None, 0, 0
        ids, docs, sizes = [], [], []  # slices of batches, until a segment is full

        def row():
            return _segment_row(shard, segment, np.concatenate(ids), pa.concat_arrays(docs), np.concatenate(sizes), levels)

        for batch in batches:
            raw, first = byte_view(batch.column("ids"))
            data, first = np.frombuffer(raw.tobytes(), width), first // width().itemsize
            shards = batch.column("shard").to_numpy()
            at = 0
            while at < batch.num_rows:
                if shards[at] != shard or total >= SEGMENT_IDS:
                    if docs:
                        yield row()
                    segment = segment + 1 if shards[at] == shard else 0
                    shard, total, ids, docs, sizes = int(shards[at]), 0, [], [], []
                # up to the shard's last row here, and no further than the document that fills the segment
                stop = int(np.searchsorted(shards, shard, "right"))
                stop = min(stop, int(np.searchsorted(first, first[at] + SEGMENT_IDS - total, "left")))
                ids.append(data[first[at]: first[stop]])
                docs.append(batch.column("doc_id").slice(at, stop - at))
                sizes.append(np.diff(first[at: stop + 1]))
                total += len(ids[-1])
                at = stop
        if docs:
            yield row()

    encoded = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "doc_id long, shard int, ids binary")
    (encoded.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first())
     .mapInArrow(build, FILE).write.option("compression", "zstd")
     .option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path))


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document from the files, in ascending order of documents: doc_id, start (ids of all
    documents before it), n_tokens and its ids as little-endian unsigned 32-bit integers
    (with ``digest`` their crc32 instead)."""
    files = spark.read.schema(FILE).parquet(path)
    order = Window.orderBy("shard", "segment")  # one row per segment of 4M ids
    first = files.select("shard", "segment", (F.sum("n").over(order) - F.col("n")).alias("first"))

    def decode(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).select(["shard", "segment", "n", "zeros", "bits", "ranks"]).to_pylist()[0]
                sizes = batch.column("doc_sizes")[k].values.to_numpy()
                data = memoryview(read_matrix(row).all().astype("<u4").view(np.uint8))
                ends = np.cumsum(sizes)
                n, blobs = len(sizes), [data[4 * (b - s): 4 * b] for s, b in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()),
                    batch.column("doc_ids")[k].values, pa.array(ends - sizes), pa.array(sizes),
                    pa.array([zlib.crc32(b) for b in blobs], pa.int64()) if digest
                    else pa.array([b.tobytes() for b in blobs], pa.binary()),
                ], names=["shard", "segment", "doc_id", "local", "n_tokens", value])

    value, kind = ("ids_crc32", "long") if digest else ("ids", "binary")
    docs = files.mapInArrow(decode, f"shard int, segment int, doc_id long, local long, n_tokens long, {value} {kind}")
    return (docs.join(first, ["shard", "segment"])
            .select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", value))


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Occurrences of one id in the files: (shard, segment, n_found, positions in the segment)."""

    def look(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                found = read_matrix(row).occurrences(token)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]], pa.int32()), pa.array([row["segment"]], pa.int32()),
                    pa.array([len(found)], pa.int64()), pa.array([found], pa.list_(pa.int64()))],
                    names=["shard", "segment", "n_found", "positions"])

    return spark.read.schema(FILE).parquet(path).mapInArrow(
        look, "shard int, segment int, n_found long, positions array<long>")


def token_files(spark: SparkSession, documents: DataFrame, json_text: str, end_id: int, path: str | None = None,
                digest: bool = False, **options) -> DataFrame:
    """Write the files (to the shared checkpoint folder unless ``path`` is given) and read them back."""
    path = path or scratch_path(spark, "token-files")
    write_token_files(spark, documents, json_text, end_id, path, **options)
    return read_token_files(spark, path, digest)
