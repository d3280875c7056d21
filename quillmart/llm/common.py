"""Helpers shared by the training-data operators.

Text is handled as Arrow buffers: a batch of documents is one byte array plus
offsets, words are found with table look-ups over those bytes, and every
distinct word of a batch is hashed (or tokenised) once. Nulls count as empty
texts everywhere.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text handled at once in a Python worker.
CHUNK_BYTES = 16 << 20
# Rows per Arrow batch between the JVM and Python: bounds a batch of long texts.
ARROW_ROWS = 512

U64 = np.uint64
WHITESPACE = np.zeros(256, bool)
WHITESPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# An odd multiplier and its inverse modulo 2**64, for positional hashes.
MULT = 0x9E3779B97F4A7C15
MULT_INV = pow(MULT, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of ``sf_dir``; Arrow batches of its rows are kept short."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_number(spark: SparkSession) -> Column:
    """A number for each row of a table read from files, the same for every read of it.

    It follows from a row's file split. Spark sizes splits by the cores it has just
    then unless a least number of splits is set; that is done here (where it is
    unset), so executors that come or go between two reads change nothing.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", "1")  # splits of maxPartitionBytes
    return F.monotonically_increasing_id()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_arrays(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.Table, pa.Array]]:
    """Regroup batches to about ``limit`` bytes of text: (rows, texts without nulls).

    One text longer than the limit is a chunk of its own.
    """
    held, size = [], 0

    def flush():
        rows = pa.Table.from_batches(held)
        texts = pc.fill_null(rows[column], "").combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
        return rows, texts

    for batch in batches:
        at = 0
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit - size, "right")))
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop - 1] - base)
            at = stop
            if size >= limit:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; one offset more than texts."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset: texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[o[0]: o[-1]], (o - o[0]).astype(np.int64)


def pieces(data: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    """The byte array cut at ``offsets`` as an Arrow array, without a copy of the bytes."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts.

    ``codes`` index ``vocabulary`` (distinct words as Arrow binary), ``docs``
    gives the first word of each text (one entry more than texts), ``starts``
    and ``ends`` are byte positions in ``data``.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.data, self.text_offsets = byte_view(texts)
        data, o = (LOWER[self.data] if lower else self.data), self.text_offsets
        white = WHITESPACE[data]
        keep = ~white
        first, last = keep.copy(), keep.copy()
        first[1:] &= white[:-1]
        last[:-1] &= white[1:]
        full = o[:-1] < o[1:]
        first[o[:-1][full]] = keep[o[:-1][full]]
        last[o[1:][full] - 1] = keep[o[1:][full] - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        cut = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        words = pieces(data[keep], cut).dictionary_encode()
        self.codes = words.indices.to_numpy(zero_copy_only=False)
        self.vocabulary = words.dictionary
        self.docs = np.searchsorted(self.starts, o)

    def __len__(self) -> int:
        return len(self.codes)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each word occurrence."""
        both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in self.vocabulary.to_pylist()), ">u8")
        both = both.astype(U64).reshape(-1, 2)
        return both[self.codes, 0], both[self.codes, 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (the last n - 1 positions are left out)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    for j in range(n):
        out *= U64(MULT)
        out += hashes[j: j + m]
    return mix(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), U64)
    done = 1
    while done < n:
        step = U64(pow(base, done, 1 << 64))
        take = min(done, n - done)
        out[done: done + take] = out[:take] * step
        done += take
    return out[:n]


def long_ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Like ``ngrams`` for a large n: prefix sums of powers instead of n passes."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    total = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * powers(MULT, len(hashes)), out=total[1:])
    return mix((total[n:] - total[:-n]) * powers(MULT_INV, m))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All positions start .. start + count - 1, one range after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - first, counts)


def dealt_anew(key: str) -> Column:
    """``key`` (text or whole number) as an expression of its own. An aggregate by ``key`` that selects it
    this way is shuffled for a join like any table; Spark splits the hot keys of a join
    only between two plain shuffles, not next to an aggregate."""
    return F.when(F.col(key).isNotNull(), F.col(key)).alias(key)


def distinct_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
