"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file gives the vocabulary: each rank's bytes are written in the
byte-to-character mapping, and every way to put a token together from two
others becomes a merge with that token's priority. Encoding runs over Arrow
batches; decoding reverses the byte table, so characters split over several
tokens come back whole, also when the ids arrive in parts.

Defined cases: a null text encodes as an empty one (no ids) and decodes to an
empty text; empty tables give empty results; equal rows give equal results;
columns of the input that clash with the result's are replaced.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.llm.common import text_arrays
from quillmart.llm.tokens import ChunkEncoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, else the next free one from U+0100."""
    shown = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    out, spare = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 and rank. The file's size is that of one vocabulary."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """The library's JSON for a rank vocabulary split by ``pattern``.

    Every split of a token into two known tokens is a merge; all merges of one
    token stand together, so the library's order is the order of ranks.
    """
    chars = byte_characters()

    def shown(token: bytes) -> str:
        return "".join(chars[b] for b in token)

    merges = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [(token[:i], token[i:]) for i in range(1, len(token))]
        known = [(ranks[a], ranks[b], a, b) for a, b in parts if a in ranks and b in ranks]
        merges += [[shown(a), shown(b)] for _, _, a, b in sorted(known)]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
        "post_processor": None, "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False,
                                            "use_regex": False},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                  "vocab": {shown(t): r for t, r in ranks.items()}, "merges": merges}})


def byte_table(ranks: dict[bytes, int]) -> list[bytes]:
    """Rank -> bytes; ranks without a token give no bytes."""
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


class StreamDecoder:
    """Decodes ids that arrive in parts; an unfinished character waits for the next part."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.rest = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids, final: bool = False) -> str:
        return self.rest.decode(b"".join(map(self.table.__getitem__, ids)), final)


class ByteBPE:
    """The operator: one vocabulary, applied to whole columns of texts or ids."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str):
        # One vocabulary: a few MB whatever the data's size.
        self.shared = spark.sparkContext.broadcast((tokenizer_json(ranks, pattern), byte_table(ranks)))

    def encode(self, df: DataFrame, text_col: str = "text", offsets: bool = False) -> DataFrame:
        """``df`` with ``ids`` (array of int) and, with ``offsets``, ``starts`` and
        ``stops`` (code points of the text that each token covers)."""
        new = ["ids"] + ["starts", "stops"] * offsets
        kept = df.drop(*new)
        schema = kept.schema
        for c in new:
            schema = T.StructType([*schema, T.StructField(c, T.ArrayType(T.IntegerType()))])
        shared = self.shared

        def per_partition(batches):
            encoder = ChunkEncoder(shared.value[0], keeps_space=True)
            for rows, texts in text_arrays(batches, text_col, 4 << 20 if offsets else 16 << 20):
                if offsets:
                    done = encoder.encode_with_offsets(texts)
                    arrays = [pa.array([d[k] for d in done], pa.list_(pa.int32())) for k in range(3)]
                else:
                    ids, first = encoder.encode(texts)
                    arrays = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))]
                for name, a in zip(new, arrays):
                    rows = rows.append_column(name, a)
                yield from rows.to_batches()

        return kept.mapInArrow(per_partition, schema)

    def decode(self, df: DataFrame, ids_col: str = "ids") -> DataFrame:
        """``df`` with ``decoded`` (binary: the exact bytes) and ``decoded_text``
        (those bytes as text, with U+FFFD where ids end inside a character)."""
        kept = df.drop("decoded", "decoded_text")
        schema = T.StructType([*kept.schema, T.StructField("decoded", T.BinaryType()),
                               T.StructField("decoded_text", T.StringType())])
        shared = self.shared

        def per_partition(batches):
            table = shared.value[1]
            for batch in batches:
                data = [b"".join(map(table.__getitem__, ids or ())) for ids in batch.column(ids_col).to_pylist()]
                rows = pa.Table.from_batches([batch]).append_column("decoded", pa.array(data, pa.binary()))
                rows = rows.append_column("decoded_text", pa.array(
                    [d.decode("utf-8", "replace") for d in data], pa.string()))
                yield from rows.to_batches()

        return kept.mapInArrow(per_partition, schema)


def id_digest(df: DataFrame, spark: SparkSession, ranks: dict[bytes, int], pattern: str,
              text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: number of ids, digest of the ids, digest of what they decode to (and the ids).

    Encoding and decoding share a task, so the ids of a text never leave it.
    """
    shared = ByteBPE(spark, ranks, pattern).shared

    def per_partition(batches):
        table = shared.value[1]
        encoder = ChunkEncoder(shared.value[0], keeps_space=True)
        decimal = [b"%d" % i for i in range(len(table))]
        for rows, texts in text_arrays(batches, text_col, 4 << 20):
            ids, first = encoder.encode(texts)
            sizes, shown, back = [], [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own = ids[a:b].tolist()
                sizes.append(b - a)
                shown.append(hashlib.sha256(b",".join(map(decimal.__getitem__, own))).hexdigest())
                back.append(hashlib.sha256(b"".join(map(table.__getitem__, own))).hexdigest())
            arrays = [rows["doc_id"].combine_chunks(), pa.array(sizes, pa.int64()), pa.array(shown, pa.string()),
                      pa.array(back, pa.string())]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(arrays)])

    return df.select(F.col("doc_id").cast("long"), F.col(text_col)).mapInArrow(
        per_partition, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + (", ids array<int>" if with_ids else ""))
