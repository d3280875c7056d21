"""Substring dedup with difference-cover anchors.

A window is ``WINDOW`` consecutive words. Positions of a document are sampled at
a difference cover modulo ``PERIOD``: for any two positions there is a shift
below the period that takes both into the cover. So two equal windows anywhere
in the corpus share an anchor, a sampled run of WINDOW - PERIOD + 1 words, at the
same place inside them. Anchors that occur once are dropped; around the others
the match is extended: every window that holds the anchor is hashed (96 bits), and those
whose hash occurs again anywhere are repeats. Their words are removed.

Counting goes through shuffles of packed hashes. A task first combines its own:
of a hash that it has several times one witness is sent, so a passage in a third
of all rows arrives once per task. Answers return to the task's chunk of
documents. The text moves once, and only of documents with a repeated anchor,
into a bucketed table; later steps read it where it lies.

Defined cases: a null text has no words; documents under ``WINDOW`` words lose
nothing; equal rows are occurrences of each other; null and repeated ids are
kept as they are, one result per row; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import (
    U64, Words, long_ngrams, mix, ngrams, row_number, shuffle_partitions, stage, text_arrays)
from quillmart.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 35
PERIOD = 21
COVER = np.array([3, 6, 7, 12, 14])  # every difference modulo 21 is one of two of these
ANCHOR = WINDOW - PERIOD + 1
TEXT_BYTES = 10 << 20  # of text handled at once in a task
KEYS_SENT = 1_000_000  # row keys (8 bytes each) that are broadcast at most

PACKED = "chunk long, bucket int, payload binary"
ENTRY = np.dtype([("high", "<u8"), ("low", "<u4"), ("doc", "<i4"), ("at", "<i4")])
LIGHT = np.dtype([("low", "<u4"), ("doc", "<i4"), ("at", "<i4")])
PLACE = np.dtype([("doc", "<i4"), ("at", "<i4")])
NOWHERE = -1  # the place of a witness: its own places are known to be repeated

Hasher = Callable[[pa.Table, pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _pack(chunk: int, bucket: int, data: np.ndarray) -> tuple[int, int, bytes]:
    return chunk, bucket, data.tobytes()


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    c, b, p = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(b, pa.int32()), pa.array(p, pa.binary())],
                                      names=["chunk", "bucket", "payload"])


def repeated_places(rows: DataFrame, hashed: Hasher, buckets: int, exact: bool) -> DataFrame:
    """(row, places): for each row of ``rows`` (row: a unique long, text, ...) the places whose
    hash occurs at least twice over all rows, as little-endian 32-bit integers.

    ``hashed(table, texts)`` gives text number, place, first and second 64-bit
    hash of every candidate. Without ``exact`` about 32 bits and the bucket
    count (a filter: a few more places may come back); with it, 96 bits.
    """
    kind = ENTRY if exact else LIGHT

    def combine(batches):
        for table, texts in text_arrays(batches, limit=TEXT_BYTES):
            doc, at, high, low = hashed(table, texts)
            keys = table["row"].to_numpy()
            chunk = int(keys[0])
            order = np.argsort(high, kind="stable")
            ordered = high[order]
            new = np.ones(len(ordered), bool)
            new[1:] = ordered[1:] != ordered[:-1]
            first = np.flatnonzero(new)
            several = np.diff(np.append(first, len(ordered))) > 1
            again = np.repeat(several, np.diff(np.append(first, len(ordered))))
            known = np.zeros(int(again.sum()), PLACE)
            known["doc"], known["at"] = doc[order[again]], at[order[again]]
            sent = np.zeros(len(first), kind)
            lead = order[first]
            if exact:
                sent["high"] = high[lead]
            sent["low"] = (low[lead] if exact else high[lead] >> U64(32)) & U64(0xFFFFFFFF)
            sent["doc"] = doc[lead]
            sent["at"] = np.where(several, NOWHERE, at[lead])
            bucket = (high[lead] & U64(0xFFFFFFFF)) % U64(buckets)
            by_bucket = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1, dtype=U64))
            sent = sent[by_bucket]
            out = [_pack(chunk, b, sent[a:z]) for b, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])) if z > a]
            # the chunk's own keys and known places travel with the hashes to the same step
            home = chunk % buckets
            yield _batch(out + [_pack(chunk, -2 - 2 * home, keys), _pack(chunk, -3 - 2 * home, known)])

    def count(batches):
        chunks, parts = [], []
        for batch in batches:
            for c, b, p in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if b < 0:
                    yield _batch([(c, -2 + b % 2, p)])
                else:
                    chunks.append(c)
                    parts.append(np.frombuffer(p, kind))
        if not parts:
            return
        entries = np.concatenate(parts)
        source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        del parts
        if exact:  # an order in which equal hashes stand together
            order = np.lexsort((entries["low"], entries["high"]))
            same = ((entries["high"][order[1:]] == entries["high"][order[:-1]])
                    & (entries["low"][order[1:]] == entries["low"][order[:-1]]))
        else:
            order = np.argsort(entries["low"], kind="stable")
            same = entries["low"][order[1:]] == entries["low"][order[:-1]]
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        hit = order[again]
        hit = hit[entries["at"][hit] != NOWHERE]
        hit = hit[np.argsort(source[hit], kind="stable")]
        place = np.zeros(len(hit), PLACE)
        place["doc"], place["at"] = entries["doc"][hit], entries["at"][hit]
        cuts = np.searchsorted(source[hit], np.arange(len(chunks) + 1))
        out = [_pack(c, -1, place[a:z]) for c, a, z in zip(chunks, cuts[:-1], cuts[1:]) if z > a]
        if out:
            yield _batch(out)

    def home(key, table):
        keys, parts = np.zeros(0, np.int64), []
        for b, p in zip(table["bucket"].to_pylist(), table["payload"].to_pylist()):
            if b == -2:
                keys = np.frombuffer(p, np.int64)
            else:
                parts.append(np.frombuffer(p, PLACE))
        places = np.concatenate(parts) if parts else np.zeros(0, PLACE)
        places = places[np.lexsort((places["at"], places["doc"]))]
        cuts = np.searchsorted(places["doc"], np.arange(len(keys) + 1))
        full = np.flatnonzero(np.diff(cuts))
        blobs = [np.ascontiguousarray(places["at"][cuts[i]: cuts[i + 1]]).tobytes() for i in full]
        return pa.table({"row": pa.array(keys[full], pa.int64()), "places": pa.array(blobs, pa.binary())})

    packed = rows.mapInArrow(combine, PACKED)
    where = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.floor((-2 - F.col("bucket")) / 2))
    counted = packed.repartitionById(buckets, where.cast("int")).mapInArrow(count, PACKED)
    return counted.groupBy("chunk").applyInArrow(home, "row long, places binary")


def anchors(table: pa.Table, texts: pa.Array):
    """The sampled runs of ANCHOR words of each text."""
    words = Words(texts)
    if len(words) < ANCHOR:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(U64), none.astype(U64)
    counts = np.diff(words.docs)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(words)) - words.docs[doc]
    runs = ngrams(words.hashes()[0], ANCHOR)
    doc, at = doc[: len(runs)], at[: len(runs)]
    pick = np.flatnonzero(np.isin(at % PERIOD, COVER) & (at + ANCHOR <= counts[doc]) & (counts[doc] >= WINDOW))
    return doc[pick], at[pick], runs[pick], runs[pick]


def windows(table: pa.Table, texts: pa.Array):
    """The windows that hold one of the repeated anchors in column ``places``."""
    words = Words(texts)
    counts = np.diff(words.docs)
    marks = np.zeros(len(words) + 1, np.int32)
    for d, blob in enumerate(table["places"].to_pylist()):
        at = np.frombuffer(blob, "<i4").astype(np.int64)
        first = np.maximum(at - (PERIOD - 1), 0)
        last = np.minimum(at, counts[d] - WINDOW)
        first, last = first[last >= first], last[last >= first]
        np.add.at(marks, words.docs[d] + first, 1)
        np.add.at(marks, words.docs[d] + last + 1, -1)
    start = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
    doc = np.searchsorted(words.docs, start, "right") - 1
    one, two = words.hashes()
    return doc, start - words.docs[doc], long_ngrams(one, WINDOW)[start], mix(long_ngrams(two, WINDOW)[start])


def _joined(words: Words, keep: np.ndarray | None, d: int, data: bytes) -> bytes:
    a, b = words.docs[d], words.docs[d + 1]
    at = np.arange(a, b) if keep is None else a + np.flatnonzero(keep[a:b])
    return b" ".join([data[s:e] for s, e in zip(words.starts[at].tolist(), words.ends[at].tolist())])


def _whole(batches):
    """Per row: number of words and digest of all words."""
    for table, texts in text_arrays(batches, limit=4 << 20):
        words = Words(texts)
        data = words.data.tobytes()
        n = table.num_rows
        yield pa.RecordBatch.from_arrays([
            table["row"].combine_chunks(), table["doc_id"].combine_chunks(), pa.array(np.diff(words.docs), pa.int64()),
            pa.array([hashlib.sha256(_joined(words, None, d, data)).hexdigest() for d in range(n)], pa.string())],
            names=["row", "doc_id", "n_words", "all_sha256"])


def removal(table: pa.Table, words: Words) -> np.ndarray:
    """Which words stay, given each text's repeated window starts in column ``places``."""
    marks = np.zeros(len(words) + 1, np.int32)
    blobs = table["places"].to_pylist()
    counts = [len(b) // 4 for b in blobs]
    at = np.frombuffer(b"".join(blobs), "<i4").astype(np.int64) + np.repeat(words.docs[:-1], counts)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + WINDOW, -1)
    return np.cumsum(marks[:-1]) == 0


def _rest(batches):
    """Per row with repeats: words removed and digest of the words kept."""
    for table, texts in text_arrays(batches, limit=4 << 20):
        words = Words(texts)
        keep = removal(table, words)
        data = words.data.tobytes()
        removed = [int((~keep[a:b]).sum()) for a, b in zip(words.docs[:-1], words.docs[1:])]
        yield pa.RecordBatch.from_arrays([
            table["row"].combine_chunks(), pa.array(removed, pa.int64()),
            pa.array([hashlib.sha256(_joined(words, keep, d, data)).hexdigest() for d in range(table.num_rows)])],
            names=["row", "n_removed", "kept_sha256"])


def _rest_text(batches):
    """Per row with repeats: the kept words joined by one space."""
    for table, texts in text_arrays(batches, limit=4 << 20):
        words = Words(texts)
        keep = removal(table, words)
        data = words.data.tobytes()
        yield pa.RecordBatch.from_arrays([
            table["row"].combine_chunks(),
            pa.array([_joined(words, keep, d, data).decode() for d in range(table.num_rows)], pa.string())],
            names=["row", "kept"])


def numbered(documents: DataFrame) -> DataFrame:
    """(row, doc_id, text): the same number for a row whenever the table is read."""
    return documents.select(row_number(documents.sparkSession).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                            "text")


def _only(spark: SparkSession, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose number is in ``keys`` (unique). Few keys (checked) are sent to the readers, so that
    other rows aren't shuffled; else both sides are."""
    few = keys.limit(KEYS_SENT + 1).count() <= KEYS_SENT
    return rows.join(F.broadcast(keys) if few else keys, "row", "left_semi")


def repeats(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(row, text, places): rows that hold repeated windows, with the starts of these, in words."""
    buckets = shuffle_partitions(spark)
    rows = numbered(documents).select("row", "text")
    anchored = stage(spark, repeated_places(rows, anchors, buckets, exact=False), "anchors")
    texts = _only(spark, rows, anchored.select("row"))
    name = f"anchored_{uuid.uuid4().hex}"
    (texts.join(anchored.hint("shuffle_merge"), "row").repartition(buckets, "row").write.bucketBy(buckets, "row")
     .option("path", scratch_path(spark, "anchored")).saveAsTable(name))
    held = spark.table(name)
    found = stage(spark, repeated_places(held, windows, buckets, exact=True), "windows")
    return held.select("row", "text").join(found.hint("shuffle_merge"), "row")


def substring_dedup(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per row: words, words removed, digest of the kept words."""
    rest = repeats(spark, documents).mapInArrow(_rest, "row long, n_removed long, kept_sha256 string")
    whole = numbered(documents).mapInArrow(_whole, "row long, doc_id long, n_words long, all_sha256 string")
    return whole.join(rest, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))


def dedup_texts(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, kept): each row's text without the words of repeated windows; rows without any are unchanged."""
    rest = repeats(spark, documents).mapInArrow(_rest_text, "row long, kept string")
    return numbered(documents).join(rest, "row", "left").select("doc_id", F.coalesce("kept", "text").alias("kept"))
