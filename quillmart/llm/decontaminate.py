"""Benchmark decontamination with SimHash windows.

A document holds an item when some span of it, as many words as the item (the whole
document when that is shorter), has a weighted Jaccard similarity of 5-word shingles of
``SIMILAR`` or more; rare shingles of the benchmark weigh more, and a shingle that the
item lacks weighs as one of no item. Such a span replaces at most a ninth of the item's
weight, and a changed word inside takes five shingles in a row: that bounds the changed
words. An item is cut into one window more than these (three at least, as a short
document may lack both ends), side by side and as long as possible; a window's fingerprint
is the SimHash of all its shingles. So one window is left as it is or has only lost a few
shingles at an end, to a changed word that two windows share. A multi-index finds it: a
fingerprint of 64 bits has four blocks, and two within distance 7 agree in one block up
to a single bit, so each window's blocks and their one-bit neighbours find every
fingerprint within that radius among those of all the document's windows of that size. All
item-sized spans over a window found are then compared exactly. (README: recall by length.)

Shingles are counted once over the whole benchmark, so that no result depends on which
items share a block. The benchmark goes to the tasks in blocks of at most ``ITEM_BLOCK``
items and ``BLOCK_CHARS`` characters, one after the other: a block's matches are written
and its broadcast released before the next is made. Documents are read once for each
block.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` in lower case, of whole texts of any length; an item
with fewer than five words is one shingle and must be found word for word; an
item or document without words matches nothing; null texts are empty; of equally
similar spans the first is given, with the distance of its SimHash to the item's; equal
items are answered each under their own id; equal documents get equal rows; an
empty table on either side gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import U64, Words, dealt_anew, ngrams, ranges, stage, text_arrays
from quillmart.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
SIMILAR = 0.8
REPLACED = (1 - SIMILAR) / (1 + SIMILAR)  # of an item's weight, at most, in a similar span of its size
LEAST_WINDOWS = 3
# Shingles in a window: odd, so that no vote is a tie.
WINDOW_SIZES = np.array([1, 3, 5, 7, 9, 11, 13, 15, 17, 21, 25, 29, 33, 37, 43])
RADIUS = 7          # of four 16-bit blocks one differs in at most 7 // 4 = 1 bit
ITEM_BLOCK = 2000
BLOCK_CHARS = 2 << 20  # of the items of a block, but for a single longer one
TEXT_BYTES = 4 << 20

# Byte -> its eight bits in the eight bytes of a 64-bit value.
LANES = (((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(U64) << (8 * np.arange(8)).astype(U64)).sum(1).astype(U64)
ONES = U64(0x0101010101010101)
GATHER = U64(0x0102040810204080)


def simhashes(shingles: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """For each size m: SimHash of the m shingles from each position, as bytes (positions x 8).

    Eight counters of eight bits share a 64-bit lane; prefix sums wrap around and
    their differences are exact, as a window has at most 255 shingles.
    """
    n = len(shingles)
    out = {m: np.zeros((max(n - m + 1, 0), 8), np.uint8) for m in sizes}
    for j in range(8):
        total = np.zeros(n + 1, U64)
        np.cumsum(LANES[((shingles >> U64(8 * j)) & U64(0xFF)).astype(np.intp)], out=total[1:])
        for m in sizes:
            if n < m:
                continue
            votes = total[m:] - total[:-m]
            votes += ONES * U64(127 - m // 2)  # a lane's top bit: more than half of the shingles
            votes >>= U64(7)
            votes &= ONES
            votes *= GATHER
            votes >>= U64(56)
            out[m][:, j] = votes
    return out


def simhash(shingles: np.ndarray) -> int:
    """SimHash of any number of shingles."""
    bits = np.unpackbits(np.ascontiguousarray(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(0) > len(shingles) // 2, bitorder="little").view(U64)[0])


class Item:
    """A benchmark item: its SimHash, its distinct shingles and how often it has each."""

    def __init__(self, item_id: int, hashes: np.ndarray):
        self.id, self.words = item_id, len(hashes)
        self.unit = min(SHINGLE, self.words)
        self.shingles = ngrams(hashes, self.unit)
        self.print = simhash(self.shingles)
        self.distinct, self.uses = np.unique(self.shingles, return_counts=True)

    def weigh(self, weights: np.ndarray) -> None:
        self.weights = weights
        self.total = float((weights * self.uses).sum())

    def windows(self) -> tuple[int, np.ndarray]:
        """(shingles in a window, fingerprints of the windows)."""
        n = len(self.shingles)
        each = np.concatenate([[0], np.cumsum(self.weights[np.searchsorted(self.distinct, self.shingles)])])
        run = min(SHINGLE, n)
        changed = int(REPLACED * self.total / (each[run:] - each[:-run]).min()) if n > run else 0
        count = min(max(changed + 1, LEAST_WINDOWS), n)
        size = int(WINDOW_SIZES[WINDOW_SIZES <= n // count][-1])
        first = (n - count * size) // 2
        return size, np.array([simhash(self.shingles[first + i * size: first + (i + 1) * size]) for i in range(count)], U64)


class ItemIndex:
    """Multi-index over the probes of one block of items.

    ``uses``: the number of items in the whole benchmark and a function from shingles to
    the number of items that have each; without it, the block is the benchmark.
    """

    def __init__(self, items: list[tuple[int, str]],
                 uses: tuple[int, Callable[[np.ndarray], np.ndarray]] | None = None):
        words = Words(pc.utf8_lower(pa.array([t or "" for _, t in items], pa.string())))
        hashes = words.hashes()[0] if len(words) else np.zeros(0, U64)
        self.items = [Item(i, hashes[a:b]) for (i, _), a, b in zip(items, words.docs[:-1], words.docs[1:]) if b > a]
        own = np.concatenate([np.zeros(0, U64), *(item.distinct for item in self.items)])
        shingles, counts = np.unique(own, return_counts=True)
        n, in_items = (len(self.items), counts) if uses is None else (uses[0], uses[1](shingles))
        weights = np.log(1 + n / in_items)
        self.other = math.log(1 + n)
        found: dict[tuple[int, int], list] = {}
        for k, item in enumerate(self.items):
            item.weigh(weights[np.searchsorted(shingles, item.distinct)])
            size, prints = item.windows()
            found.setdefault((item.unit, size), []).append((k, prints))
        self.probes: dict[int, dict[int, dict]] = {}  # unit -> size of a window -> its tables
        for (unit, size), held in sorted(found.items()):
            self.probes.setdefault(unit, {})[size] = self._blocks(
                np.concatenate([p for _, p in held]), np.repeat([k for k, _ in held], [len(p) for _, p in held]))

    @staticmethod
    def _blocks(prints: np.ndarray, places: np.ndarray) -> dict:
        """For each block: value -> probes whose block is that value or one bit from it."""
        near = np.concatenate([[0], 1 << np.arange(16)]).astype(np.uint16)
        tables = []
        for b in range(4):
            value = ((prints >> U64(16 * b)) & U64(0xFFFF)).astype(np.uint16)
            keys = (value[:, None] ^ near[None, :]).ravel()
            probe = np.repeat(np.arange(len(prints)), len(near))
            order = np.argsort(keys, kind="stable")
            counts = np.bincount(keys, minlength=1 << 16)
            first = np.concatenate([[0], np.cumsum(counts)])
            tables.append((first, probe[order]))
        return {"prints": prints, "places": places, "tables": tables}

    def similarities(self, item: Item, shingles: np.ndarray, size: int) -> np.ndarray:
        """Weighted Jaccard of the item's bag of shingles and that of ``size`` shingles from each position."""
        n = len(shingles) - size + 1
        index = np.minimum(np.searchsorted(item.distinct, shingles), len(item.distinct) - 1)
        own = np.flatnonzero(item.distinct[index] == shingles)
        weights = np.full(len(shingles), self.other)
        weights[own] = item.weights[index[own]]
        # A use counts from the position after the one that many uses before, as the item has.
        order = own[np.argsort(index[own], kind="stable")]
        back = np.arange(len(order)) - item.uses[index[order]]
        same = (back >= 0) & (index[order[back]] == index[order])
        start = np.maximum(np.where(same, order[back] + 1, 0), order - size + 1)
        change = np.zeros(len(shingles) + 1)
        np.add.at(change, start, weights[order])
        np.subtract.at(change, order + 1, weights[order])
        both = np.cumsum(change)[:n]
        total = np.concatenate([[0], np.cumsum(weights)])
        return both / (item.total + total[size:] - total[:-size] - both)

    def search(self, hashes: np.ndarray, docs: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(text, item, similarity, distance, first word) of the best match for each text and item.

        ``hashes``: word hashes of all texts, ``docs``: the first word of each.
        """
        out = []
        item_words = np.array([item.words for item in self.items])
        for unit, probes in self.probes.items():
            shingles = ngrams(hashes, unit)
            prints = simhashes(shingles, [*probes])
            near = [(size, *self._windows(np.ascontiguousarray(prints[size]).view(U64).ravel(), probes[size])) for size in probes]
            windows, k = (np.concatenate([x[i] for x in near]) for i in (1, 2))
            length = np.repeat([unit + size - 1 for size, *_ in near], [len(w) for _, w, _ in near])
            d = np.searchsorted(docs, windows, "right") - 1
            words = item_words[k]
            # first words of the spans that hold the window inside its own document
            low = np.maximum(windows + length - words, docs[d])
            high = np.maximum(np.minimum(windows, docs[d + 1] - words), docs[d])
            whole = windows + length <= docs[d + 1]
            order = np.lexsort((low, k, d))
            order = order[whole[order]]
            held: list = [None, 0, 0]
            for pair, a, b in [*zip(zip(d[order].tolist(), k[order].tolist()), low[order].tolist(), high[order].tolist()),
                               (None, 0, 0)]:
                if pair == held[0] and a <= held[2] + 1:
                    held[2] = max(held[2], b)
                    continue
                if held[0]:
                    out += self._best(*held, shingles, docs)
                held = [pair, a, b]
        best: dict[tuple[int, int], tuple] = {}
        for pair, *match in out:
            if match[0] > best.get(pair, (0,))[0]:
                best[pair] = match
        return [(d, self.items[k].id, *m) for (d, k), m in sorted(best.items())]

    def _best(self, pair, low, high, shingles, docs) -> list[tuple]:
        """The most similar of the spans that start from ``low`` to ``high``, if similar enough."""
        d, item = pair[0], self.items[pair[1]]
        size = min(item.words, int(docs[d + 1] - docs[d])) - item.unit + 1
        found = np.round(self.similarities(item, shingles[low: high + size], size), 9)
        at = int(found.argmax())
        if found[at] < SIMILAR:
            return []
        distance = (simhash(shingles[low + at: low + at + size]) ^ item.print).bit_count()
        return [(pair, float(found[at]), distance, low + at - int(docs[d]))]

    def _windows(self, prints: np.ndarray, probes: dict) -> tuple[np.ndarray, np.ndarray]:
        """Windows and the items of which they are within the radius of a fingerprint."""
        halves = prints.view(np.uint16).reshape(-1, 4)
        pairs = []
        for b, (first, listed) in enumerate(probes["tables"]):
            key = halves[:, b]
            counts = np.diff(first)[key]
            at = np.flatnonzero(counts)
            window = np.repeat(at, counts[at])
            probe = listed[ranges(first[key[at]], counts[at])]
            near = np.bitwise_count(prints[window] ^ probes["prints"][probe]) <= RADIUS
            pairs.append(window[near] * len(self.items) + probes["places"][probe[near]])
        return np.divmod(np.unique(np.concatenate(pairs)), len(self.items))


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks bounded in items and characters, one at a time on the driver."""
    held, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        more = len(r["text"] or "")
        if held and (len(held) == ITEM_BLOCK or size + more > BLOCK_CHARS):
            yield held
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += more
    if held:
        yield held


def item_uses(spark: SparkSession, benchmark: DataFrame) -> tuple[int, Callable[[np.ndarray], np.ndarray]]:
    """The number of items with words, and a function from shingles to the number of items with each.

    Counted over the whole benchmark in one aggregation; only shingles of several items are kept.
    """

    def per_partition(batches):
        for _, texts in text_arrays(batches, limit=TEXT_BYTES):
            words = Words(pc.utf8_lower(texts))
            if not len(words):
                continue
            hashes = words.hashes()[0]
            found = [Item(0, hashes[a:b]).distinct for a, b in zip(words.docs[:-1], words.docs[1:]) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["shingle"])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(found), pa.int64())], names=["shingle"])  # one an item

    counts = stage(spark, benchmark.select("text").mapInArrow(per_partition, "shingle long").groupBy("shingle")
                   .agg(F.count(F.lit(1)).alias("n")).where("shingle IS NULL OR n > 1"), "item-shingles")
    items = counts.where("shingle IS NULL").head()

    def uses(shingles: np.ndarray) -> np.ndarray:
        out = np.ones(len(shingles), np.int64)
        if len(shingles):
            asked = spark.createDataFrame(pa.table({"shingle": shingles.view(np.int64), "at": np.arange(len(shingles))}))
            got = asked.join(counts, "shingle").select("at", "n").toArrow()
            out[got["at"].to_numpy()] = got["n"].to_numpy()
        return out

    return (items["n"] if items else 0), uses


def indexes(spark: SparkSession, benchmark: DataFrame) -> Iterator[ItemIndex]:
    """The multi-index of each block of items. What an item weighs doesn't depend on its block."""
    uses = item_uses(spark, benchmark)
    for block in item_blocks(benchmark):
        yield ItemIndex(block, uses)


def _matches(spark: SparkSession, documents: DataFrame, found: Iterator[ItemIndex], per_index: Callable,
             schema: str) -> DataFrame:
    """The rows that ``per_index`` makes of the documents with each index, written block by block."""
    path = scratch_path(spark, "contamination")
    spark.createDataFrame([], schema).write.parquet(path)
    for index in found:
        shared = spark.sparkContext.broadcast(index)
        documents.mapInArrow(per_index(shared), schema).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(schema).parquet(path)


def contamination(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item whose similarity is ``SIMILAR`` or more, with the best span."""

    def per_index(shared):
        def per_partition(batches):
            index = shared.value
            for rows, texts in text_arrays(batches, limit=TEXT_BYTES):
                words = Words(pc.utf8_lower(texts))
                if not len(words):
                    continue
                found = index.search(words.hashes()[0], words.docs)
                d, i, s, r, w = zip(*found) if found else ((),) * 5
                yield pa.RecordBatch.from_arrays([
                    rows["doc_id"].combine_chunks().take(pa.array(d, pa.int64())), pa.array(i, pa.int64()),
                    pa.array(s, pa.float64()), pa.array(r, pa.int32()), pa.array(w, pa.int32())],
                    names=["doc_id", "item_id", "similarity", "distance", "start_word"])
        return per_partition

    return _matches(spark, documents.select(F.col("doc_id").cast("long"), "text"), indexes(spark, benchmark), per_index,
                    "doc_id long, item_id long, similarity double, distance int, start_word int")


def drop_contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold a benchmark item; all columns stay.

    One block filters the documents as they are read. With more, the 128-bit hashes of the
    texts to drop are written block by block, as equal texts hold equal items.
    """
    found = indexes(spark, benchmark)
    first = [*islice(found, 2)]
    if len(first) < 2:
        for index in first:
            documents = documents.mapInArrow(_clean(spark.sparkContext.broadcast(index)), documents.schema)
        return documents

    def per_index(shared):
        def per_partition(batches):
            index = shared.value
            for rows, texts in text_arrays(batches, limit=TEXT_BYTES):
                held = ~_kept(index, texts)
                yield from rows.filter(pa.array(held)).select(["a", "b"]).to_batches()
        return per_partition

    a, b = F.xxhash64("text"), F.xxhash64(F.lit("b"), "text")
    drop = _matches(spark, documents.select(a.alias("a"), b.alias("b"), "text"), chain(first, found), per_index,
                    "a long, b long").groupBy("a", "b").count().select(dealt_anew("a"), dealt_anew("b"))
    return documents.join(drop, (a == drop["a"]) & (b == drop["b"]), "left_anti")


def _kept(index: ItemIndex, texts: pa.Array) -> np.ndarray:
    """Which texts hold no item."""
    words = Words(pc.utf8_lower(texts))
    keep = np.ones(len(texts), bool)
    if len(words):
        keep[[d for d, *_ in index.search(words.hashes()[0], words.docs)]] = False
    return keep


def _clean(shared):
    def per_partition(batches):
        index = shared.value
        for rows, texts in text_arrays(batches, limit=TEXT_BYTES):
            yield from rows.filter(pa.array(_kept(index, texts))).to_batches()
    return per_partition
