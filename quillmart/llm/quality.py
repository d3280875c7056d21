"""Quality: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover it from start to
end. Each byte has a learned vector; learned filters slide over every chunk, and
each filter's largest response in a chunk is kept. The largest and the mean of these over all
chunks of a text go through one logistic unit to a probability.

Learning: Adam over minibatches on the driver, with a bounded sample
(``SAMPLE_ROWS`` texts of at most ``SAMPLE_CHARS`` characters, read whole). The
network is a few kB and is sent with the tasks. Scoring is one pass over the
documents, without a shuffle; a long text is taken in blocks of chunks, so its
length does not matter for memory.

Defined cases: a null or empty text is one chunk of padding; equal rows get
equal scores; without labels of both kinds every score is the share of label 1
in the sample (0.5 without labels); an empty table gives an empty result.
Labels, language, source and id are never inputs.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import byte_view, text_arrays
from quillmart.llm.labelled import fold, training_sample

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 3000
SAMPLE_CHARS = 8000
THRESHOLD = 0.3
CHUNK, HOP = 256, 240      # bytes of a chunk, and between the starts of two
WIDTH, STRIDE = 8, 2       # bytes under a filter, and between its places
DIM, FILTERS = 6, 16
EPOCHS, BATCH, RATE = 6, 32, 0.01
BLOCK = 512                # chunks computed at once


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK bytes with 0 for padding, first chunk of each text). Every byte is in a chunk."""
    sizes = np.diff(offsets)
    counts = 1 + np.maximum(0, -(-(sizes - CHUNK) // HOP))
    first = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(sizes)), counts)
    start = offsets[:-1][doc] + (np.arange(first[-1]) - first[:-1][doc]) * HOP
    at = start[:, None] + np.arange(CHUNK)
    inside = at < offsets[1:][doc][:, None]
    out = np.zeros(at.shape, np.uint8)
    if len(data):
        out = np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
    return out, first


class Network:
    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {
            "byte": (r.normal(size=(256, DIM)) * 0.5).astype(np.float32),
            "filter": (r.normal(size=(WIDTH * DIM, FILTERS)) / math.sqrt(WIDTH * DIM)).astype(np.float32),
            "shift": np.zeros(FILTERS, np.float32),
            "out": (r.normal(size=2 * FILTERS) * 0.1).astype(np.float32),
            "bias": np.zeros(1, np.float32),
        }

    def pooled(self, chunks: np.ndarray, where: bool = False):
        """Largest response of each filter in each chunk (and its place)."""
        places = (CHUNK - WIDTH) // STRIDE + 1
        best = np.empty((len(chunks), FILTERS), np.float32)
        at = np.empty((len(chunks), FILTERS), np.int32) if where else None
        for a in range(0, len(chunks), BLOCK):
            part = chunks[a: a + BLOCK]
            n = len(part)
            x = self.p["byte"][part].reshape(len(part), CHUNK * DIM)
            seen = np.lib.stride_tricks.as_strided(
                x, (len(part), places, WIDTH * DIM), (x.strides[0], STRIDE * DIM * 4, 4))
            # one product for each chunk: rounding depends on a product's shape, and so equal chunks agree
            y = np.matmul(np.ascontiguousarray(seen), self.p["filter"])
            if where:
                at[a: a + n] = y.argmax(axis=1)[:n]
            best[a: a + n] = y.max(axis=1)[:n]
        best += self.p["shift"]
        return (best, at) if where else best

    def combine(self, best: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of each text from its chunks: ReLU, then the largest and the mean."""
        r = np.maximum(best, 0)
        top = np.maximum.reduceat(r, first[:-1])
        mean = np.add.reduceat(r, first[:-1]) / np.diff(first)[:, None]
        h = np.concatenate([top, mean], axis=1)
        return h, r, top

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability for each text."""
        if len(offsets) < 2:
            return np.zeros(0)
        chunks, first = cut(data, offsets)
        h, _, _ = self.combine(self.pooled(chunks), first)
        return 1 / (1 + np.exp(-np.clip(self.logit(h), -35, 35).astype(np.float64)))

    def logit(self, h: np.ndarray) -> np.ndarray:
        return (h * self.p["out"]).sum(axis=1) + self.p["bias"][0]  # by row: equal rows, equal sums

    def gradients(self, data: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss; only the places that won a maximum carry any."""
        chunks, first = cut(data, offsets)
        best, at = self.pooled(chunks, where=True)
        h, r, top = self.combine(best, first)
        p = 1 / (1 + np.exp(-np.clip(self.logit(h), -35, 35)))
        e = ((p - y) / len(y)).astype(np.float32)
        counts = np.diff(first)
        doc = np.repeat(np.arange(len(y)), counts)
        won = (r == top[doc]) & (r > 0)
        ties = np.add.reduceat(won.astype(np.float32), first[:-1])
        g = won * (e[:, None] * self.p["out"][:FILTERS] / np.maximum(ties, 1))[doc]
        g += (e[:, None] * self.p["out"][FILTERS:] / counts[:, None])[doc]
        g *= best > 0
        c, f = np.nonzero(g)
        value = g[c, f].astype(np.float32)
        under = chunks[c[:, None], at[c, f][:, None] * STRIDE + np.arange(WIDTH)]
        seen = self.p["byte"][under].reshape(len(c), WIDTH * DIM)
        d_filter = np.zeros_like(self.p["filter"])
        for k in range(FILTERS):
            own = f == k
            d_filter[:, k] = value[own] @ seen[own]
        d_seen = (value[:, None] * self.p["filter"].T[f]).reshape(-1, DIM)
        codes = under.ravel()
        d_byte = np.stack([np.bincount(codes, d_seen[:, d], 256) for d in range(DIM)], axis=1)
        return {"byte": d_byte.astype(np.float32), "filter": d_filter,
                "shift": np.bincount(f, value, FILTERS).astype(np.float32),
                "out": e @ h, "bias": np.array([e.sum()], np.float32)}


def fit(texts: list[bytes], y: np.ndarray, seed: int = 5) -> Network:
    """Train on whole texts; minibatches are drawn anew in each epoch."""
    net = Network(seed)
    share = min(max((y.sum() + 0.5) / (len(y) + 1), 1e-3), 1 - 1e-3)
    net.p["bias"][0] = math.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        net.p["out"][:] = 0
        return net
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    rng, t = np.random.default_rng(seed), 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            pick = order[a: a + BATCH]
            data = np.frombuffer(b"".join(texts[i] for i in pick), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
            t += 1
            rate = RATE * min(1, t / 20) * (1 - epoch / EPOCHS)
            for k, g in net.gradients(data, offsets, y[pick]).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.005 * (g * g - v[k])
                net.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.995 ** t)) + 1e-7)
    return net


class QualityModel:
    def __init__(self, spark: SparkSession, documents: DataFrame, labels: DataFrame, label: str = "quality"):
        rows = list(training_sample(documents, labels, label, SAMPLE_ROWS, SAMPLE_CHARS).toLocalIterator())
        self.network = fit([r["text"].encode() for r in rows], np.array([r["y"] for r in rows], np.float32))

    def score(self, documents: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
        """``keep`` columns and ``score`` for each row."""
        network, fields = self.network, documents.select(*keep).schema
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double"

        def per_partition(batches):
            for rows, texts in text_arrays(batches, text_col, 4 << 20):
                yield from rows.select(keep).append_column(
                    "score", pa.array(network.scores(*byte_view(texts)), pa.float64())).to_batches()

        return documents.select(*keep, *([] if text_col in keep else [text_col])).mapInArrow(per_partition, schema)


def quality_scores(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = QualityModel(spark, documents, labels).score(documents, ["doc_id"])
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
