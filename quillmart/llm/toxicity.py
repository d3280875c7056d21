"""Toxicity: a counterfactual-regularised linear classifier.

A text's features are its distinct words and the beginnings of 4 to 8 letters of
longer words (in lower case, without punctuation around them). Weights are learned by
follow-the-regularised-leader steps with an L1 term, so most words weigh
nothing. For every labelled sentence that names a group of people, a copy is made in
which each identity term is swapped for another of its category, and the
squared change of the score is part of the loss: a group's mere mention cannot
carry weight.

The driver gets a bounded sample of features (``SAMPLE_ROWS`` documents of at
most ``SAMPLE_CHARS`` characters) and broadcasts the weights, of which there are
at most as many as features in that sample. Scoring is one pass over the
documents, without a shuffle.

Defined cases: a null or empty text gets the score of a text without features;
equal rows get equal scores; without labels of both kinds every score is the
share of label 1 in the sample (0.5 without labels); an empty table gives an
empty result. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import Words, ranges, text_arrays
from quillmart.llm.labelled import fold, training_sample

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 8000
SAMPLE_CHARS = 20_000
THRESHOLD = 0.5
EPOCHS = 8
LEAST_DOCS = 4      # documents of the sample that a feature must occur in
PREFIXES = (4, 9)
SWAP_WEIGHT = 1.0   # of the counterfactual penalty
L1, L2, RATE, BETA = 4.0, 1.0, 1.0, 1.0

# Identity terms by category; a term is swapped for the next of its category.
IDENTITY = {
    "gender": ["women", "men"], "person": ["woman", "man"], "child": ["girl", "boy"],
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    "faithful": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    "origin": ["african", "asian", "european", "american", "arab", "mexican"],
    "colour": ["black", "white", "brown"], "orientation": ["gay", "straight", "lesbian", "bisexual"],
    "age": ["young", "old", "elderly"], "ability": ["disabled", "deaf", "blind", "autistic"],
    "femme": ["femmes", "hommes"], "frau": ["frauen", "männer"], "mujer": ["mujeres", "hombres"],
    "status": ["immigrant", "refugee", "foreigner"], "statuses": ["immigrants", "refugees", "foreigners"],
}
SWAP = {t: terms[(i + 1) % len(terms)] for terms in IDENTITY.values() for i, t in enumerate(terms)}


def bare(word: bytes) -> str:
    """A word in lower case, without what is not a letter or digit around it."""
    w = word.decode("utf-8", "replace").lower()
    if w.isalnum():
        return w
    a, b = 0, len(w)
    while a < b and not w[a].isalnum():
        a += 1
    while b > a and not w[b - 1].isalnum():
        b -= 1
    return w[a:b]


def _hash(kind: str, part: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{part}".encode()) >> 1


def word_features(word: str) -> list[int]:
    """Hashes of a bare word and of its beginnings."""
    if not word:
        return []
    return [_hash("w", word)] + [_hash("p", word[:k]) for k in range(*PREFIXES) if k < len(word)]


def text_features(text: str, swap: bool = False) -> np.ndarray:
    """Distinct features of a text; with ``swap`` those after the identity terms are swapped."""
    words = {bare(w) for w in text.encode().split()}
    if swap:
        words = {SWAP.get(w, w) for w in words}
    return np.unique(np.array([f for w in words for f in word_features(w)], np.int64))


def sample_features(sample: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray | None]]:
    """(label, features, features of the counterfactual copy if the text names a group)."""

    def per_partition(batches):
        for batch in batches:
            texts, y = batch.column("text").to_pylist(), batch.column("y")
            own = [text_features(t) for t in texts]
            other = [text_features(t, swap=True) for t in texts]
            swapped = [None if np.array_equal(a, b) else b.tobytes() for a, b in zip(own, other)]
            yield pa.RecordBatch.from_arrays(
                [y, pa.array([a.tobytes() for a in own], pa.binary()), pa.array(swapped, pa.binary())],
                names=["y", "own", "swapped"])

    rows = sample.mapInArrow(per_partition, "y int, own binary, swapped binary").toLocalIterator()
    return [(r["y"], np.frombuffer(r["own"], np.int64), None if r["swapped"] is None
             else np.frombuffer(r["swapped"], np.int64)) for r in rows]


def fit(sample: list[tuple[int, np.ndarray, np.ndarray | None]], swap_weight: float = SWAP_WEIGHT,
        seed: int = 7) -> tuple[float, dict[int, float]]:
    """(bias, weights by feature) by FTRL-proximal steps over log loss plus the counterfactual penalty."""
    positive = sum(y for y, _, _ in sample)
    share = min(max((positive + 0.5) / (len(sample) + 1), 1e-3), 1 - 1e-3)
    bias0 = math.log(share / (1 - share))
    if not sample or positive in (0, len(sample)):
        return bias0, {}
    names, counts = np.unique(np.concatenate([x for _, x, _ in sample]), return_counts=True)
    names = names[counts >= LEAST_DOCS]
    if not len(names):
        return bias0, {}

    def known(x):
        at = np.searchsorted(names, x)
        at[at == len(names)] = 0
        return at[names[at] == x]

    rows = [(y, known(x), None if s is None else known(s)) for y, x, s in sample]
    z, n = np.zeros(len(names)), np.zeros(len(names))
    bias, bias_n = bias0, 0.0

    def weights(at):
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0,
                        -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / RATE + L2))

    def step(at, w, g):
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / RATE
        z[at] += g - sigma * w
        n[at] += g * g

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            y, x, s = rows[k]
            w = weights(x)
            score = bias + w.sum()
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, score)))) - y
            step(x, w, g)
            bias_n += g * g
            bias -= RATE / (BETA + math.sqrt(bias_n)) * g
            if s is not None and swap_weight:
                a, b = np.setdiff1d(x, s, True), np.setdiff1d(s, x, True)
                wa, wb = weights(a), weights(b)
                change = 2 * swap_weight * (wa.sum() - wb.sum())
                step(a, wa, change)
                step(b, wb, -change)
    w = weights(np.arange(len(names)))
    kept = np.flatnonzero(w)
    return bias, dict(zip(names[kept].tolist(), w[kept].tolist()))


def score_texts(texts: pa.Array, bias: float, weights: dict[int, float]) -> np.ndarray:
    """Probability of label 1 for each text, over all its words."""
    words = Words(texts)
    found: dict[int, list[int]] = defaultdict(list)
    for code, word in enumerate(words.vocabulary.to_pylist()):
        hit = [f for f in word_features(bare(word)) if f in weights]
        if hit:
            found[code] = hit
    width = np.zeros(len(words.vocabulary), np.int64)
    width[list(found)] = [len(h) for h in found.values()]
    flat = np.array([f for c in sorted(found) for f in found[c]], np.int64)
    first = np.concatenate([[0], np.cumsum(width)[:-1]]) if len(width) else width
    at = np.flatnonzero(width[words.codes]) if len(words) else np.zeros(0, np.int64)
    codes = words.codes[at]
    doc = np.searchsorted(words.docs, at, "right") - 1
    features = flat[ranges(first[codes], width[codes])]
    pairs = np.unique(np.stack([np.repeat(doc, width[codes]), features]), axis=1) if len(features) else np.zeros((2, 0), np.int64)
    value = np.array([weights[f] for f in pairs[1].tolist()])
    total = bias + np.bincount(pairs[0], weights=value if len(value) else None, minlength=len(texts))[:len(texts)]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


class ToxicityModel:
    """Weights learned from a labelled sample, to be applied to any documents."""

    def __init__(self, spark: SparkSession, documents: DataFrame, labels: DataFrame, label: str = "toxic"):
        sample = sample_features(training_sample(documents, labels, label, SAMPLE_ROWS, SAMPLE_CHARS))
        self.bias, self.weights = fit(sample)
        # At most as many weights as features in the bounded sample.
        self.shared = spark.sparkContext.broadcast((self.bias, self.weights))

    def score(self, documents: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
        """``keep`` columns and ``score`` for each row."""
        shared, fields = self.shared, documents.select(*keep).schema
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double"

        def per_partition(batches):
            for rows, texts in text_arrays(batches, text_col):
                yield from rows.select(keep).append_column(
                    "score", pa.array(score_texts(texts, *shared.value), pa.float64())).to_batches()

        return documents.select(*keep, *([] if text_col in keep else [text_col])).mapInArrow(per_partition, schema)


def toxicity_scores(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = ToxicityModel(spark, documents, labels).score(documents, ["doc_id"])
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, documents: DataFrame, labels: DataFrame,
               threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without those scored ``threshold`` or more; all columns stay."""
    model = ToxicityModel(spark, documents, labels)
    shared = model.shared

    def per_partition(batches):
        for rows, texts in text_arrays(batches):
            yield from rows.filter(pa.array(score_texts(texts, *shared.value) < threshold)).to_batches()

    return documents.mapInArrow(per_partition, documents.schema)
