"""Scores of the two classifiers against plain sums, one text at a time."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quillmart.llm import quality, toxicity
from quillmart.llm.common import byte_view
from tests.llm import data

TEXTS = [t or "" for _, t in data.edge_rows(900)] + ["a" * n for n in (1, 7, 8, 255, 256, 257, 495, 496, 497)]


def plain_probability(net, raw):
    """Every chunk, every place of every filter, one product at a time."""
    starts = [0]
    while starts[-1] + quality.CHUNK < len(raw):
        starts.append(starts[-1] + quality.HOP)
    pooled = []
    for s in starts:
        chunk = raw[s: s + quality.CHUNK].ljust(quality.CHUNK, b"\0")
        best = [-math.inf] * quality.FILTERS
        for at in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
            seen = [float(v) for byte in chunk[at: at + quality.WIDTH] for v in net.p["byte"][byte]]
            for f in range(quality.FILTERS):
                best[f] = max(best[f], sum(x * float(w) for x, w in zip(seen, net.p["filter"][:, f])))
        pooled.append([max(0.0, b + float(c)) for b, c in zip(best, net.p["shift"])])
    top = [max(p[f] for p in pooled) for f in range(quality.FILTERS)]
    mean = [sum(p[f] for p in pooled) / len(pooled) for f in range(quality.FILTERS)]
    logit = sum(h * float(w) for h, w in zip(top + mean, net.p["out"])) + float(net.p["bias"][0])
    return 1 / (1 + math.exp(-logit))


def test_network_equals_a_plain_convolution():
    rnd = random.Random(2)
    texts = [t for t in TEXTS if len(t.encode()) < 1500] + ["".join(rnd.choices("abc déé.\n", k=n)) for n in (300, 700)]
    net = quality.Network()
    net.p["shift"] = np.linspace(-0.5, 0.5, quality.FILTERS).astype(np.float32)
    net.p["bias"][:] = 0.3
    got = net.scores(*byte_view(pa.array(texts, pa.string())))
    assert got.tolist() == pytest.approx([plain_probability(net, t.encode()) for t in texts], abs=1e-5)


def test_chunks_cover_every_byte_and_overlap():
    raw = np.arange(1500) % 251 + 1
    chunks, first = quality.cut(raw.astype(np.uint8), np.array([0, 1500]))
    seen = set()
    for i, chunk in enumerate(chunks):
        part = raw[i * quality.HOP: i * quality.HOP + quality.CHUNK]
        assert chunk[: len(part)].tolist() == part.tolist() and not chunk[len(part):].any()
        seen.update(range(i * quality.HOP, i * quality.HOP + len(part)))
    assert seen == set(range(1500)) and first.tolist() == [0, len(chunks)]


def plain_toxicity(text, bias, weights):
    """bias and the weights of the distinct features of all words."""
    features = set()
    for word in data.words(text):
        features.update(toxicity.word_features(toxicity.bare(word.encode())))
    return 1 / (1 + math.exp(-(bias + sum(weights.get(f, 0.0) for f in features))))


def test_toxicity_equals_a_plain_sum_of_weights():
    rnd = random.Random(4)
    words = sorted({toxicity.bare(w.encode()) for t in TEXTS for w in data.words(t)})
    weights = {f: rnd.uniform(-2, 2) for w in words for f in toxicity.word_features(w) if rnd.random() < 0.6}
    got = toxicity.score_texts(pa.array(TEXTS, pa.string()), -0.7, weights)
    assert got.tolist() == pytest.approx([plain_toxicity(t, -0.7, weights) for t in TEXTS])


def test_the_penalty_brings_swapped_sentences_together():
    rnd = random.Random(6)
    rows = []
    for i in range(600):  # in the sample, one group is named more often in toxic sentences
        toxic = i % 2
        group = "muslim" if rnd.random() < (0.8 if toxic else 0.2) else "christian"
        rows.append((toxic, f"the {group} {'awful trash' if toxic else 'kind person'} w{rnd.randrange(40)}"))
    sample = [(y, toxicity.text_features(t), toxicity.text_features(t, swap=True)) for y, t in rows]

    def gap(weight):
        bias, weights = toxicity.fit(sample, swap_weight=weight)
        return abs(plain_toxicity("a muslim spoke", bias, weights) - plain_toxicity("a jewish spoke", bias, weights)) + abs(
            plain_toxicity("a christian spoke", bias, weights) - plain_toxicity("a muslim spoke", bias, weights))

    assert gap(toxicity.SWAP_WEIGHT) < 0.5 * gap(0.0)
