import zlib

import numpy as np
import pyarrow as pa
import pytest

from quillmart.llm import quality, queries, toxicity
from tests.llm import data

SF = "/root/testdata/sf0.1"


def accuracy(spark, query, label):
    rows = query(spark, SF).collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return len(rows), held


def test_op4_held_out(spark):
    n, held = accuracy(spark, queries.op4_quality_cnn, "quality")
    assert n == 10_000
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert sum(p for p, y in held if y) / sum(y for _, y in held) > 0.99


def test_op6_held_out(spark):
    n, held = accuracy(spark, queries.op6_toxicity, "toxic")
    assert n == 10_000
    assert sum(p for p, y in held if y) / sum(y for _, y in held) > 0.8
    assert sum(p for p, y in held if not y) <= 0.01 * len(held)


@pytest.mark.parametrize("query", [queries.op4_quality_cnn, queries.op6_toxicity])
def test_edge_rows(spark, tmp_path, query):
    rows = data.edge_rows(3000)
    labels = spark.createDataFrame([(i, i % 2, None if i == 3 else (i + 1) % 2) for i in range(12)] + [(None, 1, 1)] * 2,
                                   "doc_id long, quality int, toxic int")
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows), labels=labels)
    got = query(spark, sf).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    none = data.write_tables(spark, tmp_path / "none", documents=data.documents(spark, rows), labels=labels.limit(0))
    assert {round(r["score"], 6) for r in query(spark, none).collect()} == {0.5}
    empty = data.write_tables(spark, tmp_path / "empty", documents=data.documents(spark, []), labels=labels)
    assert query(spark, empty).count() == 0


def test_counterfactuals_lower_the_weight_of_identity_terms():
    r = np.random.default_rng(0)
    filler = [f"word{i}" for i in range(60)]
    sample = []
    for i in range(600):
        y = i % 5 == 0
        words = list(r.choice(filler, 12)) + (["vile"] if y and r.random() < 0.7 else [])
        words += ["muslim"] if r.random() < (0.6 if y else 0.05) else []  # a group named mostly in toxic texts
        text = " ".join(words)
        a, b = toxicity.text_features(text), toxicity.text_features(text, swap=True)
        sample.append((int(y), a, None if np.array_equal(a, b) else b))
    neutral = pa.array(["a muslim word1 word2", "a jewish word1 word2"])

    def gap(weight):
        a, b = toxicity.score_texts(neutral, *toxicity.fit(sample, swap_weight=weight))
        return abs(a - b), a

    plain, fair = gap(0.0), gap(20.0)
    assert fair[0] < 0.5 * plain[0] and fair[1] < plain[1]


def test_whole_text_counts_for_toxicity():
    weights = {f: 9.0 for f in toxicity.word_features("vile")[:1]}
    text = "calm " * 50_000 + "Vile! vile, (vile)"
    scores = toxicity.score_texts(pa.array([text, "calm", ""]), -4.0, weights)
    assert scores[0] == pytest.approx(1 / (1 + np.exp(-5))) and scores[1] == scores[2] < 0.02


def test_chunks_cover_every_byte():
    for sizes in ([0, 1, 255, 256, 257, 496, 497, 5000], [0], [300]):
        data_ = np.arange(sum(sizes)).astype(np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        chunks, first = quality.cut(data_, offsets)
        for k, n in enumerate(sizes):
            own = chunks[first[k]:first[k + 1]]
            text = data_[offsets[k]:offsets[k + 1]]
            back = np.concatenate([c[:quality.HOP] for c in own[:-1]] + [own[-1]])[:n]
            assert (back == text).all() and len(own) >= 1


def test_gradients():
    r = np.random.default_rng(1)
    net = quality.Network(2)
    net.p = {k: v.astype(np.float64) if k in ("out", "bias", "shift") else v for k, v in net.p.items()}
    sizes = [30, 700, 0]
    data_ = r.integers(1, 255, sum(sizes)).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        p = net.scores(data_, offsets)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = net.gradients(data_, offsets, y)
    for key, at in (("out", (3,)), ("out", (20,)), ("bias", (0,)), ("shift", (5,)), ("filter", (7, 4)), ("byte", (int(data_[5]), 2))):
        step = 1e-3
        held = net.p[key][at]
        net.p[key][at] = held + step
        up = loss()
        net.p[key][at] = held - step
        down = loss()
        net.p[key][at] = held
        assert grads[key][at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_equal_texts_get_equal_scores_wherever_they_stand():
    r = np.random.default_rng(3)
    net = quality.Network(4)
    texts = [bytes(r.integers(32, 126, int(n)).astype(np.uint8)) for n in r.integers(0, 1500, 300)]
    texts += texts[::-1] + [texts[5]] * 7
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    scores = net.scores(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert (scores[:300] == scores[300:600][::-1]).all() and (scores[600:] == scores[5]).all()
    for t, s in zip(texts[:40], scores):
        assert net.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] == s
