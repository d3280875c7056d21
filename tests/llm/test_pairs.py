import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from quillmart.llm import components, jaccard, queries, substrings
from tests.llm import brute, data


def family(seed, base, changes, n):
    """Copies of a word list with runs of words replaced."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, changes)):
            w[r.randrange(len(w))] = f"x{r.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def corpus(seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß", "Ünicode"]
    texts = []
    for k, size in enumerate((5, 6, 9, 14, 30, 60, 61, 130, 300)):
        texts += family(k, [r.choice(vocabulary) for _ in range(size)], max(1, size // 14), 14)
    passage = " ".join(r.choice(vocabulary) for _ in range(40))
    for k in range(25):
        own = " ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 90)))
        texts.append(f"{own} {passage} {own[:r.randrange(0, 200)]}")
    texts += ["A B c d", "a b C D", "a b c d", "a", "A", " ".join(["same"] * 200)]
    rows = [(1000 + i, t) for i, t in enumerate(texts)]
    r.shuffle(rows)
    return rows + data.edge_rows(400) + rows[:3]


def test_op7_query(spark, tmp_path):
    rows = corpus()
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows).repartition(5))
    got = queries.op7_jaccard_join(spark, sf).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute.jaccard(rows))


def test_large_clusters_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard, "CLUSTER_SHINGLES", 400)
    monkeypatch.setattr(jaccard, "CENTRES", 2)
    base = [f"b{i}" for i in range(60)]
    rows = list(enumerate(family(3, base, 6, 40) + family(4, base[::-1], 2, 12)))
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows))
    want = brute.jaccard(rows)
    assert 3 < len({c for *_, c in want}) < len(rows)
    got = queries.op7_jaccard_join(spark, sf).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_signatures_are_shared_by_all_similar_sets():
    r = np.random.default_rng(3)
    for _ in range(1500):
        n = int(r.integers(1, 90))
        universe = r.integers(0, 2 ** 63, 3 * n + 4, dtype=np.uint64)
        a, b = set(universe[:n].tolist()), set(universe[:n].tolist())
        for _ in range(int(r.integers(0, n // 5 + 2))):
            if r.random() < 0.5 and len(b) > 1:
                b.discard(next(iter(b)))
            else:
                b.add(int(universe[r.integers(0, len(universe))]))
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        flat = np.concatenate([np.sort(np.array(list(x), np.uint64)) for x in (a, b)])
        own, value = jaccard.signatures(flat, np.array([0, len(a), len(a) + len(b)]))
        assert set(value[own == 0].tolist()) & set(value[own == 1].tolist()), (len(a), len(b))


def test_keep_one_keeps_a_row_of_each_component(spark):
    rows = corpus(2)
    df = data.documents(spark, rows)
    got = jaccard.keep_one(spark, df)
    assert got.columns == df.columns
    kept = collections.Counter(r["doc_id"] for r in got.collect())
    want = collections.Counter()
    seen = set()
    for (d, t), (_, n, c) in zip(rows, brute.jaccard(rows)):
        if n == 0:
            want[d] += 1
        elif c is None or c not in seen:
            seen.add(c)
            want[c] += 1
    assert kept == want


@pytest.mark.parametrize("query", ["op7_jaccard_join", "op9_substring_dedup"])
def test_empty_tables(spark, tmp_path, query):
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, []))
    assert queries.QUERIES[query](spark, sf).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(1, 1)]
    got = {r["node"]: r["root"] for r in components.components(
        spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{x: 7 for x in [7, *range(200, 260)]}}


def test_op9_query(spark, tmp_path):
    rows = corpus(4) + [(9000, " ".join(["loop"] * 90)), (9001, " ".join(f"k{i % 36}" for i in range(110)))]
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows).repartition(4))
    got = queries.op9_substring_dedup(spark, sf).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute.substrings(rows))


def test_cover_has_every_difference():
    seen = {(int(a) - int(b)) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert seen == set(range(substrings.PERIOD))


def test_dedup_texts(spark):
    passage = " ".join(f"p{i}" for i in range(36))
    df = data.documents(spark, [(1, f"start {passage} end"), (2, f"other {passage}"), (3, None), (4, "free  text")])
    got = {r["doc_id"]: r["kept"] for r in substrings.dedup_texts(spark, df).collect()}
    assert got == {1: "start end", 2: "other", 3: None, 4: "free  text"}


def test_labels_of_one_cluster():
    sets = [np.arange(a, a + 50, dtype=np.uint64) for a in (0, 2, 100, 4, 101, 300)]
    labels = jaccard._cluster_labels(np.array([9, 8, 7, 6, 5, 4]), sets)
    assert labels.tolist() == [6, 6, 5, 6, 5, 4]
    assert len(pa.array(labels)) == 6


def _components(sets):
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    return label


@pytest.mark.parametrize("seed", range(6))
def test_labels_equal_all_pairs(seed, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY", 2 if seed % 2 else 64)
    r = random.Random(seed)
    sets = []
    for _ in range(12):
        base = [r.randrange(10 ** 6) for _ in range(r.choice([1, 4, 10, 40]))] + list(range(r.choice([0, 5, 30])))
        for _ in range(12):
            own = set(base)
            for _ in range(r.randrange(len(base) // 4 + 1)):
                own.discard(r.choice(base))
                own.add(r.randrange(10 ** 6))
            sets.append(own)
    sets = [s for s in sets if s]
    got = jaccard._cluster_labels(np.arange(len(sets)), [np.array(sorted(s), np.uint64) for s in sets])
    assert got.tolist() == _components(sets)


def test_sets_with_a_common_template_cost_little():
    r = np.random.default_rng(1)
    template = np.arange(6, dtype=np.uint64)
    sets = [np.sort(np.concatenate([template, r.integers(100, 1 << 62, 9).astype(np.uint64)])) for _ in range(60_000)]
    import time
    start = time.perf_counter()
    assert (jaccard._cluster_labels(np.arange(len(sets)), sets) == np.arange(len(sets))).all()
    assert time.perf_counter() - start < 20


def test_large_clusters_of_templates_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard, "CLUSTER_SHINGLES", 300)
    r = random.Random(9)
    template = [f"t{i}" for i in range(40)]
    rows = []
    for i in range(60):
        own = [f"o{r.randrange(10 ** 6)}" for _ in range(14)]
        rows.append((i, " ".join(template + own)))
        if i % 3 == 0:
            rows.append((1000 + i, " ".join(template + own[:-1] + ["last"])))
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows))
    want = brute.jaccard(rows)
    assert 30 < len({c for *_, c in want}) < len(rows)
    made = []
    finer = jaccard.finer_clusters
    monkeypatch.setattr(jaccard, "finer_clusters", lambda *a: made.append(finer(*a)) or made[-1])
    got = queries.op7_jaccard_join(spark, sf).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert made and made[0].groupBy("part").count().agg({"count": "max"}).head()[0] < 20


def test_keep_one_leaves_a_column_named_row(spark):
    df = data.documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z")]).selectExpr(
        "*", "concat('r', doc_id) AS ROW", "7 AS row_")
    got = jaccard.keep_one(spark, df)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert sorted((r["doc_id"], r["ROW"], r["row_"]) for r in got.collect()) == [(1, "r1", 7), (3, "r3", 7)]
