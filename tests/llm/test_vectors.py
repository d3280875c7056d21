import hashlib
import math
import random

import numpy as np
import pytest

from quillmart.llm import pivots, walsh

SCHEMA = "vec_id long, embedding array<float>, label int"


def floored(vector):
    return [math.floor(1024 * float(np.float32(x))) for x in vector]


def fine(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def vectors(n, dims=64, seed=1, spread=0.3):
    rnd = random.Random(seed)
    middles = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    return [(i * 3 + 1, [m + rnd.gauss(0, spread) for m in rnd.choice(middles)], rnd.choice([None, 1, 2, 7])) for i in range(n)]


ODD = [(900, None, 1), (901, [0.5] * 63, 1), (902, [0.5] * 63 + [None], 1), (903, [float("nan")] + [0.5] * 63, 2),
       (904, [0.5] * 63 + [float("-inf")], 2), (905, [], 3), (906, [0.25] * 65, 3)]


# ------------------------------------------------------------------ clusters
def brute_clusters(rows, k=8, rounds=10):
    kept = [(d, floored(v)) for d, v, *_ in rows if fine(v) and len(v) == 64]
    named = sorted((hashlib.sha256(f"3:{d}".encode()).hexdigest() if d is not None else "~", v) for d, v in kept)
    centres = [v for _, v in named[:k]]

    def assign():
        return [min((distance(v, c), i) for i, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for i in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == i]
            if own:
                centres[i] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    per = {i: sum(d for d, c in found if c == i) for i in range(len(centres))}
    return sorted((str(d), c, far, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                  for (d, _), (far, c) in zip(kept, found))


def clusters(spark, rows):
    got = walsh.cluster(spark, spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in got.collect())


@pytest.mark.parametrize("rows", [
    vectors(150) + ODD, vectors(5), vectors(40, spread=0) * 2, vectors(3) + [(None, [0.1] * 64, 1)] * 2,
    [(i, [-0.0001] * 64, None) for i in range(12)]], ids=["mixed", "few", "ties", "null ids", "equal"])
def test_clusters_equal_brute_force(spark, rows):
    assert clusters(spark, rows) == brute_clusters(rows)


def test_no_vectors_and_too_large_ones(spark):
    assert clusters(spark, ODD) == [] and walsh.cluster(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="would not fit"):
        walsh.cluster(spark, spark.createDataFrame([(1, [20000.0] * 64, 1)], SCHEMA)).count()


def test_transform_is_exact_and_smooth_functions_come_first():
    rnd = np.random.default_rng(0)
    v = rnd.integers(-(1 << 23), 1 << 23, (50, 64))
    c = walsh.transform(v)
    assert (walsh.transform(c) == 64 * v).all() and ((c ** 2).sum(1) == 64 * (v ** 2).sum(1)).all()
    order = walsh.sequency_order(64)
    rows = walsh.transform(np.eye(64, dtype=np.int64))[order]
    assert [(a[1:] != a[:-1]).sum() for a in rows] == list(range(64))
    assert [int(x) for x in walsh._components(c[0][order])] == v[0].tolist()


def test_search_drops_centroids_before_all_coefficients():
    rows = walsh.scaled(np.array([v for _, v, _ in vectors(400, spread=0.05)]))
    coefs = walsh.transform(rows)[:, walsh.sequency_order(64)]
    centres = coefs[:8]
    best, far, taken = walsh.nearest(coefs, centres)
    full = ((coefs[:, None] - centres[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (far == full.min(1)).all()
    assert taken < 0.5 * full.size * 64


# --------------------------------------------------------------------- codes
def brute_codes(rows, entries=256, rounds=4, dims=64):
    kept = [(d, floored(v), label) for d, v, label in rows if fine(v) and len(v) == dims]
    w = dims // 4
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * w:(p + 1) * w] for _, v, _ in first] for p in range(4)]

    def assign():
        return [[min((distance(v[p * w:(p + 1) * w], e), i) for i, e in enumerate(books[p])) for p in range(4)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assign()
        for p in range(4):
            groups = {}
            for (_, v, _), f in zip(kept, found):
                groups.setdefault(f[p][1], []).append(v[p * w:(p + 1) * w])
            for i, own in groups.items():
                books[p][i] = [sum(x) // len(own) for x in zip(*own)]
    found, per = assign(), {}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    for (_, _, label), f in zip(kept, found):
        per[label] = per.get(label, 0) + sum(d for d, _ in f)
    return sorted((str(d), "".join(f"{i:02x}" for _, i in f), sum(x for x, _ in f), per[label], digest)
                  for (d, _, label), f in zip(kept, found))


def codes(spark, rows, **options):
    got = pivots.part_codes(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in got.collect())


@pytest.mark.parametrize("rows,options", [
    (vectors(120) + ODD, {"entries": 16}), (vectors(300, spread=0.02), {"entries": 40}), (vectors(30), {}),
    (vectors(20, spread=0) * 3, {"entries": 25}), (vectors(10) + [(None, [0.1] * 64, None)] * 2, {})],
    ids=["mixed", "tight", "few", "ties", "null ids"])
def test_codes_equal_brute_force(spark, rows, options):
    assert codes(spark, rows, **options) == brute_codes(rows, **options)


def test_codes_of_nothing(spark):
    assert codes(spark, [r for r in ODD if not fine(r[1]) or not r[1]]) == []
    assert codes(spark, [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1), (3, [0.5] * 64, 1)]) == brute_codes(
        [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1)], dims=8)  # most have eight


@pytest.mark.parametrize("spread", [0.01, 0.5])
def test_pruned_search_equals_all_distances(spread):
    rows = pivots.scaled(np.array([v for _, v, _ in vectors(3000, dims=16, spread=spread)]))
    entries = np.concatenate([rows[:100], rows[:20]])  # with equal entries
    points = pivots.choose_pivots(entries)
    best, far, spent = pivots.nearest(rows, pivots.distances(rows, points), entries, pivots.distances(entries, points))
    full = pivots.squares(rows, entries)
    assert (best == full.argmin(1)).all() and (far == full.min(1)).all()
    assert spent < (0.5 if spread < 0.1 else 1.1) * full.size


def test_whole_roots_and_large_components():
    squares = np.array([0, 1, 2, 3, 4, 8, 9, (1 << 50) - 1, 1 << 50, ((1 << 26) - 1) ** 2, 1 << 54])
    assert pivots.whole_root(squares).tolist() == [math.isqrt(int(s)) for s in squares]
    big = np.array([[1 << 23, -(1 << 23)], [(1 << 23) - 1, 5]])
    assert pivots.squares(big, big).tolist() == [[distance(a, b) for b in big.tolist()] for a in big.tolist()]
