import collections
import functools
import operator
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillmart.llm import decontaminate, fingerprints, queries
from quillmart.llm.common import Words
from tests.llm import brute, data


def rows():
    r = random.Random(5)
    out = []
    for i in range(60):
        lines = [" ".join(f"{r.choice('abcdé')}{r.randrange(50)}" for _ in range(r.randrange(1, 12)))
                 for _ in range(r.randrange(1, 40))]
        out.append((1000 + 3 * i, "\n".join(lines)))
    out += [(1007, "One. Two! " * 60), (1008, "same"), (1010, "same")]
    return out + data.edge_rows(800)


def test_op10_query(spark, tmp_path):
    all_rows = rows()
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, all_rows).repartition(4))
    got = queries.op10_fingerprints(spark, sf).collect()
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9),
                                round(r["near_next"], 9), r["recovered_edited"], r["recovered_next"]) for r in got) == collections.Counter(brute.edits(all_rows))
    by = collections.defaultdict(set)
    text = dict(all_rows)
    for r in got:
        by[text[r["doc_id"]] or ""].add(r["fingerprint"])
        assert len(r["fingerprint"].split(",")) == 3 * fingerprints.BASE_CELLS == len(r["edited_fingerprint"].split(","))
    assert all(len(v) == 1 for v in by.values())
    assert len({next(iter(v)) for v in by.values()}) == len(by)


def test_single_and_no_document(spark, tmp_path):
    one = data.write_tables(spark, tmp_path / "a", documents=data.documents(spark, [(5, "ab\ncd")]))
    r = queries.op10_fingerprints(spark, one).head()
    assert (r["near_next"], r["n_chars"]) == (1.0, 5)
    none = data.write_tables(spark, tmp_path / "b", documents=data.documents(spark, []))
    assert queries.op10_fingerprints(spark, none).count() == 0


def test_peeling_recovers_the_differing_digests(spark):
    a = list(range(100, 160))
    b = list(range(105, 163))
    pairs = spark.createDataFrame([(1, a, b), (2, a, a[1:]), (3, list(range(500)), [])], "k int, a array<long>, b array<long>")
    got = {r["k"]: r for r in fingerprints.recovered(pairs, ["k"], 16).collect()}
    assert got[1]["whole"] and got[1]["only_a"] == [100, 101, 102, 103, 104] and got[1]["only_b"] == [160, 161, 162]
    assert got[2]["only_a"] == [100] and not got[3]["whole"]
    counts = {r["k"]: (r["n_a"], r["n_b"], r["x_a"], r["x_b"]) for r in fingerprints.differences(spark, pairs, ["k"]).collect()}
    xor = lambda xs: functools.reduce(operator.xor, xs, 0)
    assert counts == {1: (5, 3, xor(a[:5]), xor([160, 161, 162])), 2: (1, 0, 100, 0), 3: (500, 0, xor(range(500)), 0)}


def test_only_failed_pairs_are_tried_again(spark, monkeypatch):
    pairs = spark.createDataFrame([(k, list(range(k, k + 30)), list(range(k, k + 30 + (k % 7 == 0) * 60 + 1))) for k in range(70)],
                                  "k int, a array<long>, b array<long>")
    tried, true = [], fingerprints.difference
    monkeypatch.setattr(fingerprints, "difference", lambda p, keys, cells, seed: tried.append(p.count()) or true(p, keys, cells, seed))
    got = {r["k"]: (r["n_a"], r["n_b"]) for r in fingerprints.differences(spark, pairs, ["k"]).collect()}
    assert got == {k: (0, 61 if k % 7 == 0 else 1) for k in range(70)}
    assert tried[0] == 70 and tried[1] == 10 and all(n <= 10 for n in tried[2:])


def test_a_long_line_without_sentences_keeps_its_unchanged_half(spark, tmp_path):
    long = ["文字是了" * 300, "word " * 300, " ".join(f"w{i}$" for i in range(400)),
            "one sentence. " * 60, "这是一个句子。" * 200]
    rows = [(i, t) for i, t in enumerate(long)]
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows))
    got = queries.op10_fingerprints(spark, sf).collect()
    assert {r["doc_id"]: round(r["near_edited"], 9) for r in got} == {d: n for d, _, _, n, *_ in brute.edits(rows)}
    assert all(r["near_edited"] > 0 for r in got)


def test_parts_by_cuts(spark):
    cuts = sorted(random.Random(2).sample(range(1000), 23))
    df = spark.range(-5, 1005).select("id", fingerprints._part(cuts, F.col("id")).alias("p"))
    assert all(r["p"] == sum(c < r["id"] for c in cuts) for r in df.collect())


def bench():
    r = random.Random(9)
    items = [(i, " ".join(f"q{r.randrange(3000)}" for _ in range(r.choice((14, 20, 33, 58, 300))))) for i in range(40)]
    return items + [(100, "Three Short words"), (101, None), (102, "  "), (103, items[0][1])]


def test_op1_query(spark, tmp_path):
    items = bench()
    r = random.Random(4)
    filler = lambda n: " ".join(f"f{r.randrange(500)}" for _ in range(n))
    docs = [(i, filler(r.randrange(1, 200))) for i in range(30)]
    for i, t in items[:40]:
        docs.append((1000 + i, f"{filler(r.randrange(0, 60))} {t.upper()} {filler(r.randrange(0, 60))}"))
    edited = items[4][1].split() if len(items[4][1].split()) > 40 else items[[len(t.split()) > 40 for _, t in items[:40]].index(True)][1].split()
    docs.append((2000, filler(9) + " " + " ".join(edited[:-1] + ["other"]) + " " + filler(9)))
    docs.append((2001, " ".join(items[2][1].split()[:6]) + " " + filler(40)))  # a few shared words only
    docs.append((3000, f"{filler(5)} three short words {filler(5)}"))
    docs += data.edge_rows(500)
    sf = data.write_tables(
        spark, tmp_path, documents=data.documents(spark, docs),
        benchmark=spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"))
    got = queries.op1_decontamination(spark, sf).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert {(1000 + i, i) for i, _ in items[:40]} <= pairs and (3000, 100) in pairs and (1000, 103) in pairs
    assert {d for d, _ in pairs} == {1000 + i for i in range(40)} | {2000, 3000}
    assert all(r["similarity"] >= 0.8 for r in got)
    left = decontaminate.drop_contaminated(spark, data.documents(spark, docs), spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert left.count() == len(docs) - 42
    assert decontaminate.contamination(spark, data.documents(spark, []), spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    assert decontaminate.contamination(spark, data.documents(spark, docs), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_multi_index_finds_every_fingerprint_within_the_radius():
    r = np.random.default_rng(7)
    text = " ".join(f"t{x}" for x in r.integers(0, 9000, 4000))
    items = [(i, " ".join(text.split()[a: a + 20])) for i, a in enumerate(range(0, 3900, 130))]
    index = decontaminate.ItemIndex(items)
    words = Words(pa.array([text]))
    size, probes = next(iter(index.probes[5].items()))
    prints = decontaminate.simhashes(decontaminate.ngrams(words.hashes()[0], 5), [size])[size].view(np.uint64).ravel()
    for k, p in enumerate(probes["prints"]):
        near = np.flatnonzero(np.bitwise_count(prints ^ p) <= decontaminate.RADIUS)
        hit = np.zeros(len(prints), bool)
        for b, (first, listed) in enumerate(probes["tables"]):
            value = (prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)
            for w in near:
                v = int(value[w])
                hit[w] |= k in listed[first[v]: first[v + 1]]
        assert hit[near].all()


def test_simhash_lanes_equal_a_plain_vote():
    s = np.random.default_rng(0).integers(0, 2 ** 63, 300, dtype=np.uint64) * np.uint64(2654435761)
    got = decontaminate.simhashes(s, [7, 251])
    for m in (7, 251):
        for at in (0, 11, 300 - m):
            bits = ((s[at: at + m, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(0) > m // 2
            assert int(got[m][at].copy().view(np.uint64)[0]) == sum(1 << i for i in range(64) if bits[i])
