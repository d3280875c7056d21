import math
import random
from collections import Counter

import pyarrow as pa
import pytest

from quillmart.llm import decontaminate
from quillmart.llm.common import Words
from tests.llm import data


def shingles(words, unit):
    return [tuple(words[i: i + unit]) for i in range(len(words) - unit + 1)]


def brute(docs, items):
    """(text, item) -> (similarity, first word) of the most similar span, from every span."""
    split = [(i, w) for i, t in items if (w := data.words((t or "").lower()))]
    bags = [(i, len(w), min(5, len(w)), Counter(shingles(w, min(5, len(w))))) for i, w in split]
    uses = Counter(s for *_, bag in bags for s in bag)
    n, out = len(bags), {}
    for d, text in enumerate(docs):
        words = data.words((text or "").lower())
        for i, size, unit, bag in bags:
            if not bag.keys() & set(shingles(words, unit)):
                continue
            weight = {s: math.log(1 + n / uses[s]) for s in bag}
            for at in range(max(len(words) - size, 0) + 1):
                span = Counter(shingles(words[at: at + size], unit))
                both = sum(weight[s] * min(c, bag[s]) for s, c in span.items() if s in bag)
                either = sum(weight.get(s, math.log(1 + n)) * max(span[s], bag[s]) for s in span.keys() | bag.keys())
                if both and (found := round(both / either, 9)) >= 0.8 and found > out.get((d, i), (0,))[0]:
                    out[d, i] = (found, at)
    return out


def search(docs, items, index=None):
    words = Words(pa.array([(t or "").lower() for t in docs], pa.string()))
    found = (index or decontaminate.ItemIndex(items)).search(words.hashes()[0], words.docs)
    return {(d, i): (s, at) for d, i, s, _, at in found}


def edited(r, words, edits):
    """The words with so many random edits inside: replaced, left out or put in."""
    words = list(words)
    for _ in range(edits):
        at = r.randrange(1, len(words) - 1)
        kind = r.randrange(3)
        words[at: at + (kind != 2)] = [] if kind == 1 else [f"new{r.randrange(10 ** 6)}"]
    return words


def benchmark(r, lengths):
    """Items of these lengths; every third shares its first half with the item before."""
    items = []
    for i, n in enumerate(lengths):
        words = [f"q{r.randrange(400)}" for _ in range(n)]
        if i % 3 == 2:
            words[: n // 2] = items[-1][1].split()[: n // 2]
        items.append((i, " ".join(words)))
    return items


@pytest.mark.parametrize("seed", range(4))
def test_edits_inside_items_equal_brute_force(seed):
    r = random.Random(seed)
    items = benchmark(r, [15, 21, 29, 40, 50, 50, 54, 55, 59, 59, 80, 120, 200, 300])
    items += [(50, "a b c d e f g " * 9), (51, "two words"), (52, None), (53, items[3][1])]
    docs = []
    for _, text in items[:15]:
        words = text.split()
        for edits in (0, 1, len(words) // 50, len(words) // 40):
            around = [[f"f{r.randrange(90)}" for _ in range(r.randrange(30))] for _ in range(2)]
            docs.append(" ".join([*around[0], *edited(r, words, edits), *around[1]]))
    docs += ["a b c d e f g " * 30, "just two words", "", None, docs[0] + " " + docs[0]]
    want = brute(docs, items)
    assert len(want) > 45 and search(docs, items) == want


def test_a_replaced_word_in_the_middle_of_long_items():
    r = random.Random(7)
    items = [(i, " ".join(f"q{r.randrange(10 ** 5)}" for _ in range(50 + i % 10))) for i in range(300)]
    docs = []
    for _, text in items:
        words = text.split()
        words[len(words) // 2] = "other"
        docs.append("before it " + " ".join(words) + " and after")
    assert {(i, i) for i in range(300)} == search(docs, items).keys()


def test_documents_shorter_than_their_item():
    r = random.Random(3)
    items = [(i, " ".join(f"q{r.randrange(10 ** 5)}" for _ in range(n))) for i, n in enumerate([15, 17, 27, 38, 40, 48, 56, 59, 300])]
    docs = [" ".join(t.split()[a: len(t.split()) - b]) for _, t in items for a, b in ((0, 1), (1, 0), (2, 2), (0, 5), (3, 6))]
    want = brute(docs, items)
    assert {(5 * i + k, i) for i in range(9) for k in (0, 1)} <= want.keys()
    assert search(docs, items) == want


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    r = random.Random(11)
    common = [f"q{r.randrange(400)}" for _ in range(30)]
    items = [(i, " ".join([*common[: 10 + i % 20], *(f"q{r.randrange(400)}" for _ in range(8 + i % 25))])) for i in range(40)]
    items += [(90, None), (91, items[5][1]), (92, "two words")]
    docs = [" ".join(edited(r, t.split(), i % 3)[i % 4:]) for i, (_, t) in enumerate(items[:40])] + ["two words", None]
    want = brute(docs, items)
    table = data.documents(spark, [*enumerate(docs)]).repartition(2)
    for block, order in ((2000, 1), (15, 1), (15, -1)):
        monkeypatch.setattr(decontaminate, "ITEM_BLOCK", block)
        benchmark = spark.createDataFrame(items[::order], "item_id long, text string").coalesce(1)
        got = decontaminate.contamination(spark, table, benchmark).collect()
        assert {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"]) for r in got} == want and len(got) == len(want)
        left = decontaminate.drop_contaminated(spark, table, benchmark)
        assert {r["doc_id"] for r in left.collect()} == set(range(len(docs))) - {d for d, _ in want}


def test_blocks_are_bounded_in_characters(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    items = spark.createDataFrame([(i, "x" * n) for i, n in enumerate([40, 60, 1, 500, 99])] + [(5, None)], "item_id long, text string")
    assert [[i for i, _ in b] for b in decontaminate.item_blocks(items.coalesce(1))] == [[0, 1], [2], [3], [4, 5]]


@pytest.mark.parametrize("length", [12, 15, 21, 29, 40, 50, 59, 80, 120, 200, 300])
def test_recall_by_length(length):
    r = random.Random(length)
    items = benchmark(r, [length] * 6)
    docs = []
    for _, text in items * 2:
        words = text.split()
        n = len(words)
        docs += [" ".join(["before", *edited(r, words, e), "after"]) for e in {1, max(1, n // 50), max(1, n // 45)}]
        docs += [" ".join(words[a: n - b]) for a, b in ((0, n // 9), (n // 9, 0), (n // 18, n // 18), (n // 12, n // 12), (0, n // 6))]
    want, got = brute(docs, items), search(docs, items)
    assert got.items() <= want.items() and len(got) >= 0.99 * len(want) and len(want) >= 30


def test_the_radius_finds_what_equal_fingerprints_miss(monkeypatch):
    """Two changed words, one shared by the first two of three windows and one inside the third."""
    r = random.Random(5)
    items = [(i, " ".join(f"q{r.randrange(10 ** 5)}" for _ in range(118))) for i in range(150)]
    item = decontaminate.ItemIndex(items).items[0]
    size, prints = item.windows()
    assert len(prints) == 3
    first = (len(item.shingles) - 3 * size) // 2
    docs = []
    for _, text in items:
        words = text.split()
        words[first + size + 1] = "one"  # the last three shingles of the first window, the first two of the second
        words[first + 2 * size + size // 2] = "two"
        docs.append(" ".join(words))
    want = brute(docs, items)
    assert len(want) == len(items)
    found = search(docs, items)
    monkeypatch.setattr(decontaminate, "RADIUS", 0)
    assert len(found) >= 0.97 * len(want) and len(search(docs, items)) == 0
