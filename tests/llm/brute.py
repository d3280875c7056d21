"""Plain-Python answers for small tables."""

import collections
import hashlib
import re

import xxhash

from tests.llm import data


def shingles(text):
    w = data.words(data.lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(rows):
    """[(doc_id, set size, component id)] for (doc_id, text) rows."""
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i))) for i, ((d, *_), s) in enumerate(zip(rows, sets))]


def substrings(rows, window=35):
    """[(doc_id, words, removed, digest of the kept)]"""
    texts = [data.words(t) for _, t, *_ in rows]
    seen = collections.Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, *_), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


CUTS = [r"(?<=[.!?]) ", "(?<=[。！？；…])", "(?<=[hly]) ", "(?<=[eta]) ",
        "(?<=[hly][^a-z]) |(?<=[hly][^a-z]{2}) |(?<=[hly][^a-z]{3}) ", " ", "(?<=[的是了，、])"]


def paragraphs(text):
    pieces = text.split("\n")
    for cut in CUTS:
        pieces = [q for p in pieces for q in (re.split(cut, p) if len(p) > 256 else [p])]
    return set(pieces)


def recovered(a, b):
    """number:XOR of the digests of a without b, number:XOR of those of b without a."""
    sides = []
    for one, other in ((a, b), (b, a)):
        total = 0
        for p in one - other:
            total ^= xxhash.xxh64_intdigest(p.encode(), seed=42)
        sides.append(f"{len(one - other)}:{total:016x}")
    return ":".join(sides) if a != b else ""


def edits(rows):
    """[(doc_id, chars, edited digest, likeness to the edited text, to the next text, recovered digests)]"""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for i, (d, t, *_) in enumerate(ordered):
        t, follow = t or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + follow[:half]
        a, b, c = paragraphs(t), paragraphs(edited), paragraphs(follow)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(),
                    round(len(a & b) / len(a | b), 9), round(len(a & c) / len(a | c), 9), recovered(a, b), recovered(a, c)))
    return out
