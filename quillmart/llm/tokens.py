"""Encoding text with the tokenizers library over Arrow batches.

A text is cut where the tokenizer's own split pattern is sure to end a piece
(white space, or a change between ASCII letters and ASCII punctuation), every
distinct chunk of a batch is encoded once by the library, and the ids are put
together again with numpy. A bounded table of chunks is kept by each worker. The ids
are those of the library for the whole text with add_special_tokens=False: the strings of
added tokens are chunks of their own, which the library finds by itself.

Defined cases: a null text is an empty one, an empty text has no ids (but the
end id, where one is given); a text of any length is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from quillmart.llm.common import LOWER, byte_view, pieces, ranges

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Chunks that a worker remembers between batches, and chunks given to the library at once.
REMEMBERED = 300_000
LIBRARY_BATCH = 20_000
WORDS_TOGETHER = 500

# Classes of bytes: 0 other, 1 ASCII white space, 2 ASCII letter, 3 ASCII punctuation but the apostrophe.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 1
KIND[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = 3
KIND[[c for c in range(33, 127) if chr(c).isalpha()]] = 2


def library(json_text: str):
    """A tokenizer of the library from its JSON, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_str(json_text)


def largest_id(json_text: str) -> int:
    """The largest id that a tokenizer may give, added tokens included."""
    tokenizer = json.loads(json_text)
    return max([*tokenizer["model"]["vocab"].values(), *(t["id"] for t in tokenizer["added_tokens"])])


class ChunkEncoder:
    """Encodes batches of texts: ``encode(texts) -> (ids, first id of each text)``.

    ``keeps_space``: the tokenizer is byte-level and white space is part of its
    pieces (a chunk starts at a single space between two ASCII characters that
    are not white space); otherwise white space only separates and is dropped,
    and ``lower`` says that the tokenizer folds ASCII case.
    """

    def __init__(self, json_text: str, keeps_space: bool, lower: bool = False):
        self.tokenizer = library(json_text)
        self.keeps_space, self.lower = keeps_space, lower
        self.known: dict[bytes, bytes] = {}
        self.word_like = np.zeros(256, bool)
        self.word_like[33:127] = True
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile(b"|".join(re.escape(a.encode()) for a in added)) if added else None
        suffix = json.loads(json_text)["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix:  # which ids end a word
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True

    def chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
        """(chunks, first chunk of each text, byte position of each chunk)."""
        n = len(data)
        if not n:
            return pieces(data, np.zeros(1, np.int64)), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
        raw = data
        if self.lower:  # but not where a mark may follow, which the library composes before it folds
            plain = np.ones(n, bool)
            plain[:-1] = data[1:] < 128
            data = np.where(plain, LOWER[data], data)
        kind = KIND[data]
        start = np.zeros(n, bool)
        before, here = kind[:-1], kind[1:]
        start[1:] = ((before == 2) & (here == 3)) | ((before == 3) & (here == 2))
        if self.keeps_space:
            plain = self.word_like[data]
            start[1:-1] |= (data[1:-1] == 32) & plain[:-2] & plain[2:]
            keep = None
        else:
            keep = kind != 1
            start[1:] |= (before == 1) & keep[1:]
        start[0] = True
        start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        for a, z in self.literals(raw, offsets):
            data = data.copy() if data is raw else data
            start[a:z], data[a:z] = False, raw[a:z]
            start[a] = True
            start[z:z + 1] = True
        if keep is None:
            at = np.flatnonzero(start)
            return pieces(data, np.append(at, n)), np.searchsorted(at, offsets), at
        start &= keep
        at = np.flatnonzero(start)
        cut = np.append(np.flatnonzero(start[keep]), int(keep.sum()))
        return pieces(data[keep], cut), np.searchsorted(at, offsets), at

    def literals(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Byte ranges of added tokens' strings, each inside one text."""
        if self.added is None:
            return []
        found = [m.span() for m in self.added.finditer(memoryview(data))]
        if not found:
            return found
        inside = lambda a, z: np.searchsorted(offsets, a, "right") == np.searchsorted(offsets, z, "left")
        if all(inside(a, z) for a, z in found):
            return found
        return [(int(o) + a, int(o) + z) for o, e in zip(offsets[:-1], offsets[1:])  # one crosses two texts
                for a, z in (m.span() for m in self.added.finditer(memoryview(data)[o:e]))]

    def words(self, chunks: list[bytes]) -> list[bytes] | None:
        """Ids of chunks that are one word each, encoded as one text; None if one isn't.

        Every word gives one id that ends a word, so as many of these as chunks prove it.
        """
        ids = np.asarray(self.tokenizer.encode_batch_fast([b" ".join(chunks).decode()], add_special_tokens=False)[0].ids, np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(chunks):
            return None
        flat, at = ids.tobytes(), (stops * 4).tolist()
        return [flat[a:z] for a, z in zip([0, *at[:-1]], at)]

    def table(self, vocabulary: list[bytes], extra: bool = False) -> list:
        """For each distinct chunk its ids (with ``extra``: and the offsets, in code points)."""
        out: list = [None] * len(vocabulary)
        missing = []
        for i, chunk in enumerate(vocabulary):
            hit = None if extra else self.known.get(chunk)
            if hit is None:
                missing.append(i)
            else:
                out[i] = hit
        if self.ends is not None and not extra:  # chunks of letters go together
            alone, together = [], []
            for i in missing:
                (together if vocabulary[i].decode().isalpha() else alone).append(i)
            for at in range(0, len(together), WORDS_TOGETHER):
                part = together[at: at + WORDS_TOGETHER]
                found = self.words([vocabulary[i] for i in part])
                if found is None:
                    alone += part
                    continue
                for i, ids in zip(part, found):
                    out[i] = ids
                if len(self.known) < REMEMBERED:
                    self.known.update((vocabulary[i], out[i]) for i in part)
            missing = alone
        encode = self.tokenizer.encode_batch if extra else self.tokenizer.encode_batch_fast
        for at in range(0, len(missing), LIBRARY_BATCH):
            part = missing[at: at + LIBRARY_BATCH]
            for i, e in zip(part, encode([vocabulary[i].decode() for i in part], add_special_tokens=False)):
                if extra:
                    out[i] = (e.ids, e.offsets)
                    continue
                out[i] = ids = np.asarray(e.ids, np.uint32).tobytes()
                if len(self.known) < REMEMBERED:
                    self.known[vocabulary[i]] = ids
        return out

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and the first id of each text (one entry more).

        ``end`` is appended to each text's ids.
        """
        data, offsets = byte_view(texts)
        chunks, docs, _ = self.chunks(data, offsets)
        words = chunks.dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        ids = self.table(words.dictionary.to_pylist())
        if end is not None:  # as one more chunk behind each text
            ids.append(np.asarray([end], np.uint32).tobytes())
            codes = np.insert(codes, docs[1:], len(ids) - 1)
            docs = docs + np.arange(len(docs))
        sizes = np.fromiter((len(i) >> 2 for i in ids), np.int64, len(ids))
        flat = np.frombuffer(b"".join(ids), np.uint32)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        counts = sizes[codes]
        total = np.concatenate([[0], np.cumsum(counts)])
        return flat[ranges(first[codes], counts)], total[docs]

    def encode_with_offsets(self, texts: pa.Array) -> list[tuple[list[int], list[int], list[int]]]:
        """Per text: ids and each token's first and last (exclusive) code point in the text.

        Tokens that share one character's bytes all carry that character.
        """
        data, offsets = byte_view(texts)
        chunks, docs, at = self.chunks(data, offsets)
        words = chunks.dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        known = self.table(words.dictionary.to_pylist(), extra=True)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
        out = []
        for d in range(len(docs) - 1):
            ids, starts, stops = [], [], []
            for c in range(docs[d], docs[d + 1]):
                base = int(lead[at[c]] - lead[offsets[d]])
                more, spans = known[codes[c]]
                ids += more
                starts += [base + a for a, _ in spans]
                stops += [base + b for _, b in spans]
            out.append((ids, starts, stops))
        return out
