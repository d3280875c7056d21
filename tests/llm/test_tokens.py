import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillmart.llm import byte_bpe, queries, rollup, wavelet
from quillmart.llm.tokens import ChunkEncoder
from tests.llm import data

RANKS = byte_bpe.read_ranks(public_tokenizers.path(queries.MULTI_RANKS))
TRUE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WORD = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
BYTE = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_BPE))
ALPHABET = ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "J", "H", "\u030c", "\u0331", "İ", *"abcXYZ  \n\t'.,!-=_#09éßñÀ  　ΣςΩжあ😀́‍\x1c\x85<|>"]
TEXTS = st.lists(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join), max_size=5)


def arrow(texts):
    import pyarrow as pa
    return pa.array(texts, pa.string())


@pytest.fixture(scope="module")
def byte_encoder():
    return ChunkEncoder(byte_bpe.tokenizer_json(RANKS, public_tokenizers.PATTERN), keeps_space=True)


@pytest.fixture(scope="module")
def word_encoder():
    with open(public_tokenizers.path(queries.WORD_BPE), encoding="utf-8") as f:
        return ChunkEncoder(f.read(), keeps_space=False, lower=True)


def split(flat, first):
    return [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:])]


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_byte_bpe_equals_tiktoken(texts):
    enc = ChunkEncoder.__new__(ChunkEncoder)
    enc.__dict__.update(_BYTE.__dict__)
    assert split(*enc.encode(arrow(texts))) == [TRUE.encode_ordinary(t) for t in texts]


_BYTE = ChunkEncoder(byte_bpe.tokenizer_json(RANKS, public_tokenizers.PATTERN), keeps_space=True)
with open(public_tokenizers.path(queries.WORD_BPE), encoding="utf-8") as _f:
    _WORD = ChunkEncoder(_f.read(), keeps_space=False, lower=True)


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_word_bpe_equals_library(texts):
    assert split(*_WORD.encode(arrow(texts))) == [WORD.encode(t, add_special_tokens=False).ids for t in texts]


_GPT = ChunkEncoder(open(public_tokenizers.path(queries.BYTE_BPE), encoding="utf-8").read(), keeps_space=True)


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_byte_bpe_with_added_tokens_equals_library(texts):
    assert split(*_GPT.encode(arrow(texts))) == [BYTE.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_of_the_unmodified_library():
    for text, ids in (("x <|endoftext|> y", [343, 49407, 344]), ("J\u030cx", [329, 136, 490, 343])):
        assert split(*_WORD.encode(arrow([text, None]))) == [ids, []] == [WORD.encode(text, add_special_tokens=False).ids, []]
    two = ["a <|endof", "text|> b", "<|endoftext|><|endoftext|>", "x<|ENDOFTEXT|>y", "<|endoftext|>\u0301"]
    assert split(*_WORD.encode(arrow(two))) == [WORD.encode(t, add_special_tokens=False).ids for t in two]
    assert split(*_GPT.encode(arrow(two))) == [BYTE.encode(t, add_special_tokens=False).ids for t in two]


@given(st.text(alphabet="-=a. ", max_size=30))
@settings(max_examples=200, deadline=None)
def test_runs_merge_like_tiktoken(text):
    assert split(*_BYTE.encode(arrow([text]))) == [TRUE.encode_ordinary(text)]


def test_offsets_cover_the_text(byte_encoder):
    texts = ["naïve 😀 cafés, x's  y", "", "é" * 3]
    for text, (ids, starts, stops) in zip(texts, byte_encoder.encode_with_offsets(arrow(texts))):
        assert ids == TRUE.encode_ordinary(text)
        table = byte_bpe.byte_table(RANKS)
        for i, a, b in zip(ids, starts, stops):
            assert table[i] in text[a:b].encode()
        assert sorted({p for a, b in zip(starts, stops) for p in range(a, b)}) == list(range(len(text)))


def test_decoder_joins_split_characters():
    table = byte_bpe.byte_table(RANKS)
    ids = TRUE.encode_ordinary("😀é漢")
    d = byte_bpe.StreamDecoder(table)
    assert "".join(d.push([i]) for i in ids) + d.push([], final=True) == "😀é漢"
    assert byte_bpe.StreamDecoder(table).push(ids[:1], final=True).startswith("�")


def test_encode_decode_columns(spark):
    df = data.documents(spark, data.edge_rows(500)).withColumn("ids", F.lit("clash"))
    bpe = byte_bpe.ByteBPE(spark, RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode(bpe.encode(df, offsets=True)).collect()
    assert len(rows) == df.count()
    for r in rows:
        text = r["text"] or ""
        assert list(r["ids"]) == TRUE.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode() and r["decoded_text"] == text
        assert len(r["starts"]) == len(r["ids"])
    assert bpe.encode(df.limit(0)).count() == 0


def test_op8_query(spark, tmp_path):
    rows = data.edge_rows(2000)
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows))
    got = collections.Counter(map(tuple, queries.op8_byte_bpe(spark, sf).collect()))
    want = collections.Counter()
    for doc_id, text in rows:
        ids = TRUE.encode_ordinary(text or "")
        want[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want


def test_op5_query(spark, tmp_path):
    rows = [r for r in data.edge_rows(2000) if r[0] is not None and r != (4, "one")] + [(4, "one")]
    sf = data.write_tables(spark, tmp_path, documents=data.documents(spark, rows))
    got = {r["doc_id"]: r for r in queries.op5_wavelet_files(spark, sf).collect()}
    at = 0
    for doc_id, text in sorted(rows):
        ids = WORD.encode(text or "", add_special_tokens=False).ids + [1]
        r = got.pop(doc_id)
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc)
        at += len(ids)
    assert not got


def test_token_files_keep_ids_repeats_and_nulls(spark, tmp_path):
    rows = data.edge_rows(300)
    with open(public_tokenizers.path(queries.WORD_BPE), encoding="utf-8") as f:
        text = f.read()
    out = wavelet.token_files(spark, data.documents(spark, rows), text, 1, str(tmp_path / "files"), lower=True).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["ids"])) for r in out) == sorted(
        (d or -1, np.array(WORD.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for d, t in rows)
    out.sort(key=lambda r: r["start"])
    assert [r["doc_id"] or -1 for r in out] == sorted(d or -1 for d, _ in rows)
    assert sum(r["n_found"] for r in wavelet.find_token(spark, str(tmp_path / "files"), 1).collect()) == len(rows)
    none = data.documents(spark, [])
    assert wavelet.token_files(spark, none, text, 1, lower=True).count() == 0


@given(st.lists(st.integers(0, 37), max_size=700), st.integers(0, 40))
@settings(max_examples=60, deadline=None)
def test_wavelet_matrix(ids, value):
    m = wavelet.WaveletMatrix.build(np.array(ids, np.uint32), 6)
    assert m.all().tolist() == ids
    assert m.access(np.arange(len(ids))).tolist() == ids
    where = [i for i, x in enumerate(ids) if x == value]
    assert m.count(value) == len(where)
    assert m.occurrences(value).tolist() == where
    for stop in (0, 1, len(ids) // 2, 511, 512, len(ids)):
        stop = min(stop, len(ids))
        assert m.rank(value, stop) == sum(i < stop for i in where)


def test_op3_equals_recount(spark):
    got = {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"])
           for r in queries.op3_token_rollup(spark, data.SF).collect()}
    lib = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_BPE))
    seen, want = {}, collections.defaultdict(lambda: [0, 0])
    rows = spark.read.parquet(f"{data.SF}/documents.parquet").collect()
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        if r["text"] in seen:
            continue
        seen[r["text"]] = 1
        clean = re.sub(r"\n{2,}", "\n", re.sub(r"[ \t]+(\n|$)", r"\1", r["text"] or ""))
        n = len(lib.encode(clean, add_special_tokens=False).ids)
        if n:
            want[r["source"], r["lang"]][0] += 1
            want[r["source"], r["lang"]][1] += n
    assert got == {k: tuple(v) for k, v in want.items()}


def test_ledger_is_idempotent_and_signed(spark):
    def changes(*rows):
        return spark.createDataFrame(
            rows, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, op string, seq int")

    ledger = rollup.TokenLedger(spark)
    assert ledger.totals().count() == 0
    assert ledger.commit(1, changes((1, "a", "en", "v", 10, "insert", 0), (2, "a", "en", "v", 5, "insert", 0),
                                    (None, None, None, "v", None, "insert", 0)))
    assert ledger.commit(2, changes((1, "b", "en", "v", 7, "revise", 1), (1, "b", "en", "v", 9, "revise", 2),
                                    (2, "a", "en", "v", 0, "delete", 0), (3, "a", "en", "v", 0, "delete", 0)))
    assert not ledger.commit(2, changes((1, "b", "en", "v", 100, "revise", 9)))
    assert ledger.commit(3, changes().limit(0))
    got = {(r["source"], r["lang"], r["tokenizer_version"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}
    assert got == {("b", "en", "v"): (1, 9), (None, None, "v"): (1, 0)}


CHANGE = "doc_id long, source string, lang string, tokenizer_version string, n_tokens long, op string, seq int"


def test_a_small_batch_reads_and_writes_its_own_buckets(spark):
    ledger = rollup.TokenLedger(spark, buckets=50)
    ledger.commit(1, spark.createDataFrame([(i, f"s{i % 3}", "en", "v", i, "insert", 0) for i in range(2000)], CHANGE))
    before, read = ledger.states.current(), []
    true = ledger._read
    ledger._read = lambda schema, state, parts: read.append(set(parts)) or true(schema, state, parts)
    ledger.commit(2, spark.createDataFrame([(7, "s9", "de", "v", 1000, "revise", 0), (8, None, None, "v", 0, "delete", 0)], CHANGE))
    ledger._read = true
    after = ledger.states.current()
    changed = {p for p in before.folders if p.startswith("bucket-") and before.folders[p] != after.folders.get(p)}
    assert 1 <= len(changed) <= 2 and set().union(*read) == changed | {"totals"}
    got = {r["source"]: (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}
    want = {f"s{k}": (len(v), sum(v)) for k in range(3) if (v := [i for i in range(2000) if i % 3 == k and i not in (7, 8)])}
    assert got == {**want, "s9": (1, 1000)}
    held = ledger.documents().groupBy("source").agg(F.count("*"), F.sum("n_tokens")).collect()
    assert got == {r[0]: (r[1], r[2]) for r in held}
    signed = ledger.ledger().groupBy("source").agg(F.sum("d_docs"), F.sum("d_tokens")).collect()
    assert got == {r[0]: (r[1], r[2]) for r in signed if r[1]}


def test_a_commit_that_dies_changes_nothing(spark, monkeypatch):
    ledger = rollup.TokenLedger(spark, buckets=4)
    ledger.commit(1, spark.createDataFrame([(1, "a", "en", "v", 10, "insert", 0)], CHANGE))
    batch = spark.createDataFrame([(1, "a", "en", "v", 4, "revise", 0), (2, "a", "en", "v", 5, "insert", 0)], CHANGE)
    with monkeypatch.context() as m:
        def die(*args):
            raise RuntimeError("died")
        m.setattr(type(ledger.states), "_place", die)
        with pytest.raises(RuntimeError, match="died"):
            ledger.commit(2, batch)
    assert [tuple(r)[3:] for r in ledger.totals().collect()] == [(1, 10)] and not ledger.committed(2)
    assert ledger.commit(2, batch) and not ledger.commit(2, batch)
    assert [tuple(r)[3:] for r in ledger.totals().collect()] == [(2, 9)]
