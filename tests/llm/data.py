"""Rows and brute-force helpers for the tests of the training-data operators."""

import os
import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def write_tables(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(os.path.join(str(folder), f"{name}.parquet"))
    return str(folder)


def edge_rows(long_words=30_000):
    """Nulls, empty and blank texts, repeated rows, odd characters and a very long text."""
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (4, "one"), (None, "a row without id"),
        (5, "naïve — café 😀 'tis x's y z ÀÉ 123 a1b2!!?"), (6, "a\r\nb\x0b\x0cc\x85d\x1ce"),
        (7, " ".join(f"word{i % 97} the" for i in range(long_words))), (8, "ſecret token='abcdefghijklmnop' K"),
        (9, "İstanbul ΣΑΣ. ΟΔΟΣ"), (10, "é combining ́ mark"), (11, "<|endoftext|> literal <|startoftext|>"),
    ]
