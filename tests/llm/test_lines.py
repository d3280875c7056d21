import hashlib

import pytest
from pyspark.sql import functions as F

from quillmart.llm import lines
from tests.llm import data

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=10, min_docs=2):
    """[(doc_id, lines, dropped, kept text)]"""
    key = lambda line: data.lower(line.strip(BLANKS))
    holders = {}
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(d)
    keeper = {k: min((d for d in v if d is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, t, *_ in rows:
        parts = (t or "").split("\n")
        kept = [p for p in parts if key(p) not in keeper or keeper[key(p)] == d]
        out.append((d, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def check(spark, rows, **options):
    df = data.documents(spark, rows)
    got = [tuple(r) for r in lines.dedup_lines(df, **options).collect()]
    want = brute(rows, **options)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(want, key=order)
    digests = [tuple(r) for r in lines.dedup_lines(df, digest=True, **options).collect()]
    assert sorted(digests, key=order) == sorted(
        [(d, n, x, hashlib.sha256(k.encode()).hexdigest()) for d, n, x, k in want], key=order)


SHARED = "A license line of some length"
ROWS = [
    (3, f"own text of three\n  {SHARED.upper()}\t\nshort\n\n{SHARED}"), (1, f"{SHARED}\nown text of one\nshort"),
    (2, f"\x0b{SHARED}\r\nshort\nÀ LINE WITH ACCENTS"), (4, "à line with accents\nÀ line with accents"),
    (5, None), (6, ""), (7, "\n\n"), (8, "ninechars\nten chars!"), (9, "ninechars\nTEN CHARS!\nten chars!"),
    (None, f"{SHARED}\nonly without id"), (None, "only without id\nonly without id"), (10, "a" * 10 + "\n" + "a" * 11),
    (11, "same id, twice\nfirst"), (11, "second\nsame id, twice"), (12, "Same ID, twice"), (13, "é" * 9 + "\n" + "é" * 10), (14, "é" * 9 + "\n" + "é" * 10),
]


@pytest.mark.parametrize("options", [{}, {"min_docs": 3}, {"min_chars": 5}, {"min_docs": 1, "min_chars": 3}])
def test_equals_brute_force(spark, options):
    check(spark, ROWS, **options)


def test_edge_rows_repeated_rows_and_no_rows(spark):
    check(spark, data.edge_rows(2000) + ROWS[:4] * 3)
    assert lines.dedup_lines(data.documents(spark, []), digest=True).count() == 0


def test_long_texts_of_many_lines(spark):
    long = "\n".join(f"line number {i % 4000} of this text" for i in range(9000))
    check(spark, [(1, long), (2, long[: len(long) // 2]), (3, "line number 17 of this text"), (4, "x" * 200_000)])


def test_other_columns_are_ignored(spark):
    df = data.documents(spark, ROWS)
    odd = df.select("*", F.lit(1).alias("keeper"), F.lit("x").alias("H1"), F.lit(2).alias("version"), F.lit(3).alias("pos"))
    assert sorted(map(str, lines.dedup_lines(odd).collect())) == sorted(map(str, lines.dedup_lines(df).collect()))


def test_hot_hashes_meet_between_plain_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        occurrences = lines.keyed_lines(data.documents(spark, ROWS))
        plan = occurrences.join(lines.shared_keys(occurrences), ["h1", "h2"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # pairs, counts, and each side of the join
    assert plan.count("Exchange hashpartitioning") == 4
