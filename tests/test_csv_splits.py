"""CSV read in byte ranges: quoted line ends at every place of a split, bad records, headers."""

import csv
import io
import os
import random
import tempfile

import pytest

from quillmart.sources import csv_splits as CS


def _file(text, name="a.csv"):
    folder = tempfile.mkdtemp(prefix="qm-csv-")
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def _conf(spark, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, str(size))
    return before


@pytest.fixture
def small_splits(spark):
    before = _conf(spark, 700)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _read(spark, path, columns):
    return CS.scan(spark, CS.list_files(spark, path), columns)


def _want(text, columns):
    rows = list(csv.reader(io.StringIO(text, newline="")))
    head = rows[0]
    return sorted(tuple((r[head.index(c)] or None) if c in head else None for c in columns) for r in rows[1:] if r)


def _random_csv(seed, rows):
    rnd, out = random.Random(seed), io.StringIO(newline="")
    w = csv.writer(out, lineterminator="\r\n" if seed % 2 else "\n")
    w.writerow(["id", "note", "more"])
    pieces = ['a', 'b,c', '"', '""', '\n', '\n\n', ',"', '",', ' ', 'é', 'x' * 40, '"\n"', ',\n,']
    for i in range(rows):
        w.writerow([i, "".join(rnd.choices(pieces, k=rnd.randint(0, 6))), rnd.choice(["", "z", '"q"'])])
    return out.getvalue()


@pytest.mark.parametrize("seed", range(6))
def test_records_equal_a_plain_parser_however_the_file_is_split(spark, small_splits, seed):
    text = _random_csv(seed, 150)
    df = _read(spark, _file(text), ["id", "note", "more", "absent"])
    got = df.collect()
    assert all(r["_reason"] is None for r in got)
    norm = lambda v: v if v is None else v.replace("\r\n", "\n")
    want = [tuple(map(norm, r)) for r in _want(text, ["id", "note", "more", "absent"])]
    assert sorted(tuple(map(norm, r[:4])) for r in got) == want


def test_a_file_is_read_by_several_tasks(spark, small_splits):
    path = _file("id,note\n" + "".join(f'{i},"line {i}\nsecond"\n' for i in range(300)))
    lines = CS._lines(spark, [path])
    assert lines.select("block").distinct().count() > 5 and lines.rdd.getNumPartitions() > 5
    assert _read(spark, path, ["id", "note"]).where("note LIKE '%second'").count() == 300


def test_splits_without_any_proof_are_read_again(spark, small_splits):
    long = "\n".join(f"text {i}" for i in range(400))  # whole splits inside one value, no quote in them
    text = f'id,note\n1,"{long}"\n2,b\n' + "".join(f"{i},c\n" for i in range(3, 300))
    path = _file(text)
    rows = CS._written(CS._splits(CS._lines(spark, [path]), ["id", "note"], ["id", "note"]))
    assert CS.true_starts(rows).where("wrong").count() > 0
    got = {r["id"]: r["note"] for r in _read(spark, path, ["id", "note"]).collect()}
    assert got["1"] == long and got["2"] == "b" and len(got) == 299


def test_bad_records_are_kept_with_their_reason(spark, small_splits):
    for pad in (0, 300):  # one split, several splits
        text = "id,note\n" + "".join(f"{i},x\n" for i in range(pad)) + '7001,a,b\n7002\n7003,"a, b"\n7004,"never ends\n7005,x\n'
        rows = _read(spark, _file(text), ["id", "note"]).collect()
        bad = {r["_text"].rstrip("\n"): r["_reason"] for r in rows if r["_reason"]}
        assert bad == {"7001,a,b": "3 values for 2 columns", "7002": "1 values for 2 columns",
                       '7004,"never ends\n7005,x': "a quote never ends"}
        assert sorted(r["id"] for r in rows if not r["_reason"]) == sorted([*(str(i) for i in range(pad)), "7003"])


def test_headers_differ_and_files_may_be_empty(spark, small_splits):
    folder = os.path.dirname(_file("note,id\n" + "".join(f"n{i},{i}\n" for i in range(200)), "a.csv"))
    for name, text in (("b.csv", "﻿id,note,extra\n" + "".join(f"{i},n{i},e\n" for i in range(200, 400))),
                       ("c.csv", "id,note\n"), ("d.csv", ""), ("e.csv", "id\n900\n")):
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
    got = {r["id"]: r["note"] for r in _read(spark, f"{folder}/*.csv", ["id", "note"]).collect()}
    assert got == {**{str(i): f"n{i}" for i in range(400)}, "900": None}


def test_starts_need_proof():
    assert CS.starts_inside('a","b"\n') is True and CS.starts_inside('a,"b"\n') is False
    assert CS.starts_inside('x ""y"" z') is True and CS.starts_inside("no quotes\nat all") is None
    assert CS.starts_inside('","') is None
