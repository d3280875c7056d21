"""Committed states: a writer that dies at any step leaves the old or the new table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quillmart.operators import forecast as FC
from quillmart.sources import csv_ingest as CI
from quillmart.sources.manifest import LoadedTable
from quillmart.sources.versions import Conflict, VersionedTable, Versions
from quillmart.streaming.merge import KeyedTable, merge_stream

FORECAST = ("revenue_month date, product_line string, therapeutic_area string, revenue decimal(18,2), units_sold long, "
            "order_count long, is_forecast boolean, forecast_lower_bound decimal(14,2), forecast_upper_bound decimal(14,2)")


class Died(Exception):
    pass


def dying(monkeypatch, cls, name, before):
    """Let ``cls.name`` end the writer before or after its work."""
    true = getattr(cls, name)

    def die(self, *args, **kwargs):
        if not before:
            true(self, *args, **kwargs)
        raise Died(name)

    monkeypatch.setattr(cls, name, die)


STEPS = [(VersionedTable, "replace", True), (Versions, "new_folder", False), (Versions, "commit", True),
         (Versions, "_place", True), (Versions, "_place", False), (Versions, "vacuum", True), (Versions, "vacuum", False)]


def _forecast(spark, revenue):
    return spark.createDataFrame([(dt.date(2024, 1, 1), "A", None, revenue, None, None, True, None, None)],
                                 "revenue_month date, product_line string, therapeutic_area string, revenue int, "
                                 "units_sold long, order_count long, is_forecast boolean, forecast_lower_bound int, "
                                 "forecast_upper_bound int").select(
        *[F.col(f.split()[0]).cast(f.split(None, 1)[1]) for f in FORECAST.replace("(18,2)", "(18;2)").replace("(14,2)", "(14;2)").split(", ")
          for f in [f.replace(";", ",")]])


@pytest.mark.parametrize("cls,name,before", STEPS)
def test_forecast_write_that_dies(spark, tmp_path, monkeypatch, cls, name, before):
    path = str(tmp_path / "forecast")
    assert FC.write_forecast(spark, path, _forecast(spark, 1)) == 1
    with monkeypatch.context() as m:
        dying(m, cls, name, before)
        with pytest.raises(Died):
            FC.write_forecast(spark, path, _forecast(spark, 2))
    assert [int(r["revenue"]) for r in FC.read_forecast(spark, path).collect()] in ([1], [2])
    assert FC.write_forecast(spark, path, _forecast(spark, 3)) == 1  # the next run goes on
    assert [int(r["revenue"]) for r in FC.read_forecast(spark, path).collect()] == [3]
    assert FC.write_forecast(spark, path, _forecast(spark, 3).limit(0)) == 0
    assert FC.read_forecast(spark, path).count() == 1


@pytest.mark.parametrize("cls,name,before", STEPS[1:])
def test_static_reload_that_dies(spark, tmp_path, monkeypatch, cls, name, before):
    raw = str(tmp_path)
    rows = lambda n: spark.createDataFrame([(f"r{i}", f"n{n}") for i in range(n)], "rep_id string, rep_name string")
    CI.write_static(rows(2), raw, "reps")
    with monkeypatch.context() as m:
        dying(m, cls, name, before)
        with pytest.raises(Died):
            CI.write_static(rows(3), raw, "reps")
    back = CI.read_static(spark, raw)["reps"].collect()
    assert {(len(back), r["rep_name"]) for r in back} in ({(2, "n2")}, {(3, "n3")})


def test_appends_leave_nothing_beside(spark, tmp_path):
    raw = str(tmp_path)
    for n in range(1, 6):
        rows = spark.createDataFrame([(f"r{n}", "a"), (f"r{n}", "a"), ("r1", "late")], "rep_id string, rep_name string")
        for c in ("territory_id", "region", "manager_name", "hire_date", "annual_quota"):
            rows = rows.withColumn(c, F.lit(None).cast("string"))
        CI.append_static(rows, raw, "reps")
    back = CI.read_static(spark, raw)["reps"].collect()
    assert sorted(r["rep_id"] for r in back) == ["r1", "r2", "r3", "r4", "r5"]
    assert os.listdir(raw) == ["static"]
    assert len([f for f in os.listdir(tmp_path / "static/reps.csv") if f.startswith("data-")]) == 2  # and the state before


def test_two_writers_of_one_state(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    start = table.current()
    table.replace(spark.range(3), after=start)
    with pytest.raises(Conflict):
        table.replace(spark.range(5), after=start)
    assert table.read().count() == 3 and table.vacuum() == 1


# ---------------------------------------------------------------- keyed merge
ROW = "id long, v string, at int"


def test_merge_writes_touched_buckets_only_and_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], ["at"], buckets=8)
    assert table.read() is None
    table.merge(spark.createDataFrame([(i, "a", 1) for i in range(100)], ROW), 0)
    before = table.current()
    late = spark.createDataFrame([(7, "b", 2), (7, "c", 3), (7, "old", 0), (None, "n", 1)], ROW)
    touched = table.merge(late, 1)
    after = table.current()
    assert len(touched) <= 2 and {b for b in after.folders if after.folders[b] != before.folders.get(b)} == set(map(str, touched))
    assert table.merge(late, 1) == [] and table.current().number == after.number  # delivered again
    got = {r["id"]: r["v"] for r in table.read().collect()}
    assert len(got) == 101 and got[7] == "c" and got[8] == "a" and got[None] == "n"
    assert table.merge(late.limit(0), 2) == []


@pytest.mark.parametrize("name,before", [("commit", True), ("_place", True), ("_place", False)])
def test_merge_that_dies_is_repeated(spark, tmp_path, monkeypatch, name, before):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], ["at"], buckets=4)
    table.merge(spark.createDataFrame([(1, "a", 1), (2, "a", 1)], ROW), 0)
    late = spark.createDataFrame([(1, "b", 2), (3, "b", 2)], ROW)
    with monkeypatch.context() as m:
        dying(m, Versions, name, before)
        with pytest.raises(Died):
            table.merge(late, 1)
    table.merge(late, 1)
    assert sorted((r["id"], r["v"]) for r in table.read().collect()) == [(1, "b"), (2, "a"), (3, "b")]


def test_streamed_merge(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], ["at"], buckets=4)
    schema = spark.createDataFrame([], ROW).schema
    for part in ([(1, "a", 1), (2, "a", 1)], [(1, "b", 2), (2, "older", 0)]):
        spark.createDataFrame(part, ROW).write.mode("append").parquet(str(tmp_path / "drops"))
        merge_stream(table, str(tmp_path / "drops"), str(tmp_path / "checkpoint"), schema)
    assert sorted((r["id"], r["v"]) for r in table.read().collect()) == [(1, "b"), (2, "a")]


# ------------------------------------------------------------------ manifest
def _drop(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_loads_skip_replace_and_keep(spark, tmp_path):
    raw, schema = str(tmp_path / "raw"), CI.text_schema("returns")
    schema["quantity_returned"].dataType = spark.createDataFrame([], "q int").schema["q"].dataType
    head = "return_id,order_id,quantity_returned\n"
    pattern = f"{raw}/*/returns.csv"
    table = LoadedTable(spark, str(tmp_path / "loaded"), "returns", schema)
    assert table.load(pattern) == {"new": 0, "changed": 0, "same": 0, "missing": 0}  # no files at all
    assert table.rows().count() == 0 and table.manifest().count() == 0
    _drop(f"{raw}/a/returns.csv", head + "r1,o1,1\nr2,o2,2\n")
    _drop(f"{raw}/b/returns.csv", head + "r3,o3,3\nr4,o4,many\n")
    assert table.load(pattern)["new"] == 2
    assert table.load(pattern) == {"new": 0, "changed": 0, "same": 2, "missing": 0}
    assert sorted(r["return_id"] for r in table.rows().collect()) == ["r1", "r2", "r3"]
    assert [(r["column"], r["value"]) for r in table.rejects().collect()] == [("quantity_returned", "many")]
    _drop(f"{raw}/b/returns.csv", head + "r3,o3,30\nr4,o4,4\nr5,o5,5\n")
    _drop(f"{raw}/c/returns.csv", head)
    os.remove(f"{raw}/a/returns.csv")
    assert table.load(pattern) == {"new": 1, "changed": 1, "same": 0, "missing": 1}
    assert sorted((r["return_id"], r["quantity_returned"]) for r in table.rows().collect()) == [
        ("r1", 1), ("r2", 2), ("r3", 30), ("r4", 4), ("r5", 5)]
    assert table.rejects().count() == 0
    assert sorted((r["drop_path"].split("/")[-2], r["rows"], r["load"]) for r in table.manifest().collect()) == [
        ("a", 2, 1), ("b", 3, 2), ("c", 0, 2)]
    table.load(pattern, forget_missing=True)
    assert sorted(r["return_id"] for r in table.rows().collect()) == ["r3", "r4", "r5"]


def test_load_that_dies_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    raw, pattern = str(tmp_path / "raw"), str(tmp_path / "raw/*/returns.csv")
    table = LoadedTable(spark, str(tmp_path / "loaded"), "returns", CI.text_schema("returns"))
    _drop(f"{raw}/a/returns.csv", "return_id\nr1\n")
    table.load(pattern)
    _drop(f"{raw}/b/returns.csv", "return_id\nr2\n")
    with monkeypatch.context() as m:
        dying(m, Versions, "_place", True)
        with pytest.raises(Died):
            table.load(pattern)
    assert [r["return_id"] for r in table.rows().collect()] == ["r1"]
    assert table.load(pattern)["new"] == 1 and table.rows().count() == 2
