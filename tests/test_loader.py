"""CSV drops: dated folders, static folder, missing files, bad folder names,
re-loads."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from quillmart.sources import csv_ingest as CI


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_dated_layout_skips_non_dates_and_takes_columns_by_name(spark):
    raw = tempfile.mkdtemp(prefix="qm-raw-")
    _write(f"{raw}/static/territories.csv", "territory_name,territory_id,extra\nT1,abc,zz\n")
    _write(f"{raw}/2024-03-15/returns.csv", "return_id,order_id,return_date,quantity_returned,reason\nr1,o1,2024-03-16,2,Damaged\n")
    _write(f"{raw}/2024-03-16/returns.csv", "order_id,return_id\no2,r2\n")
    _write(f"{raw}/not-a-date/returns.csv", "return_id,order_id\nbad,bad\n")
    st = CI.read_static(spark, raw)
    t = st["territories"].collect()
    assert [(r.territory_id, r.territory_name, r.country) for r in t] == [("abc", "T1", None)]
    assert st["products"].count() == 0  # missing file → empty, not an error
    r = {x.return_id: x for x in CI.read_dated(spark, raw, "returns").collect()}
    assert set(r) == {"r1", "r2"}
    assert r["r1"].load_date == dt.date(2024, 3, 15) and r["r2"].reason is None
    one = CI.read_dated(spark, raw, "returns", dt.date(2024, 3, 16)).collect()
    assert [x.return_id for x in one] == ["r2"]
    assert CI.read_dated(spark, raw, "orders").count() == 0


def test_write_daily_twice_is_idempotent(spark):
    raw = tempfile.mkdtemp(prefix="qm-raw-")
    df = spark.createDataFrame(
        [("r1", "o1", dt.date(2024, 1, 2), 1, "A"), ("r2", "o2", dt.date(2024, 1, 3), 2, "")],
        "return_id string, order_id string, return_date date, quantity_returned int, reason string")
    CI.write_daily(df, raw, "returns", "return_date")
    CI.write_daily(df, raw, "returns", "return_date")
    back = CI.read_daily(spark, raw, "returns", schema=df.schema)
    assert sorted((r.return_id, r.reason) for r in back.collect()) == [("r1", "A"), ("r2", None)]
    day = CI.read_daily(spark, raw, "returns", dt.date(2024, 1, 3), schema=df.schema)
    assert day.count() == 1


def test_observed_row_count(spark):
    from pyspark.sql import Observation
    raw = tempfile.mkdtemp(prefix="qm-raw-")
    _write(f"{raw}/static/reps.csv", "rep_id,rep_name\na,A\nb,B\n")
    obs = Observation("reps")
    df = CI.read_csv(spark, f"{raw}/static/reps.csv", "reps", observe=obs)
    df.write.format("noop").mode("overwrite").save()
    assert CI.load_counts({"reps": obs}) == {"reps": 2}


def test_export_all_reports_failures(spark):
    from quillmart.sources.export import export_all
    base = tempfile.mkdtemp(prefix="qm-exp-")
    good = spark.range(3)
    bad = spark.range(3).select(F.expr("raise_error('boom')").alias("x"))
    res = export_all({"a": good, "b": bad}, base, dt.date(2024, 1, 1))
    assert [n for n, _ in res["ok"]] == ["a"] and [n for n, _ in res["failed"]] == ["b"]
    assert spark.read.parquet(res["ok"][0][1]).count() == 3


def test_quotes_line_ends_and_blanks_survive_a_round_trip(spark):
    raw = tempfile.mkdtemp(prefix="qm-raw-")
    values = ['say "hi" now', 'say "hi", now', "two\nlines", "  pad ", "plain", "a,b", 'tail"', '""']
    df = spark.createDataFrame([(f"r{i}", "o", dt.date(2024, 1, 2), 1, v) for i, v in enumerate(values)],
                               "return_id string, order_id string, return_date date, quantity_returned int, reason string")
    CI.write_daily(df, raw, "returns", "return_date")
    assert sorted(r.reason for r in CI.read_daily(spark, raw, "returns").collect()) == sorted(values)
    CI.write_dated(df, raw, "returns", "return_date")
    CI.write_dated(df, raw, "returns", "return_date")
    assert sorted(r.reason for r in CI.read_dated(spark, raw, "returns").collect()) == sorted(values)
    _write(f"{raw}/2024-05-01/returns.csv", 'reason,"return_id"\n"say ""hi"" now",q1\n"x\ny",q2\n')
    assert {r.return_id: r.reason for r in CI.read_dated(spark, raw, "returns", dt.date(2024, 5, 1)).collect()} == {
        "q1": 'say "hi" now', "q2": "x\ny"}


def test_daily_drops_with_other_column_orders(spark):
    raw = tempfile.mkdtemp(prefix="qm-raw-")
    _write(f"{raw}/reps/load_date=2024-01-01/a.csv", "rep_id,rep_name\n1,A\n")
    _write(f"{raw}/reps/load_date=2024-01-02/a.csv", "rep_name,rep_id\nB,2\n")
    assert sorted((r.rep_id, r.rep_name) for r in CI.read_daily(spark, raw, "reps").collect()) == [("1", "A"), ("2", "B")]


def test_full_reload_to_empty_and_append_by_key(spark):
    raw = tempfile.mkdtemp(prefix="qm-raw-")
    df = spark.createDataFrame([("a", "A"), ("b", "B")], "rep_id string, rep_name string").selectExpr(
        "rep_id", "rep_name", "null territory_id", "null region", "null manager_name", "null hire_date", "null annual_quota")
    CI.write_static(df, raw, "reps")
    CI.append_static(df.unionByName(df.selectExpr("'c' rep_id", *[c for c in df.columns if c != "rep_id"])), raw, "reps")
    assert sorted(r.rep_id for r in CI.read_static(spark, raw)["reps"].collect()) == ["a", "b", "c"]
    CI.write_static(df.limit(0), raw, "reps")
    assert CI.read_static(spark, raw)["reps"].count() == 0


def test_counts_of_every_loader(spark):
    from pyspark.sql import Observation
    raw = tempfile.mkdtemp(prefix="qm-raw-")
    _write(f"{raw}/static/reps.csv", "rep_id\na\nb\n")
    _write(f"{raw}/2024-01-01/returns.csv", "return_id\nr1\n")
    _write(f"{raw}/returns/load_date=2024-01-01/p.csv", "return_id\nr1\nr2\nr3\n")
    obs = {n: Observation(n) for n in ("reps", "dated", "daily")}
    for df in (CI.read_static(spark, raw, observe=obs)["reps"], CI.read_dated(spark, raw, "returns", observe=obs["dated"]),
               CI.read_daily(spark, raw, "returns", observe=obs["daily"])):
        df.write.format("noop").mode("overwrite").save()
    assert CI.load_counts(obs) == {"reps": 2, "dated": 1, "daily": 3}
