"""Queries that move, write or compute less than they did: the plans and files that this rests on."""

import os

from pyspark.sql import functions as F

from quillmart.operators import quality as QC
from quillmart.plans.catalog import materialize_silver
from quillmart.plans.registry import QUERIES
from quillmart.plans.warehouse import Warehouse
from quillmart.sources import csv_ingest as CI
from quillmart.sources import csv_splits as CS
from quillmart.sources import dirty
from quillmart.streaming.merge import KeyedTable

SF = "/root/testdata/sf0.001"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_costs_and_their_revenue_read_the_lines_once(spark):
    for name in ("cogs_margin", "dq_margin_bounds"):
        assert optimized(QUERIES[name](spark, SF)).count("l_extendedprice#") >= 1
        assert executed(QUERIES[name](spark, SF)).split("Initial Plan")[-1].count("lineitem.parquet") == 1, name


def test_costs_with_revenue_equal_costs_joined_to_it(spark):
    from quillmart.operators import facts as FX
    w = Warehouse(spark, SF)
    joined = FX.fact_cogs(w.stg["costs"], w.stg["orders"], w.dims)
    assert sorted(map(str, w.fact_cogs.collect())) == sorted(map(str, joined.collect()))


def test_margin_is_computed_once(spark):
    fact = spark.createDataFrame([(1, 3, 1, "2000-01-01"), (2, 1, 3, "2000-01-01"), (3, None, 1, "2000-01-01")],
                                 "product_id long, a int, b int, cost_month string")
    fact = fact.withColumn("gross_margin_pct", F.round(F.col("a") * 100 / (F.col("b") + F.length("cost_month") * 0)))
    bad = QC.margin_out_of_bounds(fact)
    assert [r["product_id"] for r in bad.collect()] == [1]
    assert optimized(bad).count("length(") == 1  # before: in the filter and in the projection


def test_sales_of_the_written_layer_keep_their_ids(spark, tmp_path):
    w = Warehouse(spark, SF)
    catalog, _ = materialize_silver(w, str(tmp_path), buckets=3)
    assert {"product_id", "customer_id"} <= set(w.sales.columns) and "customer_id" not in w.fact_sales.columns
    assert all(".zstd." in f for f in catalog.table("fact_sales").inputFiles())


def test_merge_writes_its_rows_once_and_without_a_copy_of_the_batch(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], ["at"], buckets=2)
    made = []
    table.new_folder = lambda: made.append(f"data-{len(made)}") or made[-1]
    table.merge(spark.createDataFrame([(i, "a", 1) for i in range(50)], "id long, v string, at int"), 0)
    assert len(made) == 1 and table.read().count() == 50


def test_restated_orders_come_from_returned_lines_only(spark):
    restated = Warehouse(spark, SF).order_deliveries.where("_loaded_at > TIMESTAMP_NTZ '2001-01-01 01:30:00'")
    assert optimized(restated).count("(l_returnflag") >= 2


def test_second_increment_reads_the_first_drop(spark):
    rows = QUERIES["incremental_twice"](spark, SF)
    assert rows.count() == Warehouse(spark, SF).order_deliveries.count()
    assert all(".zstd." in f for f in rows.inputFiles())


def test_whole_files_beyond_the_opening_cost_are_read_without_a_copy(spark):
    assert CS.uncut_bytes(spark, [100]) == CS._bytes(spark, "spark.sql.files.openCostInBytes")
    most = CS._bytes(spark, "spark.sql.files.maxPartitionBytes")
    cores = CS.CORES_MORE * spark.sparkContext.defaultParallelism
    assert CS.uncut_bytes(spark, [most] * cores) == most
    assert CS.uncut_bytes(spark, [most + 1] * cores) < most  # they are cut, and the rest is nothing


def test_a_cut_file_ends_the_read_that_takes_it_whole(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w") as f:
        f.write("a\n" + "1\n" * 2000)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    lines = CS._lines(spark, [path], uncut=True)
    assert lines.count() == 2001
    try:
        for k in keys:
            spark.conf.set(k, "700")
        try:
            CS._lines(spark, [path], uncut=True).collect()
        except Exception as e:
            assert "was split" in str(e)
        else:
            raise AssertionError("a cut file was read as a whole one")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_drops_are_cut_into_files_of_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(CI, "FILE_RECORDS", 10)
    rows = spark.range(35).select(F.col("id").cast("string").alias("return_id"), F.lit("1997-01-02").cast("date").alias("return_date"))
    CI.write_daily(rows, str(tmp_path), "returns", "return_date")
    folder = os.path.join(str(tmp_path), "returns", "load_date=1997-01-02")
    assert len([f for f in os.listdir(folder) if f.startswith("part-")]) >= 4
    assert CI.read_daily(spark, str(tmp_path), "returns").count() == 35


def test_dirty_values_are_cast_once_and_blanks_are_empty(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    rows = spark.createDataFrame([("1", "x", "f", None, None), (" ", "y", "f", None, None), ("z", None, "f", None, None),
                                  (None, None, "f", "t", "why"), (" 2 ", "", "f", None, None)],
                                 "a string, b string, _file string, _text string, _reason string")
    got = dirty.checked(rows, schema)
    assert optimized(got.where("a = 1 OR size(_errors) >= 0")).count("cast(") >= 1
    assert sorted(map(tuple, dirty.clean(got).collect()), key=str) == sorted([(1, "x", "f"), (None, "y", "f"), (2, "", "f")], key=str)
    assert sorted((r["column"], r["value"], r["reason"]) for r in dirty.rejects(got).where("column IS NOT NULL").collect()) == [
        ("a", "z", "not a value of type int")]
    assert [r["value"] for r in dirty.rejects(got).where("column IS NULL").collect()] == ["t"]


def test_unique_texts_move_as_digests(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, n int")
    checks = [("k", "unique", None), ("n", "not_null", None)]
    report = QC.dq_table(df, "t", checks)
    assert {(r["check_name"], r["violations"]) for r in report.collect()} == {("unique", 1), ("not_null", 0)}
    assert "unhex" in optimized(QC.dq_table(spark.range(5).select(F.col("id").cast("string").alias("k")), "t", checks[:1]))
