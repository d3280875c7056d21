"""Ordered export: ranges of files and row groups from the footers, places as read, dates as text."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillmart.sources.export import as_text, export_table, read_in_order


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    df = spark.range(50_000).select(((F.col("id") * 7919) % 50_000).alias("k"), F.col("id").cast("string").alias("v"))
    return df, export_table(df.repartition(5), str(tmp_path_factory.mktemp("x")), "t", order_by=("k",), row_group_rows=1000, rows_per_file=9000)


def _groups(path):
    for file in sorted(glob.glob(f"{path}/*.parquet")):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            yield file, meta.row_group(g).num_rows, meta.row_group(g).column(0).statistics, meta.row_group(g).column(0).compression


def test_row_groups_are_counted_in_rows_and_ranges_follow_each_other(ordered):
    groups = list(_groups(ordered[1]))
    assert len({f for f, *_ in groups}) > 1 and max(n for _, n, *_ in groups) <= 1000 and {c for *_, c in groups} == {"SNAPPY"}
    ends = [(s.min, s.max) for _, _, s, _ in groups]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_a_range_filter_reads_few_rows(spark, ordered):
    df = spark.read.parquet(ordered[1]).where("k >= 49500")
    assert df.count() == 500
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    rows = df.collect()
    metrics = scan.metrics()
    assert len(rows) == 500 and "GreaterThanOrEqual(k,49500)" in df._jdf.queryExecution().executedPlan().toString()
    assert metrics.apply("numOutputRows").value() <= 1000


def test_places_are_those_of_the_order(spark, ordered):
    got = read_in_order(spark, ordered[1])
    assert got.where("position <> k").count() == 0 and got.count() == 50_000


def test_nulls_ties_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (2, "b"), (2, "c"), (None, "d"), (1, "e")], "k int, v string")
    path = export_table(df, str(tmp_path), "t", order_by=("k", "v"))
    assert [r["v"] for r in read_in_order(spark, path).orderBy("position").collect()] == ["a", "d", "e", "b", "c"]
    empty = export_table(df.limit(0), str(tmp_path), "empty", order_by=("k",))
    assert read_in_order(spark, empty).count() == 0


def test_text_keeps_nulls_and_the_word_none(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "None", 1.5, True), (None, None, None, None)], "d date, s string, n double, b boolean")
    assert [tuple(r) for r in as_text(df).collect()] == [("2024-01-02", "None", 1.5, True), (None, None, None, None)]
