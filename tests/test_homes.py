"""Rows that lie by their order stay there: joins beside them, lookups of large dimensions, distinct counts."""

import pytest
from pyspark.sql import functions as F

from quillmart.plans import joins as J
from quillmart.plans.joins import HOME
from quillmart.plans.registry import QUERIES
from quillmart.plans.warehouse import Warehouse
from quillmart.sources import adapter

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(J, "is_small", lambda df, *a, **k: bool({"date_day", "territory_id"} & set(df.columns)))
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moved_by(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1].split(")")[0] for line in text.split("\n") if "hashpartitioning(" in line]


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_fact_and_mart_rows_move_once(spark, no_broadcast):
    """Before: by order key, by order id, and by each dimension."""
    w = Warehouse(spark, SF)
    for df in (w.fact_sales, w.sales_performance()):
        assert not [k for k in moved_by(df) if "order_id" in k or k.startswith(HOME) and k.count(",") > 1]
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet [l_orderkey") + plan.count("o_orderkey") > 0 and "Window [collect_list(_right" in plan


def test_mart_equals_the_broadcast_one(spark, no_broadcast):
    lazy = Warehouse(spark, SF).sales_performance()
    assert "_right" in lazy._jdf.queryExecution().analyzed().toString()
    got = sorted(map(str, lazy.collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(str, QUERIES["sales_performance"](spark, SF).collect()))


def test_near_lookup_equals_the_plain_join(spark, no_broadcast):
    left = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "c"), (2, 12, "d"), (2, None, "e"), (3, 10, "f")],
                                 f"{HOME} long, product_id long, v string")
    dim = spark.createDataFrame([(10, "x"), (11, "y"), (11, "y"), (11, "z"), (13, "u"), (None, "n")], "product_id long, name string")
    plain = left.join(dim, "product_id", "left")
    used = left.select(HOME, "product_id").union(spark.createDataFrame([(9, 13)], "a long, b long"))
    for near in (J.near_lookup(left, dim, "product_id"), J.near_lookup(left, dim, "product_id", used)):
        assert rows(near, HOME, "product_id", "v", "name") == rows(plain, HOME, "product_id", "v", "name")


def test_home_join_repeats_rows_and_moves_none(spark, no_broadcast):
    left = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, None, 7), (2, "b", 8)], f"{HOME} long, order_id string, q int").repartition(HOME)
    right = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (3, "b", 4)], f"{HOME} long, order_id string, n int").repartition(HOME)
    out = J.home_join(left, right, "order_id")
    assert rows(out, "order_id", "q", "n") == rows(left.join(right, [HOME, "order_id"], "left"), "order_id", "q", "n")
    assert len(moved_by(out)) == 2


def test_equal_order_ids_have_equal_homes(spark, tmp_path):
    """Also where one line lacks its order key and another its number: their texts are the same."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet").limit(1)
    null = F.lit(None)
    a = li.withColumns({"l_orderkey": null.cast("bigint"), "l_linenumber": F.lit(7)})
    b = li.withColumns({"l_orderkey": F.lit(7).cast("bigint"), "l_linenumber": null.cast("int")})
    c = li.withColumns({k: null.cast("bigint") for k in ("l_orderkey", "l_partkey", "l_suppkey")} | {"l_linenumber": null.cast("int")})
    a.unionByName(b).unionByName(c).write.parquet(str(tmp_path / "lineitem.parquet"))
    for t in ("orders", "supplier"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    found = adapter.order_lines(spark, str(tmp_path)).groupBy("order_id").agg(F.collect_set(HOME).alias("h"), F.count("*").alias("n")).collect()
    assert sorted((r["h"], r["n"]) for r in found) == [([0], 1), ([7], 2)]


def test_written_sales_move_once_to_large_dimensions(spark, no_broadcast, tmp_path):
    from quillmart.plans.catalog import materialize_silver
    w = Warehouse(spark, SF)
    catalog, _ = materialize_silver(w, str(tmp_path), buckets=3)
    assert len(catalog.table("fact_sales").inputFiles()) <= 3  # a file per bucket: written as they lay
    mart = w.sales_performance()
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [collect_list(_right") == 3 and not [k for k in moved_by(mart) if k.startswith(HOME) and k.count(",") > 1]
    assert rows(mart, *mart.columns) == rows(Warehouse(spark, SF).sales_performance(), *mart.columns)
    assert HOME not in w.fact_sales.columns


def test_uniqueness_is_counted_where_rows_lie(spark):
    from quillmart.operators import quality as QC
    checks = [("order_id", "unique", None), ("sales_key", "unique", None), ("n", "not_null", None)]
    df = spark.createDataFrame([(1, "a", "A", 1), (1, "a", "A", None), (2, "b", "B", 3), (3, None, None, 4), (4, None, None, 5)],
                               f"{HOME} long, order_id string, sales_key string, n int")
    for some in (checks, [checks[0], checks[2]]):
        near = QC.dq_table(df.repartition(HOME), "t", some)
        assert sorted(map(tuple, near.collect())) == sorted(map(tuple, QC.dq_table(df.drop(HOME), "t", some).collect()))
        assert not [k for k in moved_by(near) if "value" in k]  # before: every value was moved
