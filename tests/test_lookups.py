"""Lookups and roll-ups of large dimensions: same rows as the plain joins, without moving the fact."""

import pytest
from pyspark.sql import functions as F

from quillmart.functions.keys import surrogate_key
from quillmart.operators import marts as M
from quillmart.operators.reports import dedupe_latest
from quillmart.plans import joins as J


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Every dimension counts as large, to Spark's planner too."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(J, "is_small", lambda df, max_bytes=0: False)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def moves(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_key_lookup_keeps_rows_in_place(spark, no_broadcast):
    dim = spark.createDataFrame([(i,) for i in (1, 2, 2, 2, 4)], "product_id long").withColumn("product_key", surrogate_key("product_id"))
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (4, "e"), (3, "f")], "product_id long, v string")
    plain = fact.join(dim, "product_id", "left")
    out = J.key_lookup(fact, dim, "product_id", "product_key")
    assert J.odd_ids(fact, dim, "product_id") is not None and moves(out) == 0 < moves(plain)
    order = lambda df: sorted(map(tuple, df.select("product_id", "v", "product_key").collect()), key=str)
    assert order(out) == order(plain) and len(order(out)) == 8
    assert J.odd_ids(fact, dim, "product_id", most=2) is None  # too many: joined plainly


def test_key_lookup_falls_back_when_odd_ids_are_many(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(J, "odd_ids", lambda *a, **k: None)
    dim = spark.createDataFrame([(1,), (1,)], "product_id long").withColumn("product_key", surrogate_key("product_id"))
    fact = spark.createDataFrame([(1,), (2,), (None,)], "product_id long")
    keys = [r.product_key for r in J.key_lookup(fact, dim, "product_id", "product_key").collect()]
    assert len(keys) == 4 and sum(k is None for k in keys) == 2


@pytest.mark.parametrize("large", [False, True])
def test_product_rollup_counts_orders_once(spark, monkeypatch, large):
    monkeypatch.setattr(M, "is_broadcast", lambda df: not large)
    dim = spark.createDataFrame([(1, "L"), (2, "L"), (3, "L"), (3, "L"), (4, "L"), (4, "M")], "product_id long, line string")
    fact = spark.createDataFrame(
        [("o1", 1, 10), ("o1", 2, 20), ("o2", 1, 5), ("o3", 3, 7), ("o4", 4, 1), ("o5", 9, 2), (None, 1, 3), ("o6", None, 4)],
        "order_id string, product_id long, n int").withColumn("amount", F.col("n").cast("decimal(18,2)"))
    got = M.product_rollup(fact, dim, ("line",), {"month": F.lit("x")}, {"amount": "revenue", "n": "units"}, "orders")
    rows = {r.line: (float(r.revenue), r.units, r.orders) for r in got.collect()}
    assert rows == {"L": (53.0, 53, 4), "M": (1.0, 1, 1), None: (6.0, 6, 2)}


def test_customer_rollup_counts_repeated_customers_each_time(spark):
    dim = spark.createDataFrame([(1,), (1,), (2,)], "customer_id long").withColumn("customer_key", surrogate_key("customer_id"))
    fact = spark.createDataFrame([("o1", 1, 5), ("o1", 1, 5), ("o2", 2, 3), ("o3", 7, 9), ("o4", None, 1)],
                                 "order_id string, customer_id long, net_units int").select(
        "*", F.lit("2000-01-15").cast("date").alias("order_date"), F.col("net_units").cast("decimal(18,2)").alias("final_net_revenue"))
    for f in (fact, fact.withColumn("customer_key", F.when(F.col("customer_id") < 7, surrogate_key("customer_id"))).drop("customer_id")):
        out = M.customer_rollup(f, dim, "month", {"last": F.col("order_date")}).collect()
        assert sorted((r.customer_id, r._orders, float(r._revenue), r._units) for r in out) == [(1, 1, 20.0, 20), (2, 1, 3.0, 3)]


def test_dedupe_latest_moves_each_column_once(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 2, "y"), (None, 1, "z")], "k string, t int, v string")
    out = dedupe_latest(rows, ["k"], ["t"])
    assert out.columns == rows.columns
    assert sorted(map(tuple, out.collect()), key=str) == [("a", 2, "y"), (None, 1, "z")]
    aggregate = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x)
    assert aggregate.count("named_struct") + aggregate.count("struct(") == 1
