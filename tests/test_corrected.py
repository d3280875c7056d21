"""Corrected marts on small facts, and dirty text."""

import datetime as dt

from pyspark.sql import functions as F

from quillmart.operators.marts import customer_months
from quillmart.operators.mrr import customer_base
from quillmart.sources import csv_ingest as CI

FACT = "customer_key string, order_id string, order_date date, final_net_revenue decimal(18,2), net_units long"
MRR = ("customer_id long, event_month date, event_type string, mrr_amount decimal(14,2), mrr_added decimal(18,2), "
       "mrr_lost decimal(18,2), is_new boolean, is_churned boolean, is_reactivated boolean, is_expansion boolean")
D = dt.date


def _mrr(spark, rows):
    full = []
    for c, month, kind, amount in rows:
        full.append((c, month, kind, amount, amount if kind in ("new", "reactivation", "expansion") else 0,
                     -amount if kind == "churn" else 0, kind == "new", kind == "churn", kind == "reactivation", kind == "expansion"))
    cols = [f.split() for f in MRR.split(", ")]
    df = spark.createDataFrame([tuple(float(v) if i in (3, 4, 5) and v is not None else v for i, v in enumerate(r)) for r in full],
                               "customer_id long, event_month date, event_type string, mrr_amount double, mrr_added double, "
                               "mrr_lost double, is_new boolean, is_churned boolean, is_reactivated boolean, is_expansion boolean")
    return df.select(*[F.col(n).cast(t) for n, t in cols])


def test_months_without_orders_stay_and_recency_is_the_customers(spark):
    dim = spark.createDataFrame([("k1", 1, "A", "s", "t", "r", True), ("k2", 2, "B", "s", "t", "r", True)],
                                "customer_key string, customer_id long, account_name string, segment string, tier string, region string, is_active boolean")
    fact = spark.createDataFrame([("k1", "o1", D(2024, 1, 5), 10.0, 1), ("k1", "o2", D(2024, 3, 1), 5.0, 1), ("k1", "o3", D(2025, 1, 1), 1.0, 1)],
                                 FACT.replace("decimal(18,2)", "double")).withColumn("final_net_revenue", F.col("final_net_revenue").cast("decimal(18,2)"))
    got = {(r["customer_id"], r["report_month"]): r for r in customer_months(
        fact, _mrr(spark, [(1, D(2024, 1, 1), "new", 10), (1, D(2024, 2, 1), "churn", -10)]), dim, as_of=D(2024, 3, 31)).collect()}
    assert set(got) == {(1, D(2024, 1, 1)), (1, D(2024, 2, 1)), (1, D(2024, 3, 1)), (1, D(2025, 1, 1)), (2, None)}
    feb = got[1, D(2024, 2, 1)]
    assert feb["is_churned"] and feb["order_count"] == 0 and feb["mrr_lost"] == 10 and feb["value_to_date"] == 10
    assert {r["days_since_latest_order"] for (c, _), r in got.items() if c == 1} == {30}
    assert got[1, D(2024, 3, 1)]["value_to_date"] == 15 and feb["lifetime_value"] == 16


def test_base_counts_customers_between_events(spark):
    events = _mrr(spark, [(1, D(2024, 1, 1), "new", 10), (2, D(2024, 1, 1), "new", 4), (1, D(2024, 4, 1), "churn", -10),
                          (1, D(2024, 5, 1), "reactivation", 3), (2, D(2024, 5, 1), "expansion", 1)])
    got = [tuple(r) for r in customer_base(events).orderBy("month").select(
        "month", "joined_customers", "lost_customers", "opening_customers", "closing_customers", "churn_rate_pct", "mrr").collect()]
    show = [(m.month, j, lost, o, c, None if r is None else float(r), float(mrr)) for m, j, lost, o, c, r, mrr in got]
    assert show == [(1, 2, 0, 0, 2, None, 14), (2, 0, 0, 2, 2, 0, 14), (3, 0, 0, 2, 2, 0, 14), (4, 0, 1, 2, 1, 50, 4), (5, 1, 0, 1, 2, 0, 8)]
    assert customer_base(events.limit(0)).count() == 0


def test_dirty_rows_go_to_the_rejects(spark, tmp_path):
    schema = spark.createDataFrame([], "return_id string, order_id string, return_date date, quantity_returned int, reason string").schema
    (tmp_path / "r.csv").write_text("return_id,order_id,return_date,quantity_returned,reason\n"
                                    "r1,o1,2024-02-30,two,x\nr2,o2, 2024-02-28 ,2,\nr3,o3,,,\nr4,o4\n")
    clean, rejects = CI.load_checked(spark, str(tmp_path / "r.csv"), "returns", schema)
    assert sorted((r["return_id"], r["return_date"], r["quantity_returned"]) for r in clean.collect()) == [
        ("r2", D(2024, 2, 28), 2), ("r3", None, None)]
    assert sorted((r["column"] or "", r["value"], r["reason"]) for r in rejects.collect()) == [
        ("", "r4,o4", "2 values for 5 columns"), ("quantity_returned", "two", "not a value of type int"),
        ("return_date", "2024-02-30", "not a value of type date")]
    assert CI.load_checked(spark, str(tmp_path / "absent.csv"), "returns", schema)[0].count() == 0
