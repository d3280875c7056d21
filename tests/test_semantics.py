"""Hand-made rows for each edge case the models must keep (nulls, zero
denominators, fan-out, preserved sides, calendar boundaries)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quillmart.constants import RAW_COLUMNS
from quillmart.plans.warehouse import Warehouse

D = dt.date
AS_OF = D(2024, 3, 31)


def _raw(spark, table, rows):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], schema)


@pytest.fixture(scope="module")
def wh(spark):
    raw = {
        "territories": _raw(spark, "territories", [("t1", "North", "R1", "US", "Z1")]),
        "products": _raw(spark, "products", [
            ("p1", " P-1 ", "Drug", "Onc", "Biologics", "Tablet", "2020-01-01", "10.00"),
            ("p2", "P-2", "Other", "Neu", None, "Cream", "2021-05-01", "5.00")]),
        "customers": _raw(spark, "customers", [
            ("c1", " Acme ", "Hospital", " A ", "R1", "t1", "2023-01-01", "  ", " YES "),
            ("c2", "Beta", "Clinic", "B", "R1", "t1", "2023-06-01", "2023-12-31", "1"),
            ("c3", "Gamma", "Pharmacy", "C", "R1", "t1", "2023-01-01", None, "no"),
            ("c4", "Delta", "Pharmacy", "C", "R1", "t1", "2023-01-01", None, None)]),
        "reps": _raw(spark, "reps", [
            ("r1", "Ann", "t1", "R1", "Boss", "2020-01-01", "365000.00"),
            ("r2", "Bob", "t1", "R1", "Boss", "2020-01-01", "0.00")]),
        "orders": _raw(spark, "orders", [
            ("o1", "2024-01-10", "p1", "c1", "r1", "t1", 10, "100.00", "0.100000", "90.00", "1000.00", "900.00"),
            ("o2", "2024-02-10", "p1", "c1", "r2", "t1", 5, "100.00", "0.100000", "90.00", "500.00", "450.00"),
            ("o3", "2024-02-11", "pX", "c2", "r1", "t1", 1, "10.00", "0.000000", "10.00", "10.00", "10.00"),
            (None, "2024-02-12", "p1", "c1", "r1", "t1", 1, "1.00", "0", "1.00", "1.00", "1.00"),
            ("o5", None, "p1", "c1", "r1", "t1", 1, "1.00", "0", "1.00", "1.00", "1.00")]),
        "returns": _raw(spark, "returns", [
            ("x1", "o1", "2024-03-01", 2, " Damaged packaging "),
            ("x2", "o1", "2024-03-05", 3, "Expired stock")]),
        "costs": _raw(spark, "costs", [
            ("k1", "p1", "2024-01-01", "0.00", "60.00"),
            ("k2", "p1", "2024-03-01", "60.00", "66.00")]),
        "mrr_events": _raw(spark, "mrr_events", [
            ("e1", "c1", "p1", "2024-01-01", "new", "100.00"),
            ("e2", "c1", "p1", "2024-02-01", "contraction", "-20.00"),
            ("e3", "c2", "p1", "2024-02-01", "new", "50.00"),
            ("e4", "c2", "p1", "2024-03-01", "churn", "-50.00")]),
    }
    return Warehouse(spark, "", as_of=AS_OF, spine=(D(2023, 1, 1), D(2025, 1, 1)), raw=raw)


def rows(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_null_key_or_date_dropped(wh):
    assert rows(wh.stg["orders"], "order_id") == {("o1",), ("o2",), ("o3",)}


def test_customer_text_rules(wh):
    got = {r.customer_id: r for r in wh.stg["customers"].collect()}
    assert got["c1"].is_active is True and got["c2"].is_active is True
    assert got["c3"].is_active is False and got["c4"].is_active is False
    assert got["c1"].contract_end_date is None
    assert got["c1"].account_name == "Acme" and got["c1"].tier == "A"


def test_zero_standard_cost_gives_null_variance_pct(wh):
    got = {r.cost_id: r.cost_variance_pct for r in wh.stg["costs"].collect()}
    assert got["k1"] is None
    assert got["k2"] == Decimal("10.0000")


def test_two_returns_summed_without_fan_out(wh):
    f = {r.order_id: r for r in wh.fact_sales.collect()}
    assert len(f) == 3
    assert f["o1"].units_returned == 5 and f["o1"].net_units == 5
    assert f["o1"].returned_revenue == Decimal("450.00")
    assert f["o1"].final_net_revenue == Decimal("450.00")


def test_unknown_product_keeps_row_with_null_key(wh):
    f = {r.order_id: r for r in wh.fact_sales.collect()}
    assert f["o3"].product_key is None and f["o3"].customer_key is not None


def test_zero_quota_gives_zero_attainment(wh):
    f = {r.order_id: r for r in wh.fact_sales.collect()}
    assert f["o2"].daily_quota_attainment_pct == Decimal("0.00")
    # 900 / round(365000/365, 2) * 100 = 90.00
    assert f["o1"].daily_quota_attainment_pct == Decimal("90.00")


def test_cogs_preserves_cost_rows_only(wh):
    c = {r.cost_month: r for r in wh.fact_cogs.collect()}
    assert set(c) == {D(2024, 1, 1), D(2024, 3, 1)}  # February revenue has no cost row
    mar = c[D(2024, 3, 1)]
    assert mar.units_sold == 0 and mar.net_revenue == 0 and mar.gross_margin_pct == 0
    jan = c[D(2024, 1, 1)]
    assert jan.net_revenue == Decimal("900.00")  # before returns
    assert jan.total_cogs == Decimal("600.00") and jan.gross_margin_pct == Decimal("33.33")


def test_contraction_in_neither_added_nor_lost(wh):
    m = {r.event_id: r for r in wh.fact_mrr.collect()}
    assert m["e2"].mrr_added == 0 and m["e2"].mrr_lost == 0 and m["e2"].is_contraction
    assert m["e4"].mrr_lost == Decimal("50.00")


def test_waterfall_first_month_and_churn_rate(wh):
    w = {r.event_month: r for r in wh.mrr_waterfall().collect()}
    jan, feb, mar = w[D(2024, 1, 1)], w[D(2024, 2, 1)], w[D(2024, 3, 1)]
    assert jan.prior_month_customers is None and jan.churn_rate_pct == 0
    assert feb.contraction_mrr == Decimal("20.00") and feb.net_new_mrr == Decimal("30.00")
    assert mar.churn_rate_pct == Decimal("50.00")  # 1 churned / 2 active the month before
    assert mar.cumulative_mrr == Decimal("80.00")


def test_customer_health_preserves_customers(wh):
    h = wh.customer_health().collect()
    by = {}
    for r in h:
        by.setdefault(r.customer_id, []).append(r)
    assert set(by) == {"c1", "c2", "c3", "c4"}
    c3 = by["c3"][0]
    assert len(by["c3"]) == 1 and c3.report_month is None and c3.order_count == 0
    assert c3.lifetime_value == 0
    c1 = {r.report_month: r for r in by["c1"]}
    assert c1[D(2024, 1, 1)].is_new_customer and c1[D(2024, 1, 1)].mrr_added == Decimal("100.00")
    assert c1[D(2024, 1, 1)].lifetime_value == Decimal("900.00")  # 450 + 450, repeated per month
    assert c1[D(2024, 2, 1)].days_since_last_order == (AS_OF - D(2024, 2, 10)).days


def test_yoy_null_without_prior_year(wh):
    ti = wh.time_intelligence().collect()
    assert all(r.yoy_growth_pct is None and r.prior_year_daily_revenue is None for r in ti)


def test_fiscal_year_rolls_over_on_oct_first(spark):
    from quillmart.operators.dims import date_spine, dim_date
    d = {r.date_day: r for r in dim_date(date_spine(spark, D(2024, 9, 30), D(2024, 10, 2)), as_of=AS_OF).collect()}
    assert (d[D(2024, 9, 30)].fiscal_year, d[D(2024, 9, 30)].fiscal_quarter) == (2024, 4)
    assert (d[D(2024, 10, 1)].fiscal_year, d[D(2024, 10, 1)].fiscal_month) == (2025, 1)
    assert d[D(2024, 10, 1)].fiscal_year_quarter == "FY2025-Q1"
    assert d[D(2024, 9, 30)].month_name == "September" and len(d[D(2024, 10, 1)].month_name) == 9


def test_dim_date_spine_is_end_exclusive(spark):
    from quillmart.operators.dims import date_spine, dim_date
    assert dim_date(date_spine(spark, D(2022, 1, 1), D(2028, 1, 1)), as_of=AS_OF).count() == 2191


def test_value_tier_null_line_is_generic(wh):
    t = {r.product_id: r.value_tier for r in wh.dims["product"].collect()}
    assert t == {"p1": "High Value", "p2": "Generic"}


def test_dedupe_keeps_latest(spark):
    from quillmart.operators.reports import dedupe_latest
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, ts int, v string")
    assert rows(dedupe_latest(df, ["k"], ["ts"]), "k", "v") == {("a", "new"), ("b", "only")}


def test_classify_mrr_movements(spark):
    from quillmart.operators.mrr import classify_mrr
    m = spark.createDataFrame([
        ("c", D(2024, 1, 1), Decimal("10")), ("c", D(2024, 2, 1), Decimal("15")),
        ("c", D(2024, 3, 1), Decimal("12")), ("c", D(2024, 6, 1), Decimal("12")),
    ], "customer_id string, month date, amount decimal(18,2)")
    ev = rows(classify_mrr(m, ["customer_id"], as_of=D(2024, 7, 15)), "event_month", "event_type", "mrr_amount")
    assert ev == {
        (D(2024, 1, 1), "new", Decimal("10.00")), (D(2024, 2, 1), "expansion", Decimal("5.00")),
        (D(2024, 3, 1), "contraction", Decimal("-3.00")), (D(2024, 4, 1), "churn", Decimal("-12.00")),
        (D(2024, 6, 1), "reactivation", Decimal("12.00")), (D(2024, 7, 1), "churn", Decimal("-12.00")),
    }


def test_dq_report_counts(spark, wh):
    from quillmart.operators.quality import dq_table
    df = spark.createDataFrame([("a", "X"), ("a", "Hospital"), (None, None)], "id string, seg string")
    r = {(x.check_name, x.column_name): x.violations for x in dq_table(df, "t", [
        ("id", "unique", None), ("id", "not_null", None),
        ("seg", "accepted_values", ["Hospital", "Clinic"])]).collect()}
    assert r == {("unique", "id"): 1, ("not_null", "id"): 1, ("accepted_values", "seg"): 1}


def test_orphans_found_and_null_passes(spark):
    from quillmart.operators.quality import orphans
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    assert rows(orphans(child, "c", "fk", parent, "pk"), "value", "n_rows") == {("z", 2)}
