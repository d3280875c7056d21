"""Forecast properties (shape, future months, non-negative, ordered bounds,
short series, flag) and recovery of a known seasonal series."""

import datetime as dt
import math

import numpy as np
import pytest

from quillmart.operators import forecast as FC

HORIZON = 6


def _actuals(spark, n_months=24, lines=("Primary Care", "Biologics")):
    rows = []
    for pl in lines:
        base = 1_000_000 if pl == "Biologics" else 500_000
        for i in range(n_months):
            month = dt.date(2023 + (i // 12), i % 12 + 1, 1)
            # fixed "noise" so no random state is needed
            noise = 10_000 * math.sin(i * 1.7 + len(pl))
            rows.append((month, pl, round(max(base * (1 + 0.05 * math.sin(i * math.pi / 6)) + noise, 0), 2)))
    return spark.createDataFrame(rows, "revenue_month date, product_line string, revenue double") \
        .selectExpr("revenue_month", "product_line", "CAST(revenue AS DECIMAL(18,2)) AS revenue")


@pytest.mark.parametrize("fn", [FC.forecast_holt_winters, FC.forecast_linear])
def test_shape_future_nonneg_bounds_flag(spark, fn):
    s = _actuals(spark, 24)
    f = fn(s).collect()
    assert len(f) == 2 * HORIZON
    assert all(r.revenue_month > dt.date(2024, 12, 1) for r in f)
    assert all(r.revenue >= 0 and r.forecast_lower_bound >= 0 for r in f)
    assert all(r.forecast_lower_bound <= r.forecast_upper_bound for r in f)
    assert all(r.is_forecast for r in f)


def test_twelve_months(spark):
    f = FC.forecast_holt_winters(_actuals(spark, 12)).collect()
    assert len(f) == 2 * HORIZON and all(r.is_forecast for r in f)


def test_short_series_uses_line(spark):
    f = FC.forecast_holt_winters(_actuals(spark, 4, ("Generics",))).collect()
    assert len(f) == HORIZON and all(r.revenue >= 0 for r in f)


def test_steep_decline_clips_and_orders_bounds(spark):
    s = spark.createDataFrame([(dt.date(2024, m, 1), "X", v) for m, v in enumerate((1000, 600, 200, 10), 1)],
                              "revenue_month date, product_line string, revenue int")
    f = FC.forecast_holt_winters(s.selectExpr("revenue_month", "product_line", "CAST(revenue AS DECIMAL(18,2)) AS revenue")).collect()
    assert len(f) == HORIZON and all(r.revenue == 0 and r.forecast_lower_bound == 0 for r in f)
    assert all(r.forecast_upper_bound >= r.forecast_lower_bound for r in f)


def test_seasonal_series_is_recovered():
    n = 48
    t = np.arange(n)
    y = 1000 + 5 * t + 100 * np.sin(2 * np.pi * t / 12)
    f, lo, up = FC.holt_winters_forecast(y, HORIZON)
    truth = 1000 + 5 * np.arange(n, n + HORIZON) + 100 * np.sin(2 * np.pi * np.arange(n, n + HORIZON) / 12)
    assert np.max(np.abs(f - truth)) < 60
    assert (lo <= f).all() and (f <= up).all()


def test_linear_single_point_is_flat(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, 1), "X", 100)], "revenue_month date, product_line string, revenue int") \
        .selectExpr("revenue_month", "product_line", "CAST(revenue AS DECIMAL(18,2)) AS revenue")
    f = FC.forecast_linear(s).collect()
    assert {float(r.revenue) for r in f} == {100.0}
    assert {float(r.forecast_upper_bound) for r in f} == {119.6}


def test_upsert_twice_is_stable(spark):
    s = _actuals(spark, 24)
    actual = s.selectExpr("revenue_month", "product_line", "CAST(NULL AS STRING) AS therapeutic_area",
                          "revenue", "false AS is_forecast")
    new = FC.forecast_linear(s)
    once = FC.upsert_forecast(actual, new)
    twice = FC.upsert_forecast(once, new)
    key = lambda df: sorted(tuple(r) for r in df.select("revenue_month", "product_line", "revenue", "is_forecast").collect())
    assert key(once) == key(twice)
    assert once.where("is_forecast").count() == 2 * HORIZON
