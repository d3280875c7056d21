"""Monthly revenue forecasting over many series at once.

* ``monthly_series``      – actuals → (month, key, revenue) series (S9/G10).
* ``forecast_linear``     – least-squares line per series, pure DataFrame
                             aggregates (``regr_slope``/``regr_intercept``).
* ``forecast_holt_winters`` – per-series additive damped-trend + additive
                             season model, one pandas frame per series inside
                             ``applyInPandas``; series shorter than 6 points
                             use the linear fallback.
* ``upsert_forecast``     – replace stale forecast rows, append new ones.
* ``forecast_levels``     – company / line / area series via grouping sets.

The scale axis is the number of series: each series is at most one row per
month, Spark shuffles series to tasks by key and fits them in parallel.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.constants import FORECAST_HORIZON, Z_95
from quillmart.sources.versions import VersionedTable
from quillmart.functions.exact import MONEY

MIN_SEASONAL_POINTS = 6
MONEY14 = "decimal(14,2)"

# The per-series fit runs in Python workers: ship this module's functions with
# the task (by value) so executors need no installed copy of the package.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: package must be on executors
    pass


def monthly_series(actuals: DataFrame, key: str = "product_line", *, densify: str | None = None,
                   before: dt.date | None = None) -> DataFrame:
    """Σ revenue per (month, key) over actual (non-forecast) rows.

    ``densify="zero"`` gives every month between a series' first and last a row, 0 where it
    had none; ``before`` leaves out the month of that date and later ones (a
    current month that is not over yet).
    """
    rows = actuals.where(~F.col("is_forecast") & F.col("revenue_month").isNotNull())
    if before is not None:
        rows = rows.where(F.col("revenue_month") < F.trunc(F.lit(before.isoformat()).cast("date"), "month"))
    sums = rows.groupBy("revenue_month", key).agg(F.sum("revenue").cast(MONEY).alias("revenue"))
    if densify is None:
        return sums
    if densify != "zero":
        raise ValueError(f"densify must be None or 'zero', not {densify!r}")
    w = Window.partitionBy(key).orderBy("revenue_month")  # a row per month
    following = F.coalesce(F.lead("revenue_month").over(w), F.add_months("revenue_month", 1))
    gaps = sums.withColumn("_next", following)
    month = F.explode(F.sequence("revenue_month", F.add_months("_next", -1), F.expr("interval 1 month")))
    return gaps.select(key, "revenue", F.col("revenue_month").alias("_first"), month.alias("revenue_month")).select(
        "revenue_month", key, F.when(F.col("revenue_month") == F.col("_first"), F.col("revenue"))
        .otherwise(F.lit(0).cast(MONEY)).alias("revenue"))


def _forecast_rows(df: DataFrame, key: str) -> DataFrame:
    """Shape (month, key, revenue, lower, upper) as mart rows (all money rounded to 2)."""
    def money(c):
        return F.round(F.col(c), 2).cast(MONEY14)
    return df.select(
        "revenue_month",
        F.col(key).alias("product_line") if key != "product_line" else F.col(key),
        F.lit(None).cast("string").alias("therapeutic_area"),
        money("revenue").alias("revenue"),
        F.lit(None).cast("bigint").alias("units_sold"),
        F.lit(None).cast("bigint").alias("order_count"),
        F.lit(True).alias("is_forecast"),
        money("lower").alias("forecast_lower_bound"),
        money("upper").alias("forecast_upper_bound"),
    )


def forecast_linear(series: DataFrame, key: str = "product_line",
                    horizon: int = FORECAST_HORIZON) -> DataFrame:
    """Straight-line projection of each series from its own last month.

    Points are indexed 0..n-1 in month order (gaps close up). Bounds are
    ±1.96·sample std of the values (0.1·mean for a single point); point and
    lower bound are clipped at 0, and the upper bound is kept ≥ the lower one.
    A single point gives a flat line at its value.
    """
    s = series.where(F.col(key).isNotNull() & F.col("revenue").isNotNull())
    w = Window.partitionBy(key).orderBy("revenue_month")
    s = s.select(key, "revenue_month", F.col("revenue").cast("double").alias("y"),
                 (F.row_number().over(w) - 1).cast("double").alias("x"))
    fit = s.groupBy(key).agg(
        F.count("*").alias("n"),
        F.max("revenue_month").alias("last_month"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.stddev_samp("y").alias("sd"),
        F.avg("y").alias("mean"),
    )
    slope = F.coalesce(F.col("slope"), F.lit(0.0))
    intercept = F.coalesce(F.col("intercept"), F.col("mean"))
    sd = F.when(F.col("n") > 1, F.col("sd")).otherwise(F.col("mean") * 0.1)
    out = fit.select(key, "n", "last_month", slope.alias("b"), intercept.alias("a"), sd.alias("sd"),
                     F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    f = F.col("a") + F.col("b") * (F.col("n") - 1 + F.col("h"))
    lower = F.greatest(f - Z_95 * F.col("sd"), F.lit(0.0))
    out = out.select(
        F.add_months("last_month", F.col("h")).alias("revenue_month"), key,
        F.greatest(f, F.lit(0.0)).alias("revenue"),
        lower.alias("lower"),
        F.greatest(f + Z_95 * F.col("sd"), lower).alias("upper"),
    )
    return _forecast_rows(out, key)


# ----------------------------------------------------------- Holt-Winters
# Smoothing parameters tried first (level, trend, season, damping), then steps around the best.
GRID = ([0.1, 0.3, 0.5, 0.7, 0.9], [0.01, 0.05, 0.15, 0.3], [0.05, 0.15, 0.3, 0.5], [0.8, 0.9, 0.98])
STEPS = (0.1, 0.02, 0.05, 0.04)
RANGES = ((0.02, 0.98), (0.005, 0.98), (0.02, 0.98), (0.7, 0.995))


def _smooth(y: np.ndarray, m: int, grid: np.ndarray):
    """Additive damped smoothing for all parameter rows at once.

    Returns one-step-ahead fitted values (k, n) and the final level, trend and
    last m seasonal terms. The first season's mean starts the level, the
    difference to the second's the trend.
    """
    level_rate, trend_rate, season_rate, damping = grid
    start = y[:m].mean()
    level = np.full(grid.shape[1], start)
    trend = np.full(grid.shape[1], (y[m:2 * m].mean() - start) / m)
    season = np.tile(y[:m] - start, (grid.shape[1], 1))
    fitted = np.empty((grid.shape[1], len(y)))
    for t, actual in enumerate(y):
        held = season[:, t % m].copy()
        expected = level + damping * trend
        fitted[:, t] = expected + held
        risen = level_rate * (actual - held) + (1 - level_rate) * expected
        trend = trend_rate * (risen - level) + (1 - trend_rate) * (damping * trend)
        season[:, t % m] = season_rate * (actual - risen) + (1 - season_rate) * held
        level = risen
    return fitted, level, trend, season


def _combinations(axes) -> np.ndarray:
    return np.array(np.meshgrid(*axes, indexing="ij")).reshape(len(axes), -1)


def holt_winters_forecast(y: np.ndarray, horizon: int = FORECAST_HORIZON):
    """(forecast, lower, upper) arrays for one series of at least 6 points, deterministic.

    Season length min(12, n // 2); the parameters with the smallest in-sample
    squared one-step error on ``GRID``, then among the points one step of
    ``STEPS`` around them; bounds at ±1.96 standard deviations of the residuals.
    """
    y = np.asarray(y, dtype=float)
    n = len(y)
    m = min(12, n // 2)
    axes = GRID
    for _ in range(2):
        grid = _combinations(axes)
        fitted, level, trend, season = _smooth(y, m, grid)
        best = int(np.argmin(((fitted - y) ** 2).sum(axis=1)))
        axes = [sorted({min(max(grid[k, best] + d, low), high) for d in (-step, 0.0, step)})
                for k, (step, (low, high)) in enumerate(zip(STEPS, RANGES))]
    ahead = np.arange(1, horizon + 1)
    f = level[best] + np.cumsum(grid[3, best] ** ahead) * trend[best] + season[best, (n + ahead - 1) % m]
    spread = Z_95 * (y - fitted[best]).std(ddof=1)
    point = np.maximum(f, 0)
    return point, np.maximum(point - spread, 0), point + spread


_HW_SCHEMA = T.StructType([
    T.StructField("series_key", T.StringType()),
    T.StructField("revenue_month", T.DateType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("lower", T.DoubleType()),
    T.StructField("upper", T.DoubleType()),
])


def _fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("revenue_month")
    f, lo, up = holt_winters_forecast(pdf["y"].to_numpy(), FORECAST_HORIZON)
    last = pd.Timestamp(pdf["revenue_month"].iloc[-1])
    months = [(last + pd.DateOffset(months=h)).date() for h in range(1, len(f) + 1)]
    return pd.DataFrame({"series_key": pdf["series_key"].iloc[0], "revenue_month": months,
                         "revenue": f, "lower": lo, "upper": up})


def forecast_holt_winters(series: DataFrame, key: str = "product_line") -> DataFrame:
    """Per-series Holt-Winters forecast rows, fitted in parallel by ``applyInPandas``; series under
    6 points get the straight line of ``forecast_linear``."""
    s = series.where(F.col(key).isNotNull() & F.col("revenue").isNotNull())
    points = Window.partitionBy(key)  # a series: one row per month
    s = s.withColumn("_n", F.count(F.lit(1)).over(points))
    long = s.where(F.col("_n") >= MIN_SEASONAL_POINTS).select(
        F.col(key).cast("string").alias("series_key"), "revenue_month", F.col("revenue").cast("double").alias("y"))
    out = long.groupBy("series_key").applyInPandas(_fit_group, schema=_HW_SCHEMA)
    fitted = _forecast_rows(out.withColumnRenamed("series_key", key), key)
    return fitted.unionByName(forecast_linear(s.where(F.col("_n") < MIN_SEASONAL_POINTS).drop("_n"), key))


def forecast_levels_fit(levels: DataFrame) -> DataFrame:
    """Forecasts of each series of ``forecast_levels``: level and series in columns of their own.
    Series without a name are left out."""
    named = levels.where(F.col("series").isNotNull()).select(
        "revenue_month", F.concat_ws(":", "level", "series").alias("_key"), "revenue")
    rows = forecast_holt_winters(named, key="_key")
    return rows.select(
        "revenue_month", F.substring_index("product_line", ":", 1).alias("level"),
        F.expr("substring(product_line, instr(product_line, ':') + 1)").alias("series"),
        "revenue", "forecast_lower_bound", "forecast_upper_bound")


# ----------------------------------------------------------------- upsert
def upsert_forecast(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Drop forecast rows whose month is among the new months AND whose line is
    among the new lines (the full cross product, as the original delete does),
    then append the new rows. Actual rows are never touched.

    The month and line sets are distinct projections of the new forecast; how
    they are joined is left to their size at run time.
    """
    months = new.select("revenue_month").distinct().withColumn("_m_hit", F.lit(True))
    lines = new.select("product_line").distinct().withColumn("_l_hit", F.lit(True))
    e = existing.join(months, "revenue_month", "left").join(lines, "product_line", "left")
    stale = (F.col("is_forecast") & F.coalesce(F.col("_m_hit"), F.lit(False))
             & F.coalesce(F.col("_l_hit"), F.lit(False)))
    kept = e.where(~F.coalesce(stale, F.lit(False))).select(*existing.columns)
    return kept.unionByName(new, allowMissingColumns=True)


def write_forecast(spark, path: str, forecast: DataFrame) -> int:
    """Upsert ``forecast`` into the versioned mart table at ``path`` (actual rows and earlier forecasts).

    The new state is written beside the old one and put in place by one commit, so
    readers (``read_forecast``) see the old or the new table whenever the job dies. Without
    forecast rows (no actuals to learn from) nothing is written. Returns the rows of the forecast.
    """
    table = VersionedTable(spark, path)
    held = table.current()
    fresh = VersionedTable(spark, f"{path}/incoming")  # the forecast is fitted once
    new = fresh.read(fresh.replace(forecast))
    rows = new.count()
    if rows:
        before = table.read(held)
        table.replace(upsert_forecast(before if before is not None else new.limit(0), new), after=held, rows=rows)
        table.vacuum(keep=2)
    fresh.fs.delete(fresh._new(fresh.path), True)
    return rows


def read_forecast(spark, path: str) -> DataFrame | None:
    """The mart table in its latest state."""
    return VersionedTable(spark, path).read()


# ----------------------------------------------------------------- levels
def forecast_levels(actuals: DataFrame) -> DataFrame:
    """Series at company, product-line and therapeutic-area level (grouping sets)."""
    a = actuals.where(~F.col("is_forecast") & F.col("revenue_month").isNotNull())
    g = a.groupingSets(
        [["revenue_month"], ["revenue_month", "product_line"], ["revenue_month", "therapeutic_area"]],
        "revenue_month", "product_line", "therapeutic_area",
    ).agg(F.sum("revenue").cast(MONEY).alias("revenue"),
          F.grouping_id().alias("_gid"))
    level = (F.when(F.col("_gid") == 3, "company")
             .when(F.col("_gid") == 1, "product_line")
             .otherwise("therapeutic_area"))
    name = (F.when(F.col("_gid") == 3, F.lit("ALL"))
            .when(F.col("_gid") == 1, F.col("product_line"))
            .otherwise(F.col("therapeutic_area")))
    return g.select("revenue_month", level.alias("level"), name.alias("series"),
                    F.concat_ws(":", level, F.coalesce(name, F.lit("NULL"))).alias("series_key"),
                    "revenue")
