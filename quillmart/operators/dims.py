"""Dimensions: calendar, product, customer, rep, territory (all type 1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.constants import FISCAL_START_MONTH, HIGH_VALUE_LINES, STANDARD_LINE
from quillmart.functions import calendar as cal
from quillmart.functions.exact import cents, div_round, from_cents
from quillmart.functions.keys import surrogate_key


def _lit_date(d: dt.date):
    return F.lit(d.isoformat()).cast("date")


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in [start, end). Built from ``range``: no single-row explode."""
    n = (end - start).days
    return spark.range(0, max(n, 0)).select(
        F.date_add(_lit_date(start), F.col("id").cast("int")).alias("date_day"))


def spine_of(dates: DataFrame, column: str, *, as_of: dt.date) -> DataFrame:
    """One row per day of the whole years from the first date of ``column`` to a month after its
    last (a churn month may follow the last order), ``as_of`` included.

    The bounds are part of the plan, so no date of the data can miss its key.
    There are at most as many rows as days in the date type's years 1 to 9999.
    """
    d, today = F.col(column).cast("date"), _lit_date(as_of)
    ends = dates.agg(F.trunc(F.least(F.min(d), today), "year").alias("a"),
                     F.trunc(F.greatest(F.add_months(F.max(d), 1), today), "year").alias("b"))
    return ends.select(F.explode(F.sequence(
        F.col("a"), F.date_sub(F.add_months("b", 12), 1), F.expr("interval 1 day"))).alias("date_day"))


def dim_date(spine: DataFrame, *, as_of: dt.date, fiscal_start: int = FISCAL_START_MONTH,
             pad_month_name: bool = True) -> DataFrame:
    """Calendar attributes of each ``date_day`` of ``spine``."""
    d = F.col("date_day")
    today = _lit_date(as_of)
    fy = cal.fiscal_year(d, fiscal_start)
    fq = cal.fiscal_quarter(d, fiscal_start)
    dow = cal.iso_dow(d)
    last = F.last_day(d)
    return spine.select(
        cal.date_key(d).alias("date_key"),
        d,
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month_num"),
        cal.month_name(d, pad_month_name).alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        dow.alias("day_of_week"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        F.dayofyear(d).cast("int").alias("day_of_year"),
        F.date_format(d, "yyyy-'Q'q").alias("year_quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.trunc(d, "week").alias("week_start_date"),
        F.trunc(d, "month").alias("first_day_of_month"),
        last.alias("last_day_of_month"),
        F.dayofmonth(last).cast("int").alias("days_in_month"),
        fy.alias("fiscal_year"),
        fq.alias("fiscal_quarter"),
        cal.fiscal_month(d, fiscal_start).alias("fiscal_month"),
        F.concat(F.lit("FY"), fy.cast("string"), F.lit("-Q"), fq.cast("string")).alias("fiscal_year_quarter"),
        (d == today).alias("is_today"),
        (d == F.trunc(today, "month")).alias("is_first_of_current_month"),
        (F.trunc(d, "month") == F.trunc(today, "month")).alias("is_current_month"),
        (F.trunc(d, "quarter") == F.trunc(today, "quarter")).alias("is_current_quarter"),
        (F.year(d) == F.year(today)).alias("is_current_year"),
        (d <= today).alias("is_actual"),
        dow.between(1, 5).alias("is_weekday"),
        (~dow.between(1, 5)).alias("is_weekend"),
    )


def value_tier(line_col: str = "product_line"):
    line = F.col(line_col)
    return (F.when(line.isin(*HIGH_VALUE_LINES), "High Value")
            .when(line == STANDARD_LINE, "Standard")
            .otherwise("Generic"))


def dim_product(stg: DataFrame) -> DataFrame:
    return stg.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id", "product_code", "product_name", "therapeutic_area",
        "product_line", "formulation", "launch_date", "unit_cost_standard",
        F.year("launch_date").cast("int").alias("launch_year"),
        value_tier().alias("value_tier"),
        "_loaded_at",
    )


def dim_customer(stg: DataFrame, *, as_of: dt.date) -> DataFrame:
    start = F.col("contract_start_date")
    tenure = F.coalesce(F.datediff("contract_end_date", start), F.datediff(_lit_date(as_of), start))
    tier = F.col("tier")
    return stg.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id", "account_name", "segment", "tier", "region", "territory_id",
        "contract_start_date", "contract_end_date", "is_active",
        tenure.cast("int").alias("tenure_days"),
        F.when(tier == "A", 3).when(tier == "B", 2).otherwise(1).cast("int").alias("tier_rank"),
        "_loaded_at",
    )


def dim_rep(stg: DataFrame, *, as_of: dt.date) -> DataFrame:
    q = cents("annual_quota")
    return stg.select(
        surrogate_key("rep_id").alias("rep_key"),
        "rep_id", "rep_name", "territory_id", "region", "manager_name", "hire_date",
        "annual_quota",
        from_cents(div_round(q, F.lit(12))).alias("monthly_quota"),
        from_cents(div_round(q, F.lit(365))).alias("daily_quota"),
        F.datediff(_lit_date(as_of), "hire_date").cast("int").alias("tenure_days"),
        "_loaded_at",
    )


def dim_territory(stg: DataFrame, loaded_at=None) -> DataFrame:
    from quillmart.operators.staging import _ts
    return stg.select(
        surrogate_key("territory_id").alias("territory_key"),
        "territory_id", "territory_name", "region", "country", "zone",
        _ts(loaded_at).alias("_loaded_at"),
    )
