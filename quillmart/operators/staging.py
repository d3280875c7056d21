"""Staging projections: cast, trim, derive and filter each raw table.

Inputs may be typed (Parquet) or all-text (CSV); every column goes through an
explicit cast, never inference. Key columns keep their incoming type (text
UUIDs from CSV, integers from the driver tables). ``loaded_at`` stands in for
the load timestamp; pass a fixed value for reproducible output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.constants import DEFAULT_COUNTRY, TRUE_TEXTS
from quillmart.functions.exact import MONEY, cents, ratio

MONEY14 = "decimal(14,2)"


def _ts(loaded_at) -> Column:
    if loaded_at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(loaded_at, Column):
        return loaded_at
    return F.lit(str(loaded_at)).cast("timestamp_ntz")


def _trim(c: str) -> Column:
    return F.trim(F.col(c).cast("string")).alias(c)


def to_date(raw: DataFrame, c: str) -> Column:
    """Text or timestamp → date; blank text → NULL. Typed input is a plain cast."""
    if isinstance(raw.schema[c].dataType, T.StringType):
        return F.nullif(F.trim(F.col(c)), F.lit("")).cast("date").alias(c)
    return F.col(c).cast("date").alias(c)


def stage_orders(raw: DataFrame, loaded_at=None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``carry`` stay."""
    return raw.select(
        "order_id",
        to_date(raw, "order_date"),
        "product_id", "customer_id", "rep_id", "territory_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("list_price").cast(MONEY14).alias("list_price"),
        F.col("discount_pct").cast("decimal(8,6)").alias("discount_pct"),
        F.col("net_price").cast(MONEY14).alias("net_price"),
        F.col("gross_amount").cast(MONEY14).alias("gross_amount"),
        F.col("net_amount").cast(MONEY14).alias("net_amount"),
        _ts(loaded_at).alias("_loaded_at"),
        *carry,
    ).where(F.col("order_id").isNotNull() & F.col("order_date").isNotNull())


def stage_products(raw: DataFrame, loaded_at=None) -> DataFrame:
    return raw.select(
        "product_id",
        _trim("product_code"), _trim("product_name"), _trim("therapeutic_area"),
        _trim("product_line"), _trim("formulation"),
        to_date(raw, "launch_date"),
        F.col("unit_cost_standard").cast(MONEY14).alias("unit_cost_standard"),
        _ts(loaded_at).alias("_loaded_at"),
    ).where(F.col("product_id").isNotNull())


def parse_bool(c: str) -> Column:
    """true/1/yes (any case, trimmed) → TRUE; anything else, NULL included → FALSE."""
    txt = F.lower(F.trim(F.col(c).cast("string")))
    return F.coalesce(txt.isin(*TRUE_TEXTS), F.lit(False))


def stage_customers(raw: DataFrame, loaded_at=None) -> DataFrame:
    return raw.select(
        "customer_id",
        _trim("account_name"), _trim("segment"), _trim("tier"), _trim("region"),
        "territory_id",
        to_date(raw, "contract_start_date"),
        to_date(raw, "contract_end_date"),
        parse_bool("is_active").alias("is_active"),
        _ts(loaded_at).alias("_loaded_at"),
    ).where(F.col("customer_id").isNotNull())


def stage_reps(raw: DataFrame, loaded_at=None) -> DataFrame:
    return raw.select(
        "rep_id",
        _trim("rep_name"), "territory_id", _trim("region"), _trim("manager_name"),
        to_date(raw, "hire_date"),
        F.col("annual_quota").cast(MONEY14).alias("annual_quota"),
        _ts(loaded_at).alias("_loaded_at"),
    ).where(F.col("rep_id").isNotNull())


def stage_costs(raw: DataFrame, loaded_at=None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Adds cost_variance and cost_variance_pct (NULL when the standard is 0); columns ``carry`` stay."""
    std = F.col("standard_cost").cast(MONEY14)
    act = F.col("actual_cost").cast(MONEY14)
    diff_c = cents(act) - cents(std)
    return raw.select(
        "cost_id", "product_id",
        to_date(raw, "cost_month"),
        std.alias("standard_cost"),
        act.alias("actual_cost"),
        (act - std).cast(MONEY).alias("cost_variance"),
        ratio(diff_c, cents(std), scale=4, times=100).alias("cost_variance_pct"),
        _ts(loaded_at).alias("_loaded_at"),
        *carry,
    ).where(F.col("cost_id").isNotNull())


def stage_returns(raw: DataFrame, loaded_at=None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``carry`` stay."""
    return raw.select(
        "return_id", "order_id",
        to_date(raw, "return_date"),
        F.col("quantity_returned").cast("int").alias("quantity_returned"),
        F.trim(F.col("reason").cast("string")).alias("return_reason"),
        _ts(loaded_at).alias("_loaded_at"),
        *carry,
    ).where(F.col("return_id").isNotNull())


def stage_territories(raw: DataFrame) -> DataFrame:
    """Territories are read as they are: no trim, no NULL filter; a missing country gets the default."""
    return raw.select("territory_id", "territory_name", "region",
                      F.coalesce("country", F.lit(DEFAULT_COUNTRY)).alias("country"), "zone")


def stage_mrr_events(raw: DataFrame) -> DataFrame:
    """Casts only; no NULL filter."""
    return raw.select(
        "event_id", "customer_id", "product_id",
        to_date(raw, "event_month"),
        F.col("event_type").cast("string").alias("event_type"),
        F.col("mrr_amount").cast(MONEY14).alias("mrr_amount"),
    )
