"""Gold marts: sales performance, cost & margin, customer health, time
intelligence and the forecast base.

All windows run on pre-aggregated rows (product × month, customer × month,
day × line × area), so a window partition is bounded by the calendar, not by
the number of orders behind it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmart.functions.exact import MONEY, cents, div_round, from_cents, pct, sum_money
from quillmart.plans.joins import (
    HOME, calendar_join, dim_column, is_broadcast, lookup_join, near_lookup, order_key)


def _lit_date(d: dt.date):
    return F.lit(d.isoformat()).cast("date")


def single_orders(fact: DataFrame) -> DataFrame:
    """``fact`` with ``_single``, 1 for the only row of its order id; that row's id becomes null.

    Distinct ids of a group that are counted this way are the sum of ``_single`` plus the distinct
    ids left, so that hardly any id is moved. The sales fact lies by order already.
    """
    own = F.count(F.lit(1)).over(Window.partitionBy(*order_key(fact)))
    single = F.col("order_id").isNotNull() & (own == 1)
    return fact.select(*[c for c in fact.columns if c != "order_id"], F.when(~single, F.col("order_id")).alias("order_id"),
                       single.cast("int").alias("_single"))


def product_rollup(fact: DataFrame, dim_product: DataFrame, attributes: tuple[str, ...], by: dict, sums: dict,
                   orders: str | None = None) -> DataFrame:
    """Sums of ``fact`` per ``by`` (columns by name) and product attributes, and its distinct order ids as ``orders``.

    ``sums``: names of the sums by their columns, amounts or whole numbers. Where the attributes
    are broadcast, rows are summed where they lie. Else each row moves once to its product, as
    narrow as it can be.
    """
    whole = {c for c, t in fact.select(*sums).dtypes if not t.startswith("decimal")}
    key = dim_column(fact, "product")
    dim = dim_product.select(key, *attributes)
    needed = [c.alias(name) for name, c in by.items()] + [
        (F.col(c) if c in whole else cents(c)).cast("bigint").alias(c) for c in sums]
    group = [*by, *attributes]

    def total(value, c):
        return (F.sum(value) if c in whole else from_cents(F.sum(value), wide=True)).alias(sums[c])

    if is_broadcast(dim):
        f = lookup_join(fact.select(key, *needed, *(order_key(fact) if orders else [])), dim, key)
        count = [F.count_distinct(*order_key(fact)).cast("bigint").alias(orders)] if orders else []
        return f.groupBy(*group).agg(*[total(F.col(c), c) for c in sums], *count)
    f = single_orders(fact.select(key, *needed, *order_key(fact))).drop(HOME) if orders else fact.select(key, *needed)
    # Equal rows of a repeated product count their orders once and their sums each time.
    f = f.join(dim.groupBy(*dim.columns).agg(F.count(F.lit(1)).cast("int").alias("_times")), key, "left")
    times = F.coalesce("_times", F.lit(1))
    count = [(F.count_distinct("order_id") + F.coalesce(F.sum("_single"), F.lit(0))).cast("bigint").alias(orders)] if orders else []
    return f.groupBy(*group).agg(*[total(F.col(c) * times, c) for c in sums], *count)


def customer_rollup(fact: DataFrame, dim_customer: DataFrame, month: str, latest: dict) -> DataFrame:
    """Orders, revenue, units and the greatest of ``latest`` per known customer and month of orders.

    Summed by the fact's customer first, where distinct orders are counted without moving
    their ids, then looked up. A repeated customer's sums count each time, its orders once.
    """
    key = dim_column(fact, "customer")
    sums = fact.groupBy(key, F.trunc("order_date", "month").alias(month)).agg(
        F.count_distinct(*order_key(fact)).cast("bigint").alias("_orders"), sum_money("final_net_revenue").alias("_revenue"),
        F.sum("net_units").cast("bigint").alias("_units"), *[F.max(c).alias(name) for name, c in latest.items()])
    if key == "customer_id":
        held = dim_customer.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("_times"))
    else:
        held = dim_customer.groupBy(key, "customer_id").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    return sums.join(held, key).select(
        "customer_id", month, "_orders", (F.col("_revenue") * F.col("_times")).cast(MONEY).alias("_revenue"),
        (F.col("_units") * F.col("_times")).alias("_units"), *latest)


# --------------------------------------------------------------------- R1
def sales_performance(fact: DataFrame, dims: dict[str, DataFrame],
                      used: Mapping[str, DataFrame] = MappingProxyType({}), by_home: bool = True) -> DataFrame:
    """Order-line mart: the fact joined to all five dimensions (star join).

    ``used``: cheaper frames with all pairs of the fact's ``HOME`` and an id. ``by_home``: the fact lies by
    that column, if it has it; else its rows move there once if they would have to for two dimensions.
    """
    dd = dims["date"].select("date_key", "year", "quarter", "month_num", "month_name", "year_month",
                             "year_quarter", "fiscal_year", "fiscal_quarter", "is_current_month",
                             "is_actual")
    dp = dims["product"].select(dim_column(fact, "product"), "product_code", "product_name", "therapeutic_area",
                                "product_line", "formulation", "value_tier")
    dc = dims["customer"].select(
        dim_column(fact, "customer"), "account_name", F.col("segment").alias("customer_segment"),
        F.col("tier").alias("customer_tier"), F.col("region").alias("customer_region"),
        F.col("is_active").alias("customer_is_active"))
    dr = dims["rep"].select(dim_column(fact, "rep"), "rep_name", "manager_name", "annual_quota", "monthly_quota")
    dt_ = dims["territory"].select(dim_column(fact, "territory"), "territory_name",
                                   F.col("region").alias("territory_region"), "zone")
    lookups = (("product", dp), ("customer", dc), ("rep", dr), ("territory", dt_))
    f = fact
    if HOME in fact.columns and not by_home:
        f = fact.repartition(HOME) if sum(not is_broadcast(columns) for _, columns in lookups) > 1 else fact.drop(HOME)
    for dim, columns in lookups:
        on = dim_column(fact, dim)
        f = near_lookup(f, columns, on, used.get(on))
    f = calendar_join(f, dims["date"], dd, "date_key")  # last: its columns need not be moved
    return f.select(
        "order_id", "order_date", "year", "quarter", "month_num", "month_name", "year_month",
        "year_quarter", "fiscal_year", "fiscal_quarter", "is_current_month", "is_actual",
        "product_code", "product_name", "therapeutic_area", "product_line", "formulation",
        "value_tier", "account_name", "customer_segment", "customer_tier", "customer_region",
        "customer_is_active", "rep_name", "manager_name", "annual_quota", "monthly_quota",
        "territory_name", "territory_region", "zone",
        "units_sold", "units_returned", "net_units", "gross_amount", "net_revenue",
        "discount_amount", "final_net_revenue", "discount_pct", "daily_quota_attainment_pct",
        F.lit(False).alias("is_forecast"),
    )


# --------------------------------------------------------------------- R2
def cogs_margin(fact_cogs: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Product × month margin with a 3-row rolling mean, prior month and delta.

    The rolling mean is exact: Σ of margins in hundredths over the frame,
    divided by the row count and rounded half away from zero to 4 places.
    """
    dd = dims["date"].select("date_key", "year", "quarter", "month_num", "month_name", "year_month",
                             "year_quarter", "fiscal_year", "fiscal_quarter", "is_current_month")
    dp = dims["product"].select(dim_column(fact_cogs, "product"), "product_code", "product_name", "therapeutic_area",
                                "product_line", "value_tier")
    f = calendar_join(fact_cogs, dims["date"], dd, "date_key")
    f = lookup_join(f, dp, dim_column(fact_cogs, "product"))  # by id: rows lie by it already, for the window too
    w = Window.partitionBy("product_id").orderBy(F.col("cost_month").asc_nulls_last())
    frame = w.rowsBetween(-2, 0)
    gm_c = cents("gross_margin_pct")
    roll = from_cents(div_round(F.sum(gm_c).over(frame) * 100, F.count(gm_c).over(frame)), 4)
    prior = F.lag("gross_margin_pct", 1).over(w)
    return f.select(
        "cost_month", "year", "quarter", "month_num", "month_name", "year_month", "year_quarter",
        "fiscal_year", "fiscal_quarter", "is_current_month",
        "product_code", "product_name", "therapeutic_area", "product_line", "value_tier",
        "standard_cost", "actual_cost", "cost_variance", "cost_variance_pct",
        "units_sold", "net_revenue", "total_cogs", "gross_profit", "gross_margin_pct",
        roll.alias("rolling_3m_margin_pct"),
        prior.alias("prior_month_margin_pct"),
        (F.col("gross_margin_pct") - prior).cast("decimal(18,2)").alias("margin_mom_delta"),
    )


# --------------------------------------------------------------------- R3
def customer_health(fact: DataFrame, fact_mrr: DataFrame, dim_customer: DataFrame, *,
                    as_of: dt.date) -> DataFrame:
    """Customer × active month: orders, revenue, recency, MRR movements, LTV.

    ``days_since_last_order`` is measured from that month's last order; the
    lifetime value repeats on every month row of a customer. Lifetime value is
    summed over the monthly rows (one pass over the fact, not two).
    """
    mo = customer_rollup(fact, dim_customer, "activity_month", {"last_order_date": F.col("order_date")}).withColumnsRenamed(
        {"_orders": "mo_order_count", "_revenue": "mo_revenue", "_units": "mo_units"})
    own = Window.partitionBy("customer_id")  # a row per month of the customer
    mo = mo.withColumn("ltv", F.sum("mo_revenue").over(own).cast(MONEY))
    mrr = fact_mrr.groupBy("customer_id", "event_month").agg(
        sum_money("mrr_added").alias("m_added"),
        sum_money("mrr_lost").alias("m_lost"),
        F.bool_or("is_churned").alias("m_churned"),
        F.bool_or("is_new").alias("m_new"),
        F.bool_or("is_reactivated").alias("m_react"),
        F.bool_or("is_expansion").alias("m_exp"),
    )
    dc = dim_customer.select("customer_id", "account_name", "segment", "tier", "tier_rank", "region",
                             "contract_start_date", "contract_end_date", "is_active", "tenure_days")
    j = dc.join(mo, "customer_id", "left")
    j = j.withColumn("_mkey", F.coalesce(F.col("activity_month"), _lit_date(dt.date(1900, 1, 1))))
    j = j.join(mrr.withColumnRenamed("event_month", "_mkey"), ["customer_id", "_mkey"], "left")
    z2 = F.lit(0).cast(MONEY)
    z0 = F.lit(0).cast("bigint")
    f = F.lit(False)
    return j.select(
        "customer_id", "account_name", "segment", "tier", "tier_rank", "region",
        "contract_start_date", "contract_end_date", "is_active", "tenure_days",
        F.coalesce("activity_month", F.when(F.col("m_added").isNotNull(), F.col("_mkey"))).alias("report_month"),
        F.coalesce("mo_order_count", z0).alias("order_count"),
        F.coalesce("mo_revenue", z2).alias("monthly_revenue"),
        F.coalesce("mo_units", z0).alias("monthly_units"),
        "last_order_date",
        F.datediff(_lit_date(as_of), "last_order_date").cast("int").alias("days_since_last_order"),
        F.coalesce("m_added", z2).alias("mrr_added"),
        F.coalesce("m_lost", z2).alias("mrr_lost"),
        F.coalesce("m_churned", f).alias("is_churned"),
        F.coalesce("m_new", f).alias("is_new_customer"),
        F.coalesce("m_react", f).alias("is_reactivated"),
        F.coalesce("m_exp", f).alias("is_expansion"),
        F.coalesce("ltv", z2).alias("lifetime_value"),
    )


def customer_months(fact: DataFrame, fact_mrr: DataFrame, dim_customer: DataFrame, *,
                    as_of: dt.date) -> DataFrame:
    """Customer health with every month of a customer, its latest order and its value to date.

    Unlike ``customer_health``: a month with recurring-revenue events and no orders has its
    row; recency is that of the customer's last order up to ``as_of``, the same on all
    its rows; ``value_to_date`` runs up to the row's month (null months first).
    Customers without any month keep one row.
    """
    orders = customer_rollup(fact, dim_customer, "report_month", {
        "last_order_date": F.col("order_date"),
        "_upto": F.when(F.col("order_date") <= _lit_date(as_of), F.col("order_date"))}).withColumnsRenamed(
        {"_orders": "order_count", "_revenue": "monthly_revenue", "_units": "monthly_units"})
    flags = ("is_churned", "is_new", "is_reactivated", "is_expansion")
    mrr = fact_mrr.groupBy("customer_id", F.col("event_month").alias("report_month")).agg(
        sum_money("mrr_added").alias("mrr_added"), sum_money("mrr_lost").alias("mrr_lost"),
        *[F.bool_or(f).alias(f) for f in flags])
    o, m = orders.alias("o"), mrr.alias("m")
    same = F.col("o.customer_id").eqNullSafe(F.col("m.customer_id")) & F.col("o.report_month").eqNullSafe(F.col("m.report_month"))
    months = o.join(m, same, "full").select(
        F.coalesce("o.customer_id", "m.customer_id").alias("customer_id"),
        F.coalesce("o.report_month", "m.report_month").alias("report_month"),
        "order_count", "monthly_revenue", "monthly_units", "last_order_date", "_upto", "mrr_added", "mrr_lost", *flags)
    own = Window.partitionBy("customer_id")  # a row per month of the customer
    upto = own.orderBy(F.col("report_month").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast(MONEY)
    revenue = F.coalesce("monthly_revenue", zero)
    months = months.select(
        "customer_id", "report_month", F.coalesce("order_count", F.lit(0)).alias("order_count"),
        revenue.alias("monthly_revenue"), F.coalesce("monthly_units", F.lit(0)).alias("monthly_units"),
        "last_order_date", F.max("_upto").over(own).alias("latest_order_date"),
        F.coalesce("mrr_added", zero).alias("mrr_added"), F.coalesce("mrr_lost", zero).alias("mrr_lost"),
        *[F.coalesce(f, F.lit(False)).alias(f) for f in flags],
        F.sum(revenue).over(upto).cast(MONEY).alias("value_to_date"),
        F.sum(revenue).over(own).cast(MONEY).alias("lifetime_value"))
    dc = dim_customer.select("customer_id", "account_name", "segment", "tier", "region", "is_active")
    return dc.join(months, "customer_id", "left").select(
        *dc.columns, "report_month", F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce("monthly_revenue", zero).alias("monthly_revenue"),
        F.coalesce("monthly_units", F.lit(0)).cast("bigint").alias("monthly_units"),
        "last_order_date", "latest_order_date",
        F.datediff(_lit_date(as_of), "latest_order_date").cast("int").alias("days_since_latest_order"),
        F.coalesce("mrr_added", zero).alias("mrr_added"), F.coalesce("mrr_lost", zero).alias("mrr_lost"),
        *[F.coalesce(f, F.lit(False)).alias(f) for f in flags],
        F.coalesce("value_to_date", zero).alias("value_to_date"), F.coalesce("lifetime_value", zero).alias("lifetime_value"))


# --------------------------------------------------------------------- R5
def daily_revenue(fact: DataFrame, dim_product: DataFrame, *, as_of: dt.date) -> DataFrame:
    return product_rollup(
        fact.where(F.col("order_date") <= _lit_date(as_of)), dim_product, ("product_line", "therapeutic_area"),
        {"order_date": F.col("order_date")},
        {"final_net_revenue": "daily_revenue", "units_sold": "daily_units"}, "daily_orders")


def time_intelligence(fact: DataFrame, dims: dict[str, DataFrame], *, as_of: dt.date,
                      frame: str = "rows") -> DataFrame:
    """Daily revenue per (line, area) with MTD/QTD/YTD, rolling 90/365 and YoY.

    ``frame="rows"`` counts rows (days with sales), as the original model
    does; ``frame="days"`` uses calendar-day ranges and the value exactly 364
    days earlier. All windows share one (line, area) shuffle.
    """
    dr = daily_revenue(fact, dims["product"], as_of=as_of)
    dd = dims["date"].select(F.col("date_day").alias("order_date"), "year", "quarter", "month_num",
                             "month_name", "year_month", "year_quarter", "fiscal_year",
                             "fiscal_quarter", "is_current_month")
    f = calendar_join(dr, dims["date"], dd, "order_date")
    grp = ["product_line", "therapeutic_area"]
    upto = (Window.unboundedPreceding, 0)
    rev = F.col("daily_revenue")
    mtd = F.sum(rev).over(Window.partitionBy("year", "month_num", *grp).orderBy("order_date").rowsBetween(*upto))
    qtd = F.sum(rev).over(Window.partitionBy("year", "quarter", *grp).orderBy("order_date").rowsBetween(*upto))
    ytd = F.sum(rev).over(Window.partitionBy("year", *grp).orderBy("order_date").rowsBetween(*upto))
    if frame == "rows":
        w = Window.partitionBy(*grp).orderBy("order_date")
        r90 = F.sum(rev).over(w.rowsBetween(-89, 0))
        r365 = F.sum(rev).over(w.rowsBetween(-364, 0))
        prior = F.lag(rev, 364).over(w)
    elif frame == "days":
        f = f.withColumn("_day", F.datediff("order_date", F.lit("1970-01-01").cast("date")))
        w = Window.partitionBy(*grp).orderBy("_day")
        r90 = F.sum(rev).over(w.rangeBetween(-89, 0))
        r365 = F.sum(rev).over(w.rangeBetween(-364, 0))
        prior = F.sum(rev).over(w.rangeBetween(-364, -364))
    else:
        raise ValueError(f"frame must be 'rows' or 'days', not {frame!r}")
    f = f.select("*", prior.alias("prior_year_daily_revenue"))
    p = F.col("prior_year_daily_revenue")
    yoy = F.when(p > 0, pct(cents(rev) - cents(p), cents(p)))
    return f.select(
        "order_date", "year", "quarter", "month_num", "month_name", "year_month", "year_quarter",
        "fiscal_year", "fiscal_quarter", "is_current_month", "product_line", "therapeutic_area",
        "daily_revenue", "daily_units", "daily_orders",
        mtd.cast(MONEY).alias("mtd_revenue"),
        qtd.cast(MONEY).alias("qtd_revenue"),
        ytd.cast(MONEY).alias("ytd_revenue"),
        r90.cast(MONEY).alias("rolling_90d_revenue"),
        r365.cast(MONEY).alias("rolling_365d_revenue"),
        p.cast(MONEY).alias("prior_year_daily_revenue"),
        yoy.alias("yoy_growth_pct"),
    )


# --------------------------------------------------------------------- R6
def forecast_actuals(fact: DataFrame, dim_product: DataFrame, *, as_of: dt.date,
                     updated_at=None) -> DataFrame:
    """Monthly actuals per (line, area) with empty forecast bounds."""
    from quillmart.operators.staging import _ts
    g = product_rollup(
        fact.where(F.col("order_date") <= _lit_date(as_of)), dim_product, ("product_line", "therapeutic_area"),
        {"revenue_month": F.trunc("order_date", "month")},
        {"final_net_revenue": "revenue", "net_units": "units_sold"}, "order_count")
    nul = F.lit(None).cast("decimal(14,2)")
    return g.select(
        "revenue_month", "product_line", "therapeutic_area", "revenue", "units_sold", "order_count",
        F.lit(False).alias("is_forecast"),
        nul.alias("forecast_lower_bound"),
        nul.alias("forecast_upper_bound"),
        _ts(updated_at).alias("_updated_at"),
    )
