"""Facts: sales (order line), cost of goods (product × month), MRR (event).

Every fact row survives its dimension lookups (left joins): an unknown
product, customer, rep or date gives a NULL key, never a lost row.
Aggregations that feed a join (returns per order, revenue per product-month)
run before the join, so the join cannot fan out and the shuffle carries one
row per key.
"""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.functions.exact import MONEY, cents, pct, sum_money
from quillmart.functions.keys import surrogate_key
from quillmart.plans.joins import HOME, calendar_join, home_join, key_lookup, lookup_join, order_key


def _date_keys(dim_date: DataFrame, on: str) -> DataFrame:
    return dim_date.select(F.col("date_day").alias(on), "date_key")


def returns_by_order(stg_returns: DataFrame) -> DataFrame:
    """Σ returned quantity per order (map-side partial aggregation before the shuffle, if any)."""
    return (stg_returns.groupBy(*order_key(stg_returns))
            .agg(F.sum("quantity_returned").cast("bigint").alias("total_returned_qty")))


IDS = ("product_id", "customer_id", "rep_id", "territory_id")


def fact_sales(orders: DataFrame, returns: DataFrame, dims: dict[str, DataFrame], ids: bool = False,
               used: Mapping[str, DataFrame] = MappingProxyType({})) -> DataFrame:
    """Order-line fact; a return counts against the order whatever its date.

    Returns are joined first, while the rows are narrow, and the lookups leave the rows
    where that join has put them, by order. ``ids``: the dimensions' ids beside their keys (null
    where these are), for marts that move the rows again. Where both orders and returns have a ``HOME``, they lie by it
    and stay there; the fact keeps that of the orders. ``used``: cheaper frames that hold all of an id's values.
    """
    carry = [c for c in (HOME,) if c in orders.columns]
    if HOME in returns.columns:
        f = home_join(orders, returns_by_order(returns), "order_id")
    else:
        f = orders.join(returns_by_order(returns), "order_id", "left")  # an aggregate: sized at run time
    f = calendar_join(f, dims["date"], _date_keys(dims["date"], "order_date"), "order_date")
    f = key_lookup(f, dims["product"], "product_id", "product_key", rows=used.get("product_id", orders))
    f = key_lookup(f, dims["customer"], "customer_id", "customer_key", rows=used.get("customer_id", orders))
    # One rep lookup serves both the key and the daily quota.
    f = key_lookup(f, dims["rep"], "rep_id", "rep_key", carry=("daily_quota",), rows=used.get("rep_id", orders))
    f = key_lookup(f, dims["territory"], "territory_id", "territory_key", rows=orders)
    returned = F.coalesce(F.col("total_returned_qty"), F.lit(0).cast("bigint"))
    returned_rev = (returned * F.col("net_price")).cast(MONEY)
    quota = F.col("daily_quota")
    return f.select(
        surrogate_key("order_id").alias("sales_key"),
        "order_id", "date_key", "product_key", "customer_key", "rep_key", "territory_key",
        "order_date",
        F.col("quantity").alias("units_sold"),
        returned.alias("units_returned"),
        (F.col("quantity") - returned).cast("bigint").alias("net_units"),
        "list_price", "discount_pct", "net_price", "gross_amount",
        F.col("net_amount").alias("net_revenue"),
        (F.col("gross_amount") - F.col("net_amount")).cast(MONEY).alias("discount_amount"),
        returned_rev.alias("returned_revenue"),
        (F.col("net_amount") - returned_rev).cast(MONEY).alias("final_net_revenue"),
        F.when(quota > 0, pct(cents("net_amount"), cents(quota)))
        .otherwise(F.lit(0).cast("decimal(18,2)")).alias("daily_quota_attainment_pct"),
        *[F.when(F.col(i.replace("_id", "_key")).isNotNull(), F.col(i)).alias(i) for i in (IDS if ids else ())],
        *carry,
    )


REVENUE = ("mr_net_revenue", "mr_units_sold")


def monthly_product_revenue(orders: DataFrame) -> DataFrame:
    """Revenue before returns and units per (month, product)."""
    return (orders.groupBy(F.trunc("order_date", "month").alias("revenue_month"), "product_id")
            .agg(sum_money("net_amount").alias("mr_net_revenue"),
                 F.sum("quantity").cast("bigint").alias("mr_units_sold")))


def fact_cogs(costs: DataFrame, orders: DataFrame, dims: dict[str, DataFrame],
              product_months: DataFrame | None = None) -> DataFrame:
    """Product × cost month; cost rows are preserved, months without cost vanish.

    ``product_months``: ``monthly_product_revenue`` of ``orders`` where it is already written. Costs
    that carry that revenue themselves are joined to none.
    """
    f = calendar_join(costs, dims["date"], _date_keys(dims["date"], "cost_month"), "cost_month")
    f = lookup_join(f, dims["product"].select("product_id", "product_key"), "product_id")
    if not set(REVENUE) <= set(costs.columns):
        mr = product_months if product_months is not None else monthly_product_revenue(orders)
        f = f.join(mr.withColumnRenamed("revenue_month", "cost_month"), ["cost_month", "product_id"], "left")
    units = F.coalesce(F.col("mr_units_sold"), F.lit(0).cast("bigint"))
    rev = F.coalesce(F.col("mr_net_revenue"), F.lit(0).cast(MONEY))
    cogs = (F.col("actual_cost") * units).cast(MONEY)
    gp = (rev - cogs).cast(MONEY)
    return f.select(
        surrogate_key("cost_id").alias("cogs_key"),
        "cost_id", "date_key", "product_key", "product_id", "cost_month",
        "standard_cost", "actual_cost", "cost_variance", "cost_variance_pct",
        units.alias("units_sold"),
        rev.alias("net_revenue"),
        cogs.alias("total_cogs"),
        gp.alias("gross_profit"),
        F.when(rev > 0, pct(cents(gp), cents(rev)))
        .otherwise(F.lit(0).cast("decimal(18,2)")).alias("gross_margin_pct"),
    )


def fact_mrr(events: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Event-grain MRR fact with type flags; contraction is neither added nor lost."""
    f = calendar_join(events, dims["date"], _date_keys(dims["date"], "event_month"), "event_month")
    f = lookup_join(f, dims["customer"].select("customer_id", "customer_key"), "customer_id")
    f = lookup_join(f, dims["product"].select("product_id", "product_key"), "product_id")
    t = F.col("event_type")
    amt = F.col("mrr_amount")
    zero = F.lit(0).cast(MONEY)
    return f.select(
        surrogate_key("event_id").alias("mrr_key"),
        "event_id", "date_key", "customer_key", "product_key", "customer_id", "product_id",
        "event_month", "event_type", "mrr_amount",
        (t == "new").alias("is_new"),
        (t == "churn").alias("is_churned"),
        (t == "reactivation").alias("is_reactivated"),
        (t == "expansion").alias("is_expansion"),
        (t == "contraction").alias("is_contraction"),
        F.when(t.isin("new", "reactivation", "expansion"), amt.cast(MONEY)).otherwise(zero).alias("mrr_added"),
        F.when(t == "churn", F.abs(amt).cast(MONEY)).otherwise(zero).alias("mrr_lost"),
    )
