"""Business reports advertised alongside the marts: sales summary with MoM/YoY,
rep performance with rank in region, territory scorecard, returns by reason,
cost variance, order pricing, seasonality index; plus dedupe of re-delivered
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmart.functions.exact import MONEY, cents, div_round, from_cents, pct
from quillmart.operators.marts import product_rollup
from quillmart.plans.joins import dim_column, lookup_join


def _month_index(c: str):
    return F.year(c) * 12 + F.month(c)


# --------------------------------------------------------------------- A1
def sales_summary(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Revenue per (month, product line, territory) with calendar-aware MoM and YoY.

    The prior month / prior year values come from range frames over a month
    index (exactly 1 and 12 months back, NULL when that month had no sales):
    one shuffle on the series keys, no self-join.
    """
    territory = dim_column(fact, "territory")
    f = lookup_join(fact, dims["territory"].select(territory, "territory_name"), territory)
    g = product_rollup(f, dims["product"], ("product_line",),
                       {"revenue_month": F.trunc("order_date", "month"), "territory_name": F.col("territory_name")},
                       {"final_net_revenue": "revenue", "net_units": "units"})
    g = g.withColumn("_mi", _month_index("revenue_month"))
    w = Window.partitionBy("product_line", "territory_name").orderBy("_mi")
    pm = F.sum("revenue").over(w.rangeBetween(-1, -1))
    py = F.sum("revenue").over(w.rangeBetween(-12, -12))
    g = g.select("*", pm.cast(MONEY).alias("prior_month_revenue"), py.cast(MONEY).alias("prior_year_revenue"))
    r, p1, p12 = F.col("revenue"), F.col("prior_month_revenue"), F.col("prior_year_revenue")
    return g.select(
        "revenue_month", "product_line", "territory_name", "revenue", "units",
        "prior_month_revenue", "prior_year_revenue",
        F.when(p1 > 0, pct(cents(r) - cents(p1), cents(p1))).alias("mom_growth_pct"),
        F.when(p12 > 0, pct(cents(r) - cents(p12), cents(p12))).alias("yoy_growth_pct"),
    )


# --------------------------------------------------------------------- A2
def rep_performance(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Revenue and quota attainment per (rep, year), ranked within region and year."""
    rep = dim_column(fact, "rep")
    f = fact.select("order_date", rep, "final_net_revenue", "order_id")
    g = f.groupBy(rep, F.year("order_date").cast("int").alias("year")).agg(
        F.sum("final_net_revenue").cast(MONEY).alias("revenue"),
        F.count("order_id").cast("bigint").alias("order_lines"),
    )
    reps = dims["rep"].select(*dict.fromkeys((rep, "rep_id")), "rep_name", "region", "annual_quota")
    g = lookup_join(g, reps, rep)
    q = F.col("annual_quota")
    g = g.select(
        "rep_id", "rep_name", "region", "year", "revenue", "order_lines", "annual_quota",
        F.when(q > 0, pct(cents("revenue"), cents(q))).alias("quota_attainment_pct"),
    )
    # One row per rep and year: a window holds the reps of one region.
    best = Window.partitionBy("region", "year").orderBy(F.col("revenue").desc_nulls_last())
    return g.withColumn("rank_in_region", F.rank().over(best))


# --------------------------------------------------------------------- A3
def territory_health(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Territory scorecard: revenue, customers, reps, average discount, returns."""
    territory, customer, rep = (dim_column(fact, d) for d in ("territory", "customer", "rep"))
    f = fact.select(F.col(territory).alias("_t"), F.col(customer).alias("_c"), F.col(rep).alias("_r"), "final_net_revenue",
                    "units_sold", "units_returned", "discount_pct")
    # Two steps instead of two distinct counts: those would multiply the fact's rows (Expand).
    pairs = f.groupBy("_t", "_c", "_r").agg(
        F.sum(cents("final_net_revenue")).alias("revenue"), F.count("*").alias("order_lines"),
        F.sum(F.round(F.col("discount_pct") * 1_000_000, 0).cast("bigint")).alias("_disc_u"),
        F.count("discount_pct").alias("_disc_n"),
        F.sum("units_sold").alias("units_sold"), F.sum("units_returned").alias("units_returned"))
    sums = [F.sum(c).alias(c) for c in ("revenue", "order_lines", "_disc_u", "_disc_n", "units_sold", "units_returned")]
    first = F.count("_c").alias("customers")
    by_rep = pairs.groupBy("_t", "_r").agg(F.count(F.lit(1)).alias("_n"))
    by_customer = pairs.groupBy("_t", "_c").agg(*sums).groupBy("_t").agg(first, *sums)
    reps = by_rep.groupBy(F.col("_t").alias("_u")).agg(F.count("_r").alias("reps"))
    g = by_customer.join(reps, F.col("_t").eqNullSafe(F.col("_u")), "left").select(
        F.col("_t").alias(territory), from_cents(F.col("revenue"), wide=True).alias("revenue"),
        *(F.col(c).cast("bigint").alias(c) for c in ("customers", "reps", "order_lines", "_disc_u", "_disc_n",
                                                      "units_sold", "units_returned")))
    t = dims["territory"].select(*dict.fromkeys((territory, "territory_id")), "territory_name", "region", "zone")
    g = lookup_join(g, t, territory)
    return g.select(
        "territory_id", "territory_name", "region", "zone", "revenue", "customers", "reps",
        "order_lines",
        F.when(F.col("_disc_n") > 0,
               from_cents(div_round(F.col("_disc_u"), F.col("_disc_n") * 100))).alias("avg_discount_pct"),
        "units_sold", "units_returned",
        F.when(F.col("units_sold") > 0, pct(F.col("units_returned"), F.col("units_sold")))
        .alias("return_rate_pct"),
    )


# --------------------------------------------------------------------- A4
def returns_by_reason(stg_returns: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Per return reason: count, units, value at net price, share of all returns."""
    o = stg_orders.select("order_id", "net_price")
    r = stg_returns.select("order_id", "return_reason", "quantity_returned").join(o, "order_id", "left")
    g = r.groupBy("return_reason").agg(
        F.count("*").cast("bigint").alias("return_count"),
        F.sum("quantity_returned").cast("bigint").alias("units_returned"),
        F.sum(F.col("quantity_returned") * F.col("net_price")).cast(MONEY).alias("returned_value"),
    )
    total = F.sum("return_count").over(Window.partitionBy())  # one row per reason: a handful of rows
    return g.select("*", pct(F.col("return_count"), total).alias("share_of_returns_pct"))


# --------------------------------------------------------------------- A9
def cost_variance(stg_costs: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Standard vs actual cost per (month, product line)."""
    c = lookup_join(stg_costs.select("product_id", "cost_month", "standard_cost", "actual_cost"),
                    dim_product.select("product_id", "product_line"), "product_id")
    g = c.groupBy("cost_month", "product_line").agg(
        F.count("*").cast("bigint").alias("products"),
        F.sum("standard_cost").cast(MONEY).alias("total_standard_cost"),
        F.sum("actual_cost").cast(MONEY).alias("total_actual_cost"),
    )
    var = (F.col("total_actual_cost") - F.col("total_standard_cost")).cast(MONEY)
    return g.select("*", var.alias("total_variance"),
                    pct(cents(var), cents("total_standard_cost"), 4).alias("variance_pct"))


# --------------------------------------------------------------------- E1
def order_pricing(raw_orders: DataFrame) -> DataFrame:
    """Price build-up check per order line: discount amount and effective discount."""
    g, n = F.col("gross_amount"), F.col("net_amount")
    return raw_orders.select(
        "order_id", "quantity", "list_price", "discount_pct", "net_price", "gross_amount", "net_amount",
        (g - n).cast(MONEY).alias("discount_amount"),
        F.when(g > 0, pct(cents(g) - cents(n), cents(g), 4)).alias("effective_discount_pct"),
    )


# --------------------------------------------------------------------- E3
def seasonality_index(actuals: DataFrame) -> DataFrame:
    """Mean revenue of each calendar month ÷ mean monthly revenue (company level)."""
    a = actuals.where(~F.col("is_forecast") & F.col("revenue_month").isNotNull())
    monthly = a.groupBy("revenue_month").agg(F.sum("revenue").cast(MONEY).alias("revenue"))
    by_moy = monthly.groupBy(F.month("revenue_month").cast("int").alias("month_num")).agg(
        F.sum("revenue").cast(MONEY).alias("revenue"), F.count("*").cast("bigint").alias("months"))
    allw = Window.partitionBy()  # twelve rows at most
    overall = F.sum("revenue").over(allw).cast("double") / F.sum("months").over(allw)
    mean_m = F.col("revenue").cast("double") / F.col("months")
    return by_moy.select("month_num", "months", "revenue",
                         F.round(mean_m / overall, 4).alias("seasonality_index"))


# --------------------------------------------------------------------- A7
def dedupe_latest(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """Keep, per key, the row that is last by ``order_by`` (ties broken by the
    remaining columns). An aggregation (``max``) rather than a row_number
    window: partial aggregation runs map-side, so a key with many copies is
    reduced before the shuffle and never lands whole in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in order_by]
    latest = F.max(F.struct(*[F.col(c) for c in order_by + rest]))  # with the key: every column once
    return df.groupBy(*key).agg(latest.alias("_r")).select(
        *[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in df.columns])
