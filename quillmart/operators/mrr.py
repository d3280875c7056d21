"""Recurring revenue: movement classification (E2) and the monthly waterfall (R4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmart.functions.exact import MONEY, pct
from quillmart.plans.joins import calendar_join


def classify_mrr(monthly: DataFrame, keys: list[str], *, as_of: dt.date, month_col: str = "month",
                 amount_col: str = "amount", carry: tuple[str, ...] = ()) -> DataFrame:
    """Turn a (keys, month, amount) table of active months into MRR events.

    Per key, ordered by month (``as_of`` only decides whether the last active
    month is already known to be followed by churn):
      * first active month                → new, +amount
      * active again after a gap          → reactivation, +amount
      * consecutive month, amount up      → expansion, +delta
      * consecutive month, amount down    → contraction, delta (negative)
      * month after an active month that is not itself active (and is not
        after ``as_of``)                  → churn, −amount of the last month
    Each input row yields at most two events, with the row's ``carry`` columns.
    The window is per key over its monthly rows, so its size is bounded by the
    number of months.
    """
    as_of_c = F.lit(as_of.isoformat()).cast("date")
    m = F.col(month_col)
    amt = F.col(amount_col).cast(MONEY)
    src = monthly.where(m.isNotNull()).select(*keys, *carry, m.alias("_m"), amt.alias("_a"))
    w = Window.partitionBy(*keys).orderBy("_m")
    src = src.select(
        "*",
        F.lag("_m").over(w).alias("_pm"),
        F.lag("_a").over(w).alias("_pa"),
        F.lead("_m").over(w).alias("_nm"),
    )
    m, a, pm, pa, nm = (F.col(c) for c in ("_m", "_a", "_pm", "_pa", "_nm"))
    nxt = F.add_months(m, 1)
    prv = F.add_months(m, -1)
    ev = F.struct
    own = (F.when(pm.isNull(), ev(m.alias("event_month"), F.lit("new").alias("event_type"), a.alias("mrr_amount")))
           .when(pm < prv, ev(m.alias("event_month"), F.lit("reactivation").alias("event_type"), a.alias("mrr_amount")))
           .when(a > pa, ev(m.alias("event_month"), F.lit("expansion").alias("event_type"),
                            (a - pa).cast(MONEY).alias("mrr_amount")))
           .when(a < pa, ev(m.alias("event_month"), F.lit("contraction").alias("event_type"),
                            (a - pa).cast(MONEY).alias("mrr_amount"))))
    churn = F.when((nm.isNull() & (nxt <= as_of_c)) | (nm > nxt),
                   ev(nxt.alias("event_month"), F.lit("churn").alias("event_type"),
                      (-a).cast(MONEY).alias("mrr_amount")))
    out = src.select(*keys, *carry, F.explode(F.array(own, churn)).alias("e")).where(F.col("e").isNotNull())
    out = out.select(*keys, *carry, "e.event_month", "e.event_type", "e.mrr_amount")
    return out.select(
        F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys],
                          F.col("event_month").cast("string"), F.col("event_type"))).alias("event_id"),
        *keys, *carry, "event_month", "event_type", "mrr_amount",
    )


def mrr_waterfall(fact_mrr: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly MRR bridge, running total and churn rate.

    Two-stage aggregation instead of four COUNT(DISTINCT): first per
    (month, customer) with flags, then per month, so no Expand multiplies the
    fact and each shuffle carries pre-aggregated rows. The running total and
    the lag run on the per-month result (one row per month), the only place a
    single-partition window is used.
    """
    abs_amt = F.abs(F.col("mrr_amount"))
    amt = F.col("mrr_amount")
    zero = F.lit(0).cast(MONEY)

    def s(flag, v):
        return F.sum(F.when(F.col(flag), v).otherwise(zero))

    per_cust = fact_mrr.groupBy("event_month", "customer_id").agg(
        s("is_new", amt).alias("n"), s("is_expansion", amt).alias("x"),
        s("is_contraction", abs_amt).alias("c"), s("is_churned", abs_amt).alias("ch"),
        s("is_reactivated", amt).alias("r"),
        F.bool_or("is_new").alias("f_new"), F.bool_or("is_churned").alias("f_churn"),
        F.bool_or("is_reactivated").alias("f_react"),
    )
    has_id = F.col("customer_id").isNotNull()

    def cnt(flag):
        return F.count(F.when(has_id & F.col(flag), 1)).cast("bigint")

    mm = per_cust.groupBy("event_month").agg(
        F.sum("n").cast(MONEY).alias("new_mrr"),
        F.sum("x").cast(MONEY).alias("expansion_mrr"),
        F.sum("c").cast(MONEY).alias("contraction_mrr"),
        F.sum("ch").cast(MONEY).alias("churned_mrr"),
        F.sum("r").cast(MONEY).alias("reactivation_mrr"),
        cnt("f_new").alias("new_customers"),
        cnt("f_churn").alias("churned_customers"),
        cnt("f_react").alias("reactivated_customers"),
        F.count(F.when(has_id, 1)).cast("bigint").alias("total_active_customers"),
    )
    dd = dim_date.select(
        F.col("date_day").alias("event_month"), "year", "quarter", "month_num", "month_name",
        "year_month", "fiscal_year", "fiscal_quarter", "is_current_month")
    mm = calendar_join(mm, dim_date, dd, "event_month")
    net = (F.col("new_mrr") + F.col("expansion_mrr") + F.col("reactivation_mrr")
           - F.col("contraction_mrr") - F.col("churned_mrr")).cast(MONEY)
    w = Window.orderBy(F.col("event_month").asc_nulls_last())
    prior = F.lag("total_active_customers", 1).over(w)
    out = mm.select(
        "event_month", "year", "quarter", "month_num", "month_name", "year_month",
        "fiscal_year", "fiscal_quarter", "is_current_month",
        "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "reactivation_mrr",
        net.alias("net_new_mrr"),
        F.sum(net).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast(MONEY).alias("cumulative_mrr"),
        "new_customers", "churned_customers", "reactivated_customers", "total_active_customers",
        prior.alias("prior_month_customers"),
        F.when(prior > 0, pct(F.col("churned_customers"), prior))
        .otherwise(F.lit(0).cast("decimal(18,2)")).alias("churn_rate_pct"),
    )
    return out.orderBy(F.col("event_month").asc_nulls_last())  # read in order of months


def customer_base(fact_mrr: DataFrame) -> DataFrame:
    """Monthly bridge of customers with recurring revenue, and churn against that base.

    Unlike ``mrr_waterfall``, which counts customers with an event: a customer belongs to the
    base from a new or reactivation event until its churn event, every calendar month between the
    first and last event has a row, and the rate divides churned customers by those
    at the month's start. A customer with both kinds of event in a month (one product
    starts, another ends) counts by its balance of events so far.
    """
    steps = (F.when(F.col("is_new") | F.col("is_reactivated"), 1).when(F.col("is_churned"), -1).otherwise(0))
    amount = F.when(F.col("event_type").isin("new", "reactivation", "expansion", "contraction", "churn"), F.col("mrr_amount"))
    per = fact_mrr.where(F.col("customer_id").isNotNull() & F.col("event_month").isNotNull()).groupBy(
        "customer_id", "event_month").agg(F.sum(steps).alias("step"), F.sum(amount).cast(MONEY).alias("net"))
    own = Window.partitionBy("customer_id").orderBy("event_month")  # a row per month of the customer
    held = F.sum("step").over(own.rowsBetween(Window.unboundedPreceding, 0))
    flow = per.select("event_month", "net", (held > 0).cast("int").alias("now"), ((held - F.col("step")) > 0).cast("int").alias("was"))
    months = flow.groupBy("event_month").agg(
        F.sum("net").cast(MONEY).alias("net_new_mrr"),
        F.count_if((F.col("now") == 1) & (F.col("was") == 0)).alias("joined_customers"),
        F.count_if((F.col("now") == 0) & (F.col("was") == 1)).alias("lost_customers"))
    w = Window.orderBy("event_month")  # a row per month
    gaps = months.withColumn("_next", F.coalesce(F.lead("event_month").over(w), F.add_months("event_month", 1)))
    month = F.explode(F.sequence("event_month", F.add_months("_next", -1), F.expr("interval 1 month")))
    dense = gaps.select("*", month.alias("month")).select(
        "month", *[F.when(F.col("month") == F.col("event_month"), F.col(c)).otherwise(F.lit(0)).alias(c)
                   for c in ("net_new_mrr", "joined_customers", "lost_customers")])
    run = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    closing = F.sum(F.col("joined_customers") - F.col("lost_customers")).over(run)
    out = dense.select(
        "month", F.col("net_new_mrr").cast(MONEY).alias("net_new_mrr"), F.sum("net_new_mrr").over(run).cast(MONEY).alias("mrr"),
        F.col("joined_customers").cast("bigint").alias("joined_customers"),
        F.col("lost_customers").cast("bigint").alias("lost_customers"),
        (closing - F.col("joined_customers") + F.col("lost_customers")).cast("bigint").alias("opening_customers"),
        closing.cast("bigint").alias("closing_customers"))
    opening = F.col("opening_customers")
    return out.withColumn("churn_rate_pct", F.when(opening > 0, pct(F.col("lost_customers"), opening)))
