"""Registered queries: name → (Spark builder, DuckDB oracle SQL or None).

Every builder reads the driver tables under ``sf_dir`` (whole tables) and
returns a lazy DataFrame; every oracle is an independent single SELECT.
"""

from __future__ import annotations

import os
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.functions.keys import surrogate_key
from quillmart.operators import marts as M
from quillmart.plans import oracle as O
from quillmart.plans.joins import HOME
from quillmart.plans.warehouse import Warehouse
from quillmart.sources.driver import DRIVER_TABLES, read_table, version

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_warehouses: weakref.WeakKeyDictionary[SparkSession, dict[tuple, Warehouse]] = weakref.WeakKeyDictionary()


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One lazily built Warehouse (a set of logical plans) per session and state of the input."""
    held = _warehouses.setdefault(spark, {})
    key = (sf_dir, *(version(spark, os.path.join(sf_dir, f"{t}.parquet")) for t in DRIVER_TABLES))
    if key not in held:
        held[key] = Warehouse(spark, sf_dir)
    return held[key]


def use_warehouse(w: Warehouse) -> None:
    """Let the registered queries of its session and input read ``w`` (for instance a written layer)."""
    _wh(w.spark, w.sf_dir)
    held = _warehouses[w.spark]
    held.update({k: w for k in held if k[0] == w.sf_dir})


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder once, for a query that reads it several times."""
    from quillmart.session import release_shuffles, scratch_path
    path = scratch_path(spark, name)
    df.write.parquet(path)
    release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------- staging
def _stg(name: str):
    def fn(spark, sf_dir):
        return _wh(spark, sf_dir).stg[name]
    fn.__name__ = f"stg_{name}"
    return fn


_STG_NAMES = {
    "stg_orders": "orders", "stg_products": "products", "stg_customers": "customers",
    "stg_reps": "reps", "stg_costs": "costs", "stg_returns": "returns",
    "stg_territories": "territories", "stg_mrr_events": "mrr_events",
}
for _q, _t in _STG_NAMES.items():
    register(_q, O.sql_for(f"SELECT * FROM {_q}"))(_stg(_t))


# ---------------------------------------------------------- dimensions
def _dim(name: str):
    def fn(spark, sf_dir):
        return _wh(spark, sf_dir).dims[name]
    fn.__name__ = f"dim_{name}"
    return fn


for _d in ("date", "product", "customer", "rep", "territory"):
    register(f"dim_{_d}", O.sql_for(f"SELECT * FROM dim_{_d}"))(_dim(_d))


@register("surrogate_keys", O.sql_for(f"""
SELECT order_id,
       {O.sk('order_id')} AS sales_key,
       md5(concat_ws('-', COALESCE(CAST(customer_id AS VARCHAR), {O.NULL_KEY}),
                          COALESCE(CAST(product_id AS VARCHAR), {O.NULL_KEY}))) AS customer_product_key,
       md5(concat_ws('-', COALESCE(CAST(rep_id AS VARCHAR), {O.NULL_KEY}),
                          COALESCE(CAST(territory_id AS VARCHAR), {O.NULL_KEY}),
                          COALESCE(CAST(NULL AS VARCHAR), {O.NULL_KEY}))) AS rep_territory_key
FROM stg_orders"""))
def q_surrogate_keys(spark, sf_dir):
    o = _wh(spark, sf_dir).stg["orders"]
    return o.select(
        "order_id",
        surrogate_key("order_id").alias("sales_key"),
        surrogate_key("customer_id", "product_id").alias("customer_product_key"),
        surrogate_key("rep_id", "territory_id", F.lit(None)).alias("rep_territory_key"),
    )


# --------------------------------------------------------------- facts
@register("fact_sales", O.sql_for("SELECT * FROM fact_sales"))
def q_fact_sales(spark, sf_dir):
    return _wh(spark, sf_dir).fact_sales


@register("fact_cogs", O.sql_for("SELECT * FROM fact_cogs"))
def q_fact_cogs(spark, sf_dir):
    return _wh(spark, sf_dir).fact_cogs


@register("fact_mrr", O.sql_for("SELECT * FROM fact_mrr"))
def q_fact_mrr(spark, sf_dir):
    return _wh(spark, sf_dir).fact_mrr


@register("mrr_events", O.sql_for("SELECT * FROM raw_mrr_events"))
def q_mrr_events(spark, sf_dir):
    return _wh(spark, sf_dir).raw["mrr_events"]


# --------------------------------------------------------------- marts
@register("sales_performance", O.sql_for("""
SELECT fs.order_id, fs.order_date, dd.year, dd.quarter, dd.month_num, dd.month_name, dd.year_month,
       dd.year_quarter, dd.fiscal_year, dd.fiscal_quarter, dd.is_current_month, dd.is_actual,
       dp.product_code, dp.product_name, dp.therapeutic_area, dp.product_line, dp.formulation,
       dp.value_tier, dc.account_name, dc.segment AS customer_segment, dc.tier AS customer_tier,
       dc.region AS customer_region, dc.is_active AS customer_is_active,
       dr.rep_name, dr.manager_name, dr.annual_quota, dr.monthly_quota,
       dt.territory_name, dt.region AS territory_region, dt.zone,
       fs.units_sold, fs.units_returned, fs.net_units, fs.gross_amount, fs.net_revenue,
       fs.discount_amount, fs.final_net_revenue, fs.discount_pct, fs.daily_quota_attainment_pct,
       FALSE AS is_forecast
FROM fact_sales fs
LEFT JOIN dim_date dd ON fs.date_key = dd.date_key
LEFT JOIN dim_product dp ON fs.product_key = dp.product_key
LEFT JOIN dim_customer dc ON fs.customer_key = dc.customer_key
LEFT JOIN dim_rep dr ON fs.rep_key = dr.rep_key
LEFT JOIN dim_territory dt ON fs.territory_key = dt.territory_key"""))
def q_sales_performance(spark, sf_dir):
    return _wh(spark, sf_dir).sales_performance()


@register("cogs_margin", O.sql_for(f"""
SELECT fc.cost_month, dd.year, dd.quarter, dd.month_num, dd.month_name, dd.year_month, dd.year_quarter,
       dd.fiscal_year, dd.fiscal_quarter, dd.is_current_month,
       dp.product_code, dp.product_name, dp.therapeutic_area, dp.product_line, dp.value_tier,
       fc.standard_cost, fc.actual_cost, fc.cost_variance, fc.cost_variance_pct,
       fc.units_sold, fc.net_revenue, fc.total_cogs, fc.gross_profit, fc.gross_margin_pct,
       {O.from_cents(O.div_round(f"SUM({O.cents('fc.gross_margin_pct')}) OVER w3 * 100",
                                 "COUNT(fc.gross_margin_pct) OVER w3"), 4)} AS rolling_3m_margin_pct,
       LAG(fc.gross_margin_pct, 1) OVER w AS prior_month_margin_pct,
       CAST(fc.gross_margin_pct - LAG(fc.gross_margin_pct, 1) OVER w AS DECIMAL(18,2)) AS margin_mom_delta
FROM fact_cogs fc
LEFT JOIN dim_date dd ON fc.date_key = dd.date_key
LEFT JOIN dim_product dp ON fc.product_key = dp.product_key
WINDOW w AS (PARTITION BY fc.product_id ORDER BY fc.cost_month),
       w3 AS (PARTITION BY fc.product_id ORDER BY fc.cost_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def q_cogs_margin(spark, sf_dir):
    return _wh(spark, sf_dir).cogs_margin()


_CH = {
    "ch_monthly_orders": """
SELECT dc.customer_id, CAST(date_trunc('month', fs.order_date) AS DATE) AS activity_month,
       CAST(COUNT(DISTINCT fs.order_id) AS BIGINT) AS order_count,
       CAST(SUM(fs.final_net_revenue) AS DECIMAL(18,2)) AS monthly_revenue,
       CAST(SUM(fs.net_units) AS BIGINT) AS monthly_units,
       MAX(fs.order_date) AS last_order_date
FROM fact_sales fs LEFT JOIN dim_customer dc ON fs.customer_key = dc.customer_key
GROUP BY 1, 2""",
    "ch_mrr": """
SELECT customer_id, event_month,
       CAST(SUM(mrr_added) AS DECIMAL(18,2)) AS mrr_added,
       CAST(SUM(mrr_lost) AS DECIMAL(18,2)) AS mrr_lost,
       BOOL_OR(is_churned) AS is_churned, BOOL_OR(is_new) AS is_new,
       BOOL_OR(is_reactivated) AS is_reactivated, BOOL_OR(is_expansion) AS is_expansion
FROM fact_mrr GROUP BY 1, 2""",
    "ch_ltv": """
SELECT dc.customer_id, CAST(SUM(fs.final_net_revenue) AS DECIMAL(18,2)) AS lifetime_value
FROM fact_sales fs LEFT JOIN dim_customer dc ON fs.customer_key = dc.customer_key
GROUP BY 1""",
}


@register("customer_health", O.sql_for(f"""
SELECT dc.customer_id, dc.account_name, dc.segment, dc.tier, dc.tier_rank, dc.region,
       dc.contract_start_date, dc.contract_end_date, dc.is_active, dc.tenure_days,
       COALESCE(mo.activity_month, m.event_month) AS report_month,
       CAST(COALESCE(mo.order_count, 0) AS BIGINT) AS order_count,
       CAST(COALESCE(mo.monthly_revenue, 0) AS DECIMAL(18,2)) AS monthly_revenue,
       CAST(COALESCE(mo.monthly_units, 0) AS BIGINT) AS monthly_units,
       mo.last_order_date,
       CAST({O.AS_OF_SQL} - mo.last_order_date AS INTEGER) AS days_since_last_order,
       CAST(COALESCE(m.mrr_added, 0) AS DECIMAL(18,2)) AS mrr_added,
       CAST(COALESCE(m.mrr_lost, 0) AS DECIMAL(18,2)) AS mrr_lost,
       COALESCE(m.is_churned, FALSE) AS is_churned,
       COALESCE(m.is_new, FALSE) AS is_new_customer,
       COALESCE(m.is_reactivated, FALSE) AS is_reactivated,
       COALESCE(m.is_expansion, FALSE) AS is_expansion,
       CAST(COALESCE(ltv.lifetime_value, 0) AS DECIMAL(18,2)) AS lifetime_value
FROM dim_customer dc
LEFT JOIN ch_monthly_orders mo ON dc.customer_id = mo.customer_id
LEFT JOIN ch_mrr m ON dc.customer_id = m.customer_id
                  AND COALESCE(mo.activity_month, DATE '1900-01-01') = m.event_month
LEFT JOIN ch_ltv ltv ON dc.customer_id = ltv.customer_id""", _CH))
def q_customer_health(spark, sf_dir):
    return _wh(spark, sf_dir).customer_health()


_WF = {
    "wf_monthly": """
SELECT event_month,
       CAST(SUM(CASE WHEN is_new THEN mrr_amount ELSE 0 END) AS DECIMAL(18,2)) AS new_mrr,
       CAST(SUM(CASE WHEN is_expansion THEN mrr_amount ELSE 0 END) AS DECIMAL(18,2)) AS expansion_mrr,
       CAST(SUM(CASE WHEN is_contraction THEN abs(mrr_amount) ELSE 0 END) AS DECIMAL(18,2)) AS contraction_mrr,
       CAST(SUM(CASE WHEN is_churned THEN abs(mrr_amount) ELSE 0 END) AS DECIMAL(18,2)) AS churned_mrr,
       CAST(SUM(CASE WHEN is_reactivated THEN mrr_amount ELSE 0 END) AS DECIMAL(18,2)) AS reactivation_mrr,
       CAST(COUNT(DISTINCT CASE WHEN is_new THEN customer_id END) AS BIGINT) AS new_customers,
       CAST(COUNT(DISTINCT CASE WHEN is_churned THEN customer_id END) AS BIGINT) AS churned_customers,
       CAST(COUNT(DISTINCT CASE WHEN is_reactivated THEN customer_id END) AS BIGINT) AS reactivated_customers,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS total_active_customers
FROM fact_mrr GROUP BY 1""",
}

_NET = ("(mm.new_mrr + mm.expansion_mrr + mm.reactivation_mrr - mm.contraction_mrr - mm.churned_mrr)")


@register("mrr_waterfall", O.sql_for(f"""
SELECT mm.event_month, dd.year, dd.quarter, dd.month_num, dd.month_name, dd.year_month,
       dd.fiscal_year, dd.fiscal_quarter, dd.is_current_month,
       mm.new_mrr, mm.expansion_mrr, mm.contraction_mrr, mm.churned_mrr, mm.reactivation_mrr,
       CAST({_NET} AS DECIMAL(18,2)) AS net_new_mrr,
       CAST(SUM({_NET}) OVER (ORDER BY mm.event_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(18,2)) AS cumulative_mrr,
       mm.new_customers, mm.churned_customers, mm.reactivated_customers, mm.total_active_customers,
       LAG(mm.total_active_customers, 1) OVER (ORDER BY mm.event_month) AS prior_month_customers,
       CASE WHEN LAG(mm.total_active_customers, 1) OVER (ORDER BY mm.event_month) > 0
            THEN {O.pct('mm.churned_customers', 'LAG(mm.total_active_customers, 1) OVER (ORDER BY mm.event_month)')}
            ELSE CAST(0 AS DECIMAL(18,2)) END AS churn_rate_pct
FROM wf_monthly mm
LEFT JOIN dim_date dd ON mm.event_month = dd.date_day""", _WF))
def q_mrr_waterfall(spark, sf_dir):
    return _wh(spark, sf_dir).mrr_waterfall()


_TI = {
    "ti_daily": f"""
SELECT fs.order_date, dp.product_line, dp.therapeutic_area,
       CAST(SUM(fs.final_net_revenue) AS DECIMAL(18,2)) AS daily_revenue,
       CAST(SUM(fs.units_sold) AS BIGINT) AS daily_units,
       CAST(COUNT(DISTINCT fs.order_id) AS BIGINT) AS daily_orders
FROM fact_sales fs LEFT JOIN dim_product dp ON fs.product_key = dp.product_key
WHERE fs.order_date <= {O.AS_OF_SQL}
GROUP BY 1, 2, 3""",
}

_TI_COLS = """dr.order_date, dd.year, dd.quarter, dd.month_num, dd.month_name, dd.year_month,
       dd.year_quarter, dd.fiscal_year, dd.fiscal_quarter, dd.is_current_month,
       dr.product_line, dr.therapeutic_area, dr.daily_revenue, dr.daily_units, dr.daily_orders"""
_TO_DATE = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_GRP = "dr.product_line, dr.therapeutic_area"


def _ti_sql(rolling90: str, rolling365: str, prior: str, joins: str = "") -> str:
    return f"""
SELECT order_date, year, quarter, month_num, month_name, year_month, year_quarter, fiscal_year,
       fiscal_quarter, is_current_month, product_line, therapeutic_area,
       daily_revenue, daily_units, daily_orders,
       CAST(mtd AS DECIMAL(18,2)) AS mtd_revenue,
       CAST(qtd AS DECIMAL(18,2)) AS qtd_revenue,
       CAST(ytd AS DECIMAL(18,2)) AS ytd_revenue,
       CAST(r90 AS DECIMAL(18,2)) AS rolling_90d_revenue,
       CAST(r365 AS DECIMAL(18,2)) AS rolling_365d_revenue,
       CAST(prior AS DECIMAL(18,2)) AS prior_year_daily_revenue,
       CASE WHEN prior > 0
            THEN {O.pct(O.cents('daily_revenue') + ' - ' + O.cents('prior'), O.cents('prior'))} END
            AS yoy_growth_pct
FROM (
  SELECT {_TI_COLS},
         SUM(dr.daily_revenue) OVER (PARTITION BY dd.year, dd.month_num, {_GRP} ORDER BY dr.order_date {_TO_DATE}) AS mtd,
         SUM(dr.daily_revenue) OVER (PARTITION BY dd.year, dd.quarter, {_GRP} ORDER BY dr.order_date {_TO_DATE}) AS qtd,
         SUM(dr.daily_revenue) OVER (PARTITION BY dd.year, {_GRP} ORDER BY dr.order_date {_TO_DATE}) AS ytd,
         {rolling90} AS r90,
         {rolling365} AS r365,
         {prior} AS prior
  FROM ti_daily dr
  LEFT JOIN dim_date dd ON dr.order_date = dd.date_day
  {joins}
) x"""


@register("time_intelligence", O.sql_for(_ti_sql(
    f"SUM(dr.daily_revenue) OVER (PARTITION BY {_GRP} ORDER BY dr.order_date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)",
    f"SUM(dr.daily_revenue) OVER (PARTITION BY {_GRP} ORDER BY dr.order_date ROWS BETWEEN 364 PRECEDING AND CURRENT ROW)",
    f"LAG(dr.daily_revenue, 364) OVER (PARTITION BY {_GRP} ORDER BY dr.order_date)"), _TI))
def q_time_intelligence(spark, sf_dir):
    return _wh(spark, sf_dir).time_intelligence("rows")


@register("time_intelligence_days", O.sql_for(_ti_sql(
    f"SUM(dr.daily_revenue) OVER (PARTITION BY {_GRP} ORDER BY dr.order_date RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW)",
    f"SUM(dr.daily_revenue) OVER (PARTITION BY {_GRP} ORDER BY dr.order_date RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND CURRENT ROW)",
    "py.daily_revenue",
    """LEFT JOIN ti_daily py ON py.product_line IS NOT DISTINCT FROM dr.product_line
                      AND py.therapeutic_area IS NOT DISTINCT FROM dr.therapeutic_area
                      AND py.order_date = dr.order_date - 364"""), _TI))
def q_time_intelligence_days(spark, sf_dir):
    return _wh(spark, sf_dir).time_intelligence("days")


@register("forecast_actuals", O.sql_for(f"""
SELECT CAST(date_trunc('month', fs.order_date) AS DATE) AS revenue_month, dp.product_line,
       dp.therapeutic_area,
       CAST(SUM(fs.final_net_revenue) AS DECIMAL(18,2)) AS revenue,
       CAST(SUM(fs.net_units) AS BIGINT) AS units_sold,
       CAST(COUNT(DISTINCT fs.order_id) AS BIGINT) AS order_count,
       FALSE AS is_forecast,
       CAST(NULL AS DECIMAL(14,2)) AS forecast_lower_bound,
       CAST(NULL AS DECIMAL(14,2)) AS forecast_upper_bound,
       {O.RUN_TS_SQL} AS _updated_at
FROM fact_sales fs LEFT JOIN dim_product dp ON fs.product_key = dp.product_key
WHERE fs.order_date <= {O.AS_OF_SQL}
GROUP BY 1, 2, 3"""))
def q_forecast_actuals(spark, sf_dir):
    return _wh(spark, sf_dir).forecast_actuals()


# ------------------------------------------------------------ forecasting
from quillmart.operators import forecast as FC  # noqa: E402
from quillmart.operators import quality as QC  # noqa: E402
from quillmart.operators import reports as RP  # noqa: E402

UPSERT_OLD_CUTOFF = "2000-10-01"  # the earlier forecast run saw months before this


@register("monthly_series", O.sql_for("SELECT * FROM fc_series"))
def q_monthly_series(spark, sf_dir):
    return _wh(spark, sf_dir).series


@register("forecast_linear", O.sql_for(O.linear_forecast_sql("fc_series")))
def q_forecast_linear(spark, sf_dir):
    return FC.forecast_linear(_wh(spark, sf_dir).series)


_HW = O.holt_winters_ctes("fc_series", "product_line", "hw", FC.GRID, FC.STEPS, FC.RANGES)


@register("forecast_holt_winters", O.sql_for(f"""
SELECT revenue_month, product_line, CAST(NULL AS VARCHAR) AS therapeutic_area, revenue,
       CAST(NULL AS BIGINT) AS units_sold, CAST(NULL AS BIGINT) AS order_count, TRUE AS is_forecast,
       forecast_lower_bound, forecast_upper_bound
FROM ({O.holt_winters_select("product_line", "hw")}) f""", _HW))
def q_forecast_holt_winters(spark, sf_dir):
    return FC.forecast_holt_winters(_wh(spark, sf_dir).series)


_UP = {
    "up_old_series": f"SELECT * FROM fc_series WHERE revenue_month < DATE '{UPSERT_OLD_CUTOFF}'",
    "up_old": O.linear_forecast_sql("up_old_series"),
    "up_new": O.linear_forecast_sql("fc_series"),
    "up_existing": """
SELECT * FROM fa_actuals
UNION ALL
SELECT *, CAST(NULL AS TIMESTAMP) AS _updated_at FROM up_old""",
}


@register("forecast_upsert", O.sql_for("""
SELECT * FROM up_existing e
WHERE NOT COALESCE(e.is_forecast
                   AND e.revenue_month IN (SELECT revenue_month FROM up_new)
                   AND e.product_line IN (SELECT product_line FROM up_new), FALSE)
UNION ALL
SELECT *, CAST(NULL AS TIMESTAMP) AS _updated_at FROM up_new""", _UP))
def q_forecast_upsert(spark, sf_dir):
    w = _wh(spark, sf_dir)
    old = FC.forecast_linear(w.series.where(F.col("revenue_month") < F.lit(UPSERT_OLD_CUTOFF).cast("date")))
    existing = w.actuals.unionByName(old, allowMissingColumns=True)
    return FC.upsert_forecast(existing, FC.forecast_linear(w.series))


@register("forecast_table", ORACLE["forecast_upsert"])
def q_forecast_table(spark, sf_dir):
    """The forecast job on a written table: an earlier run, then the present one twice."""
    from quillmart.session import scratch_path
    from quillmart.sources.versions import VersionedTable
    w = _wh(spark, sf_dir)
    path = scratch_path(spark, "forecast-table")
    table = VersionedTable(spark, path)
    table.replace(w.actuals)
    series = _written(spark, FC.monthly_series(table.read()), "series")  # of the actuals as written
    old = FC.forecast_linear(series.where(F.col("revenue_month") < F.lit(UPSERT_OLD_CUTOFF).cast("date")))
    for forecast in (old, FC.forecast_linear(series), FC.forecast_linear(series), old.limit(0)):
        FC.write_forecast(spark, path, forecast)
    return FC.read_forecast(spark, path)


@register("monthly_series_dense", O.sql_for(f"""
SELECT CAST(g.month AS DATE) AS revenue_month, s.product_line, CAST(COALESCE(f.revenue, 0) AS DECIMAL(18,2)) AS revenue
FROM (SELECT product_line, min(revenue_month) AS a, max(revenue_month) AS b FROM fc_series
      WHERE revenue_month < date_trunc('month', {O.AS_OF_SQL}) GROUP BY 1) s
CROSS JOIN LATERAL (SELECT unnest(generate_series(CAST(s.a AS TIMESTAMP), CAST(s.b AS TIMESTAMP), INTERVAL 1 MONTH)) AS month) g
LEFT JOIN fc_series f ON f.product_line IS NOT DISTINCT FROM s.product_line AND f.revenue_month = CAST(g.month AS DATE)"""))
def q_monthly_series_dense(spark, sf_dir):
    """Every month of a series, 0 where it had no revenue; the as-of month itself is not over yet."""
    w = _wh(spark, sf_dir)
    return FC.monthly_series(w.actuals, densify="zero", before=w.as_of)


@register("forecast_levels", O.sql_for("""
SELECT revenue_month,
       CASE WHEN GROUPING(product_line, therapeutic_area) = 3 THEN 'company'
            WHEN GROUPING(product_line, therapeutic_area) = 1 THEN 'product_line'
            ELSE 'therapeutic_area' END AS level,
       CASE WHEN GROUPING(product_line, therapeutic_area) = 3 THEN 'ALL'
            WHEN GROUPING(product_line, therapeutic_area) = 1 THEN product_line
            ELSE therapeutic_area END AS series,
       concat_ws(':',
           CASE WHEN GROUPING(product_line, therapeutic_area) = 3 THEN 'company'
                WHEN GROUPING(product_line, therapeutic_area) = 1 THEN 'product_line'
                ELSE 'therapeutic_area' END,
           COALESCE(CASE WHEN GROUPING(product_line, therapeutic_area) = 3 THEN 'ALL'
                         WHEN GROUPING(product_line, therapeutic_area) = 1 THEN product_line
                         ELSE therapeutic_area END, 'NULL')) AS series_key,
       CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue
FROM fa_actuals
WHERE NOT is_forecast AND revenue_month IS NOT NULL
GROUP BY GROUPING SETS ((revenue_month), (revenue_month, product_line),
                        (revenue_month, therapeutic_area))"""))
def q_forecast_levels(spark, sf_dir):
    return FC.forecast_levels(_wh(spark, sf_dir).actuals)


_LEVELS = {
    "lv_input": """
SELECT revenue_month, 'company:ALL' AS k, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue
FROM fa_actuals WHERE NOT is_forecast AND revenue_month IS NOT NULL GROUP BY 1
UNION ALL
SELECT revenue_month, 'product_line:' || product_line, CAST(SUM(revenue) AS DECIMAL(18,2))
FROM fa_actuals WHERE NOT is_forecast AND revenue_month IS NOT NULL AND product_line IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT revenue_month, 'therapeutic_area:' || therapeutic_area, CAST(SUM(revenue) AS DECIMAL(18,2))
FROM fa_actuals WHERE NOT is_forecast AND revenue_month IS NOT NULL AND therapeutic_area IS NOT NULL GROUP BY 1, 2""",
    **O.holt_winters_ctes("lv_input", "k", "lv", FC.GRID, FC.STEPS, FC.RANGES),
}


@register("forecast_levels_fit", O.sql_for(f"""
SELECT revenue_month, split_part(k, ':', 1) AS level, substr(k, instr(k, ':') + 1) AS series, revenue,
       forecast_lower_bound, forecast_upper_bound
FROM ({O.holt_winters_select("k", "lv")}) f""", _LEVELS))
def q_forecast_levels_fit(spark, sf_dir):
    return FC.forecast_levels_fit(FC.forecast_levels(_wh(spark, sf_dir).actuals))


# ---------------------------------------------------------- data quality
# Raw columns that may be empty: keys to other tables, and an open contract's end.
NULLABLE = {
    "customers": ["territory_id", "contract_end_date"], "reps": ["territory_id"],
    "orders": ["product_id", "customer_id", "rep_id", "territory_id"], "costs": ["product_id"],
    "returns": ["order_id"], "mrr_events": ["customer_id", "product_id"],
}


def raw_checks() -> dict[str, list[tuple]]:
    """Keys are unique, required columns are there, domains and signs hold."""
    from quillmart.constants import EVENT_TYPES, RAW_COLUMNS, SEGMENTS, TIERS
    more = {
        "products": [("product_code", "unique", None)],
        "customers": [("segment", "accepted_values", SEGMENTS), ("tier", "accepted_values", TIERS)],
        "costs": [("standard_cost", "greater_than", 0), ("actual_cost", "greater_than", 0)],
        "mrr_events": [("event_type", "accepted_values", EVENT_TYPES)],
    }
    return {t: [(cols[0], "unique", None)]
            + [(c, "not_null", None) for c in cols if c not in NULLABLE.get(t, [])] + more.get(t, [])
            for t, cols in RAW_COLUMNS.items()}


def gold_checks() -> dict[str, list[tuple]]:
    """Columns that the marts' readers rely on."""
    return {
        "sales_performance": [("order_id", "not_null", None), ("order_date", "not_null", None)],
        "cogs_margin": [("cost_month", "not_null", None)],
        "customer_health": [("customer_id", "not_null", None)],
        "mrr_waterfall": [("event_month", "unique", None), ("event_month", "not_null", None)],
        "time_intelligence": [("order_date", "not_null", None)],
        "forecast_actuals": [("revenue_month", "not_null", None)],
    }


def silver_checks() -> dict[str, list[tuple]]:
    from quillmart.constants import EVENT_TYPES, VALUE_TIERS
    def key(*cols):
        return [c for col in cols for c in ((col, "unique", None), (col, "not_null", None))]
    return {
        "dim_date": key("date_key", "date_day"),
        "dim_product": key("product_key", "product_id") + [("value_tier", "accepted_values", VALUE_TIERS)],
        "dim_customer": key("customer_key", "customer_id"),
        "dim_rep": key("rep_key", "rep_id") + [("annual_quota", "greater_than", 0)],
        "dim_territory": key("territory_key", "territory_id"),
        "fact_sales": key("sales_key", "order_id") + [("date_key", "not_null", None), ("net_revenue", "greater_than", 0),
                                                      ("units_sold", "at_least", 1)],
        "fact_cogs": key("cogs_key") + [("date_key", "not_null", None)],
        "fact_mrr": key("mrr_key") + [("date_key", "not_null", None), ("event_type", "accepted_values", EVENT_TYPES)],
    }


def _dq_sql() -> str:
    parts, marts = [], {}
    specs = {**{f"raw_{t}": c for t, c in raw_checks().items()}, **silver_checks(),
             **{f"gold_{t}": c for t, c in gold_checks().items()}}
    for table, checks in specs.items():
        name = table.removeprefix("raw_").removeprefix("gold_")
        if table.startswith("gold_"):
            marts[table] = ORACLE[name]
        for col, chk, arg in checks:
            if chk == "unique":
                v = (f"(SELECT COUNT(*) FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL "
                     f"GROUP BY {col} HAVING COUNT(*) > 1) x)")
            elif chk == "not_null":
                v = f"(SELECT COUNT(*) FROM {table} WHERE {col} IS NULL)"
            elif chk == "accepted_values":
                vals = ", ".join(f"'{a}'" for a in arg)
                v = f"(SELECT COUNT(*) FROM {table} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
            elif chk == "greater_than":
                v = f"(SELECT COUNT(*) FROM {table} WHERE {col} IS NOT NULL AND NOT ({col} > {arg}))"
            else:
                v = f"(SELECT COUNT(*) FROM {table} WHERE {col} IS NOT NULL AND NOT ({col} >= {arg}))"
            parts.append(f"SELECT '{name}' AS table_name, '{chk}' AS check_name, '{col}' AS column_name, "
                         f"CAST({v} AS BIGINT) AS violations")
    body = "\nUNION ALL\n".join(parts)
    return O.sql_for(f"SELECT *, violations = 0 AS passed FROM (\n{body}\n) t",
                     {t: f"SELECT * FROM ({b}) b" for t, b in marts.items()})


@register("dq_report", _dq_sql())
def q_dq_report(spark, sf_dir):
    w = _wh(spark, sf_dir)
    tables = {**{t: w.raw[t] for t in raw_checks()}, **w.homed_raw(),
              "dim_date": w.dims["date"], "dim_product": w.dims["product"],
              "dim_customer": w.dims["customer"], "dim_rep": w.dims["rep"],
              "dim_territory": w.dims["territory"], "fact_sales": w.sales if w.by_home else w.fact_sales,
              "fact_cogs": w.fact_cogs, "fact_mrr": w.fact_mrr,
              **{t: QUERIES[t](spark, sf_dir) for t in gold_checks()},
              # Its checks need no column of a dimension: narrow rows are moved instead of these.
              "sales_performance": M.sales_performance(w.sales.drop(HOME), w.dims)}
    return QC.dq_report(tables, {**raw_checks(), **silver_checks(), **gold_checks()}, w.checks_seen)


@register("dq_unique_violations", O.sql_for("""
SELECT 'events' AS table_name, 'user_id' AS column_name, CAST(user_id AS VARCHAR) AS value,
       CAST(COUNT(*) AS BIGINT) AS n_records
FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING COUNT(*) > 1
UNION ALL
SELECT 'orders' AS table_name, 'order_id' AS column_name, CAST(order_id AS VARCHAR) AS value,
       CAST(COUNT(*) AS BIGINT) AS n_records
FROM raw_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING COUNT(*) > 1
UNION ALL
SELECT 'costs', 'product_month', product_id || '@' || CAST(cost_month AS VARCHAR), CAST(COUNT(*) AS BIGINT)
FROM (SELECT CAST(product_id AS VARCHAR) AS product_id, cost_month FROM raw_costs) c
GROUP BY product_id, cost_month HAVING COUNT(*) > 1"""))
def q_dq_unique_violations(spark, sf_dir):
    w = _wh(spark, sf_dir)
    pm = w.raw["costs"].select(
        F.concat_ws("@", F.col("product_id").cast("string"), F.col("cost_month").cast("string"))
        .alias("product_month"))
    return (QC.unique_violations(read_table(spark, sf_dir, "events"), "events", "user_id")
            .unionByName(QC.unique_violations(w.raw["orders"], "orders", "order_id"))
            .unionByName(QC.unique_violations(pm, "costs", "product_month")))


_FKS = [
    ("orders", "product_id", "products", "product_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "rep_id", "reps", "rep_id"),
    ("orders", "territory_id", "territories", "territory_id"),
    ("customers", "territory_id", "territories", "territory_id"),
    ("reps", "territory_id", "territories", "territory_id"),
    ("costs", "product_id", "products", "product_id"),
    ("returns", "order_id", "orders", "order_id"),
    ("mrr_events", "customer_id", "customers", "customer_id"),
    ("mrr_events", "product_id", "products", "product_id"),
]


@register("dq_orphans", O.sql_for("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS table_name, '{fk}' AS column_name, CAST(x.{fk} AS VARCHAR) AS value,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM raw_{c} x WHERE x.{fk} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM raw_{p} y WHERE y.{pk} = x.{fk})
GROUP BY x.{fk}""" for c, fk, p, pk in _FKS) + """
UNION ALL
SELECT 'events', 'user_id', CAST(x.user_id AS VARCHAR), CAST(COUNT(*) AS BIGINT) FROM events x
WHERE x.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_customers y WHERE y.customer_id = x.user_id AND y.is_active)
GROUP BY x.user_id"""))
def q_dq_orphans(spark, sf_dir):
    w = _wh(spark, sf_dir)
    out = None
    for c, fk, p, pk in _FKS:
        part = QC.orphans(w.raw[c], c, fk, w.raw[p], pk)
        out = part if out is None else out.unionByName(part)
    active = w.stg["customers"].where("is_active")  # visitors who are no active customer
    return out.unionByName(QC.orphans(read_table(spark, sf_dir, "events"), "events", "user_id", active, "customer_id"))


@register("dq_margin_bounds", O.sql_for("""
SELECT product_id, cost_month, gross_margin_pct FROM fact_cogs
WHERE gross_margin_pct < -50 OR gross_margin_pct > 100"""))
def q_dq_margin_bounds(spark, sf_dir):
    return QC.margin_out_of_bounds(_wh(spark, sf_dir).fact_cogs)


@register("dq_mrr_non_negative", O.sql_for("""
SELECT event_id, event_type, mrr_amount FROM fact_mrr
WHERE event_type NOT IN ('churn', 'contraction') AND mrr_amount <= 0
UNION ALL
SELECT md5(CAST(c_custkey AS VARCHAR)), 'new', CAST(ROUND(c_acctbal * 100) AS DECIMAL(18,0)) * 0.01
FROM customer WHERE c_acctbal <= 0"""))
def q_dq_mrr_non_negative(spark, sf_dir):
    """The MRR fact, and account balances taken as opening amounts (some are negative)."""
    from quillmart.functions.exact import double_cents, from_cents
    opening = read_table(spark, sf_dir, "customer").select(
        F.md5(F.col("c_custkey").cast("string")).alias("event_id"), F.lit("new").alias("event_type"),
        from_cents(double_cents("c_acctbal")).alias("mrr_amount"))
    fact = _wh(spark, sf_dir).fact_mrr.select("event_id", "event_type", F.col("mrr_amount").cast("decimal(18,2)"))
    return QC.mrr_non_positive(fact.unionByName(opening))


@register("dq_future_actuals", O.sql_for(f"""
SELECT order_id, order_date FROM stg_orders WHERE order_date > {O.AS_OF_SQL}"""))
def q_dq_future_actuals(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return QC.future_actuals(w.stg["orders"], as_of=w.as_of)


@register("dq_order_invariants", O.sql_for("""
SELECT order_id, rule FROM (
  SELECT order_id, CASE WHEN net_amount > gross_amount THEN 'net_above_gross' END AS rule FROM raw_orders
  UNION ALL
  SELECT order_id, CASE WHEN NOT (discount_pct > 0 AND discount_pct < 1) THEN 'discount_out_of_range' END
  FROM raw_orders
) r WHERE rule IS NOT NULL
UNION ALL
SELECT r.order_id, 'return_without_order' FROM raw_returns r
WHERE NOT EXISTS (SELECT 1 FROM raw_orders o WHERE o.order_id = r.order_id)"""))
def q_dq_order_invariants(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return QC.order_invariants(w.raw["orders"], w.raw["returns"])


# ---------------------------------------------------------------- reports
_SS = {
    "ss_g": """
SELECT CAST(date_trunc('month', fs.order_date) AS DATE) AS revenue_month, dp.product_line,
       dt.territory_name,
       CAST(SUM(fs.final_net_revenue) AS DECIMAL(18,2)) AS revenue,
       CAST(SUM(fs.net_units) AS BIGINT) AS units
FROM fact_sales fs
LEFT JOIN dim_product dp ON fs.product_key = dp.product_key
LEFT JOIN dim_territory dt ON fs.territory_key = dt.territory_key
GROUP BY 1, 2, 3""",
}


def _same_series(a: str, b: str) -> str:
    return (f"{a}.product_line IS NOT DISTINCT FROM {b}.product_line "
            f"AND {a}.territory_name IS NOT DISTINCT FROM {b}.territory_name")


@register("sales_summary", O.sql_for(f"""
SELECT g.revenue_month, g.product_line, g.territory_name, g.revenue, g.units,
       pm.revenue AS prior_month_revenue, py.revenue AS prior_year_revenue,
       CASE WHEN pm.revenue > 0
            THEN {O.pct(O.cents('g.revenue') + ' - ' + O.cents('pm.revenue'), O.cents('pm.revenue'))} END
            AS mom_growth_pct,
       CASE WHEN py.revenue > 0
            THEN {O.pct(O.cents('g.revenue') + ' - ' + O.cents('py.revenue'), O.cents('py.revenue'))} END
            AS yoy_growth_pct
FROM ss_g g
LEFT JOIN ss_g pm ON {_same_series('pm', 'g')}
                 AND pm.revenue_month = CAST(g.revenue_month - INTERVAL 1 MONTH AS DATE)
LEFT JOIN ss_g py ON {_same_series('py', 'g')}
                 AND py.revenue_month = CAST(g.revenue_month - INTERVAL 12 MONTH AS DATE)""", _SS))
def q_sales_summary(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return RP.sales_summary(w.sales, w.dims)


@register("rep_performance", O.sql_for(f"""
SELECT r.rep_id, r.rep_name, r.region, g.year, g.revenue, g.order_lines, r.annual_quota,
       CASE WHEN r.annual_quota > 0 THEN {O.pct(O.cents('g.revenue'), O.cents('r.annual_quota'))} END
            AS quota_attainment_pct,
       CAST(rank() OVER (PARTITION BY r.region, g.year ORDER BY g.revenue DESC) AS INTEGER) AS rank_in_region
FROM (SELECT rep_key, CAST(year(order_date) AS INTEGER) AS year,
             CAST(SUM(final_net_revenue) AS DECIMAL(18,2)) AS revenue,
             CAST(COUNT(order_id) AS BIGINT) AS order_lines
      FROM fact_sales GROUP BY 1, 2) g
LEFT JOIN dim_rep r ON g.rep_key = r.rep_key"""))
def q_rep_performance(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return RP.rep_performance(w.sales, w.dims)


@register("territory_health", O.sql_for(f"""
SELECT t.territory_id, t.territory_name, t.region, t.zone, g.revenue, g.customers, g.reps,
       g.order_lines,
       CASE WHEN g.disc_n > 0 THEN {O.from_cents(O.div_round('g.disc_u', 'g.disc_n * 100'))} END
            AS avg_discount_pct,
       g.units_sold, g.units_returned,
       CASE WHEN g.units_sold > 0 THEN {O.pct('g.units_returned', 'g.units_sold')} END AS return_rate_pct
FROM (SELECT territory_key,
             CAST(SUM(final_net_revenue) AS DECIMAL(18,2)) AS revenue,
             CAST(COUNT(DISTINCT customer_key) AS BIGINT) AS customers,
             CAST(COUNT(DISTINCT rep_key) AS BIGINT) AS reps,
             CAST(COUNT(*) AS BIGINT) AS order_lines,
             CAST(SUM(CAST(ROUND(discount_pct * 1000000) AS BIGINT)) AS BIGINT) AS disc_u,
             CAST(COUNT(discount_pct) AS BIGINT) AS disc_n,
             CAST(SUM(units_sold) AS BIGINT) AS units_sold,
             CAST(SUM(units_returned) AS BIGINT) AS units_returned
      FROM fact_sales GROUP BY 1) g
LEFT JOIN dim_territory t ON g.territory_key = t.territory_key"""))
def q_territory_health(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return RP.territory_health(w.sales, w.dims)


@register("returns_by_reason", O.sql_for(f"""
SELECT r.return_reason, CAST(COUNT(*) AS BIGINT) AS return_count,
       CAST(SUM(r.quantity_returned) AS BIGINT) AS units_returned,
       CAST(SUM(r.quantity_returned * o.net_price) AS DECIMAL(18,2)) AS returned_value,
       {O.pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_of_returns_pct
FROM stg_returns r LEFT JOIN stg_orders o ON r.order_id = o.order_id
GROUP BY 1"""))
def q_returns_by_reason(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return RP.returns_by_reason(w.stg["returns"], w.stg["orders"])


@register("cost_variance", O.sql_for(f"""
SELECT c.cost_month, p.product_line, CAST(COUNT(*) AS BIGINT) AS products,
       CAST(SUM(c.standard_cost) AS DECIMAL(18,2)) AS total_standard_cost,
       CAST(SUM(c.actual_cost) AS DECIMAL(18,2)) AS total_actual_cost,
       CAST(SUM(c.actual_cost) - SUM(c.standard_cost) AS DECIMAL(18,2)) AS total_variance,
       {O.pct(O.cents('SUM(c.actual_cost) - SUM(c.standard_cost)'), O.cents('SUM(c.standard_cost)'), 4)}
            AS variance_pct
FROM stg_costs c LEFT JOIN dim_product p ON c.product_id = p.product_id
GROUP BY 1, 2"""))
def q_cost_variance(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return RP.cost_variance(w.stg["costs"], w.dims["product"])


@register("order_pricing", O.sql_for(f"""
SELECT order_id, quantity, list_price, discount_pct, net_price, gross_amount, net_amount,
       CAST(gross_amount - net_amount AS DECIMAL(18,2)) AS discount_amount,
       CASE WHEN gross_amount > 0
            THEN {O.pct(O.cents('gross_amount') + ' - ' + O.cents('net_amount'), O.cents('gross_amount'), 4)}
            END AS effective_discount_pct
FROM raw_orders"""))
def q_order_pricing(spark, sf_dir):
    return RP.order_pricing(_wh(spark, sf_dir).raw["orders"])


@register("seasonality_index", O.sql_for("""
SELECT month_num, months, revenue,
       ROUND((CAST(revenue AS DOUBLE) / months)
             / (CAST(SUM(revenue) OVER () AS DOUBLE) / SUM(months) OVER ()), 4) AS seasonality_index
FROM (SELECT CAST(month(revenue_month) AS INTEGER) AS month_num,
             CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue, CAST(COUNT(*) AS BIGINT) AS months
      FROM (SELECT revenue_month, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue
            FROM fa_actuals WHERE NOT is_forecast AND revenue_month IS NOT NULL GROUP BY 1) m
      GROUP BY 1) s"""))
def q_seasonality_index(spark, sf_dir):
    return RP.seasonality_index(_wh(spark, sf_dir).actuals)


# ------------------------------------------------------ dedupe / increments
_DELIV = {
    "deliveries": f"""
SELECT *, {O.RUN_TS_SQL} AS _loaded_at FROM raw_orders
UNION ALL
SELECT o.order_id, o.order_date, o.product_id, o.customer_id, o.rep_id, o.territory_id,
       CAST(o.quantity - r.total_returned_qty AS INTEGER) AS quantity,
       o.list_price, o.discount_pct, o.net_price,
       CAST(o.gross_amount - r.total_returned_qty * o.list_price AS DECIMAL(14,2)) AS gross_amount,
       CAST(o.net_amount - r.total_returned_qty * o.net_price AS DECIMAL(14,2)) AS net_amount,
       TIMESTAMP '2001-01-02 01:30:00' AS _loaded_at
FROM raw_orders o JOIN returns_agg r ON o.order_id = r.order_id""",
}


@register("dedupe_latest", O.sql_for("""
SELECT order_id, order_date, product_id, customer_id, rep_id, territory_id, quantity, list_price,
       discount_pct, net_price, gross_amount, net_amount, _loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _loaded_at DESC) AS rn
      FROM deliveries) d
WHERE rn = 1""", _DELIV))
def q_dedupe_latest(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return RP.dedupe_latest(w.order_deliveries, ["order_id"], ["_loaded_at"])


@register("incremental_load", O.sql_for(f"""
SELECT * FROM deliveries WHERE _loaded_at > {O.RUN_TS_SQL}""", _DELIV))
def q_incremental_load(spark, sf_dir):
    """Stream both deliveries through the incremental staging (availableNow) and read the sink."""
    import os
    from quillmart.session import scratch_path
    from quillmart.streaming.incremental import stream_increment
    w = _wh(spark, sf_dir)
    base = scratch_path(spark, "incremental")
    src = os.path.join(base, "drops")
    w.order_deliveries.write.mode("overwrite").parquet(src)
    sink = os.path.join(base, "sink")
    stream_increment(spark, src, sink, os.path.join(base, "checkpoint"),
                     schema=w.order_deliveries.schema, watermark=RUN_TS_LIT)
    return spark.read.schema(w.order_deliveries.schema).parquet(sink)


@register("incremental_twice", O.sql_for("SELECT * FROM deliveries", _DELIV))
def q_incremental_twice(spark, sf_dir):
    """Two increments into one target: the second takes what was loaded after the target's latest row."""
    import os
    from quillmart.session import scratch_path
    from quillmart.streaming.incremental import stream_increment, watermark_of
    rows = _wh(spark, sf_dir).order_deliveries
    base = scratch_path(spark, "increments")
    sink, first = os.path.join(base, "sink"), F.col("_loaded_at") <= F.lit(RUN_TS_LIT).cast("timestamp_ntz")
    drops = os.path.join(base, "drops")
    for again in (False, True):  # the second drop holds the first once more
        part = spark.read.schema(rows.schema).parquet(drops).unionByName(rows.where(~first)) if again else rows.where(first)
        part.write.mode("append").option("compression", "zstd").parquet(drops)
        stream_increment(spark, drops, sink, os.path.join(base, "checkpoint"),
                         schema=rows.schema, watermark=watermark_of(spark, sink, rows.schema))
    return spark.read.schema(rows.schema).parquet(sink)


RUN_TS_LIT = "2001-01-01 01:30:00"


# ------------------------------------------------------------ ingest / export
@register("load_daily_csv", O.sql_for("SELECT * FROM stg_orders"))
def q_load_daily_csv(spark, sf_dir):
    """Round trip: raw orders → CSV drops by month → read all drops → stage."""
    from quillmart.operators.staging import stage_orders
    from quillmart.session import scratch_path
    from quillmart.sources import csv_ingest as CI
    w = _wh(spark, sf_dir)
    raw_dir = scratch_path(spark, "raw")
    orders = w.raw["orders"]
    CI.write_daily(orders, raw_dir, "orders", "order_date", grain="month")
    back = CI.read_daily(spark, raw_dir, "orders", schema=orders.schema)
    return stage_orders(back, w.loaded_at)


@register("load_idempotent", O.sql_for("SELECT * FROM stg_returns"))
def q_load_idempotent(spark, sf_dir):
    """Drops by month loaded twice give the same rows (partition overwrite)."""
    from quillmart.operators.staging import stage_returns
    from quillmart.session import scratch_path
    from quillmart.sources import csv_ingest as CI
    w = _wh(spark, sf_dir)
    raw_dir = scratch_path(spark, "raw")
    ret = w.raw["returns"]
    CI.write_daily(ret, raw_dir, "returns", "return_date", grain="month")
    CI.write_daily(ret, raw_dir, "returns", "return_date", grain="month")
    back = CI.read_daily(spark, raw_dir, "returns", schema=ret.schema)
    return stage_returns(back, w.loaded_at)


@register("load_static_csv", O.sql_for("""
SELECT customer_id, '  "' || account_name || '",' || chr(10) || segment || ' ' AS account_name, segment,
       CAST(NULL AS VARCHAR) AS tier, region, territory_id, contract_start_date, contract_end_date, is_active
FROM raw_customers"""))
def q_load_static_csv(spark, sf_dir):
    """Static layout: quoted values with quotes, commas, line ends and outer blanks, one column
    missing, one too many; half of the rows come by a second load that appends new keys."""
    import os
    from quillmart.session import scratch_path
    from quillmart.sources import csv_ingest as CI
    customers = _wh(spark, sf_dir).raw["customers"]
    shown = customers.withColumn("account_name", F.concat(
        F.lit('  "'), "account_name", F.lit('",\n'), "segment", F.lit(" ")))
    raw_dir = scratch_path(spark, "raw")
    odd = shown.where(F.col("customer_id") % 2 == 1).drop("tier").withColumn("extra", F.lit('a,"b"'))
    odd.write.options(**CI.CSV_FORM).csv(os.path.join(raw_dir, "static", "customers.csv"))
    CI.append_static(shown.withColumn("tier", F.lit(None).cast("string")), raw_dir, "customers")
    back = CI.read_static(spark, raw_dir, {"customers": customers.schema})
    return back["customers"]


@register("load_dated_csv", O.sql_for("""
SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS load_date FROM raw_orders WHERE order_date IS NOT NULL"""))
def q_load_dated_csv(spark, sf_dir):
    """Dated layout ``<date>/orders.csv``, all dates; a folder that is no date is passed over."""
    import os
    from quillmart.session import scratch_path
    from quillmart.sources import csv_ingest as CI
    orders = _wh(spark, sf_dir).raw["orders"]
    raw_dir = scratch_path(spark, "raw")
    CI.write_dated(orders, raw_dir, "orders", "order_date", grain="month")
    some = orders
    if CI.list_files(spark, os.path.join(raw_dir, "*", "orders.csv")):  # a few rows of the drops, without building orders anew
        some = spark.read.schema(CI.text_schema("orders")).options(**CI.CSV_FORM).csv(os.path.join(raw_dir, "*", "orders.csv"))
    some.limit(5).write.options(**CI.CSV_FORM).csv(os.path.join(raw_dir, "not-a-date", "orders.csv"))
    return CI.read_dated(spark, raw_dir, "orders", schema=orders.schema)


@register("load_one_day_csv", O.sql_for("""
SELECT *, CAST(date_trunc('month', return_date) AS DATE) AS load_date FROM raw_returns
WHERE date_trunc('month', return_date) = (
  SELECT date_trunc('month', return_date) FROM raw_returns WHERE return_date IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""))
def q_load_one_day_csv(spark, sf_dir):
    """Dated layout, one date only: the drop with the most rows."""
    from quillmart.session import scratch_path
    from quillmart.sources import csv_ingest as CI
    returns = _wh(spark, sf_dir).raw["returns"]
    raw_dir = scratch_path(spark, "raw")
    CI.write_dated(returns, raw_dir, "returns", "return_date", grain="month")
    month = F.trunc("return_date", "month").alias("month")
    most = returns.where("return_date IS NOT NULL").groupBy(month).count().orderBy(F.desc("count"), "month").head()["month"]
    return CI.read_dated(spark, raw_dir, "returns", most, schema=returns.schema)


def _column_hash(column: str):
    """Order-free hash of a column's values as text: the sum of 32 bits of each value's md5."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("NULL"))
    return F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")).cast("bigint").alias(column)


_EXPORTED = {
    "mart_cogs_margin": "cogs_margin", "mart_customer_health": "customer_health", "mart_mrr_waterfall": "mrr_waterfall",
    "mart_sales_performance": "sales_performance", "mart_time_intelligence": "time_intelligence",
}
_HASHED = {  # columns compared, by mart
    "mart_sales_performance": ["order_id", "order_date", "year_quarter", "product_code", "account_name", "rep_name",
                               "territory_name", "units_sold", "net_units", "final_net_revenue", "is_actual"],
    "mart_cogs_margin": ["cost_month", "product_code", "value_tier", "units_sold", "total_cogs", "gross_margin_pct",
                         "rolling_3m_margin_pct", "prior_month_margin_pct"],
    "mart_customer_health": ["customer_id", "segment", "tier_rank", "report_month", "order_count", "monthly_revenue",
                             "mrr_added", "mrr_lost", "is_churned", "lifetime_value"],
    "mart_mrr_waterfall": ["event_month", "new_mrr", "net_new_mrr", "cumulative_mrr", "total_active_customers",
                           "churn_rate_pct"],
    "mart_time_intelligence": ["order_date", "product_line", "daily_revenue", "daily_orders", "ytd_revenue",
                               "rolling_90d_revenue", "yoy_growth_pct"],
    "mart_forecast": ["revenue_month", "product_line", "revenue", "is_forecast", "forecast_upper_bound"],
}


def _hash_sql(bodies: dict[str, str], columns: dict[str, list[str]]) -> str:
    """Row count and value hash of the columns of each table, given the SQL of its rows."""
    parts = []
    for table in columns:
        for c in columns[table]:
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS row_count, "
                f"CAST(SUM(CAST('0x' || substr(md5(COALESCE(CAST({c} AS VARCHAR), 'NULL')), 1, 8) AS BIGINT)) AS BIGINT) "
                f"AS value_hash FROM e_{table}")
    ctes = ",\n".join(f"e_{m} AS ({b})" for m, b in bodies.items())
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(parts)


def _hashes(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """The same of DataFrames, one pass over each."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("_n"), *[_column_hash(c) for c in columns[name]])
        part = one.select(F.explode(F.array(*[F.struct(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col("_n").alias("row_count"),
            F.col(c).alias("value_hash")) for c in columns[name]])).alias("e")).select("e.*")
        out = part if out is None else out.unionByName(part)
    return out


_EXPORT_BODIES = {m: ORACLE[q] for m, q in _EXPORTED.items()} | {"mart_forecast": O.sql_for(
    "SELECT * EXCLUDE (_updated_at) FROM fa_actuals UNION ALL SELECT * FROM up_new", _UP)}


@register("export_roundtrip", _hash_sql(_EXPORT_BODIES, _HASHED))
def q_export_roundtrip(spark, sf_dir):
    """Export the six marts as dated snappy Parquet, read each back, hash its columns' values."""
    import datetime as dt
    from quillmart.session import scratch_path
    from quillmart.sources.export import export_all
    w = _wh(spark, sf_dir)
    marts = {m: QUERIES[q](spark, sf_dir) for m, q in _EXPORTED.items()}
    actuals = _written(spark, w.actuals, "actuals")
    marts["mart_forecast"] = FC.upsert_forecast(actuals, FC.forecast_linear(FC.monthly_series(actuals)))
    res = export_all(marts, scratch_path(spark, "export"), dt.date(2001, 1, 1))
    if res["failed"]:
        raise RuntimeError(f"export failed: {res['failed']}")
    return _hashes({name: spark.read.parquet(path) for name, path in res["ok"]}, _HASHED)


from quillmart.plans import registry_tables, registry_variants  # noqa: E402,F401 - they register their queries
