"""Registered queries: corrected forms of the marts, and checks that the own tables fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmart.operators import marts as M
from quillmart.operators import quality as QC
from quillmart.operators.mrr import customer_base
from quillmart.plans import oracle as O
from quillmart.plans.registry import _CH, _DELIV, _wh, register
from quillmart.sources import adapter

_CM = {
    "cm_orders": f"""
SELECT dc.customer_id, CAST(date_trunc('month', fs.order_date) AS DATE) AS report_month,
       CAST(COUNT(DISTINCT fs.order_id) AS BIGINT) AS order_count,
       CAST(SUM(fs.final_net_revenue) AS DECIMAL(18,2)) AS monthly_revenue,
       CAST(SUM(fs.net_units) AS BIGINT) AS monthly_units, MAX(fs.order_date) AS last_order_date,
       MAX(CASE WHEN fs.order_date <= {O.AS_OF_SQL} THEN fs.order_date END) AS upto
FROM fact_sales fs LEFT JOIN dim_customer dc ON fs.customer_key = dc.customer_key
GROUP BY 1, 2""",
    "ch_mrr": _CH["ch_mrr"],
    "cm_months": """
SELECT COALESCE(o.customer_id, m.customer_id) AS customer_id, COALESCE(o.report_month, m.event_month) AS report_month,
       o.order_count, COALESCE(o.monthly_revenue, 0) AS monthly_revenue, o.monthly_units, o.last_order_date, o.upto,
       m.mrr_added, m.mrr_lost, m.is_churned, m.is_new, m.is_reactivated, m.is_expansion
FROM cm_orders o FULL JOIN ch_mrr m ON o.customer_id IS NOT DISTINCT FROM m.customer_id
                                   AND o.report_month IS NOT DISTINCT FROM m.event_month""",
    "cm_run": """
SELECT *, MAX(upto) OVER (PARTITION BY customer_id) AS latest,
       SUM(monthly_revenue) OVER (PARTITION BY customer_id ORDER BY report_month NULLS FIRST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS to_date,
       SUM(monthly_revenue) OVER (PARTITION BY customer_id) AS ltv
FROM cm_months""",
}


@register("customer_months", O.sql_for(f"""
SELECT dc.customer_id, dc.account_name, dc.segment, dc.tier, dc.region, dc.is_active, r.report_month,
       CAST(COALESCE(r.order_count, 0) AS BIGINT) AS order_count,
       CAST(COALESCE(r.monthly_revenue, 0) AS DECIMAL(18,2)) AS monthly_revenue,
       CAST(COALESCE(r.monthly_units, 0) AS BIGINT) AS monthly_units,
       r.last_order_date, r.latest AS latest_order_date,
       CAST({O.AS_OF_SQL} - r.latest AS INTEGER) AS days_since_latest_order,
       CAST(COALESCE(r.mrr_added, 0) AS DECIMAL(18,2)) AS mrr_added,
       CAST(COALESCE(r.mrr_lost, 0) AS DECIMAL(18,2)) AS mrr_lost,
       COALESCE(r.is_churned, FALSE) AS is_churned, COALESCE(r.is_new, FALSE) AS is_new,
       COALESCE(r.is_reactivated, FALSE) AS is_reactivated, COALESCE(r.is_expansion, FALSE) AS is_expansion,
       CAST(COALESCE(r.to_date, 0) AS DECIMAL(18,2)) AS value_to_date,
       CAST(COALESCE(r.ltv, 0) AS DECIMAL(18,2)) AS lifetime_value
FROM dim_customer dc LEFT JOIN cm_run r ON dc.customer_id = r.customer_id""", _CM))
def q_customer_months(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return M.customer_months(w.sales, w.fact_mrr, w.dims["customer"], as_of=w.as_of)


_CB = {
    "cb_steps": """
SELECT customer_id, event_month,
       SUM(CASE WHEN is_new OR is_reactivated THEN 1 WHEN is_churned THEN -1 ELSE 0 END) AS step,
       SUM(mrr_amount) AS net
FROM fact_mrr WHERE customer_id IS NOT NULL AND event_month IS NOT NULL GROUP BY 1, 2""",
    "cb_held": """
SELECT *, SUM(step) OVER (PARTITION BY customer_id ORDER BY event_month) AS held FROM cb_steps""",
    "cb_month": """
SELECT event_month, SUM(net) AS net, COUNT(*) FILTER (WHERE held > 0 AND NOT held - step > 0) AS joined,
       COUNT(*) FILTER (WHERE NOT held > 0 AND held - step > 0) AS lost
FROM cb_held GROUP BY 1""",
    "cb_spine": """
SELECT CAST(unnest(generate_series(CAST(min(event_month) AS TIMESTAMP), CAST(max(event_month) AS TIMESTAMP),
                                   INTERVAL 1 MONTH)) AS DATE) AS month FROM cb_month""",
    "cb_run": """
SELECT s.month, COALESCE(m.net, 0) AS net, COALESCE(m.joined, 0) AS joined, COALESCE(m.lost, 0) AS lost,
       SUM(COALESCE(m.net, 0)) OVER (ORDER BY s.month) AS mrr,
       SUM(COALESCE(m.joined, 0) - COALESCE(m.lost, 0)) OVER (ORDER BY s.month) AS closing
FROM cb_spine s LEFT JOIN cb_month m ON m.event_month = s.month""",
}


@register("mrr_customer_base", O.sql_for(f"""
SELECT month, CAST(net AS DECIMAL(18,2)) AS net_new_mrr, CAST(mrr AS DECIMAL(18,2)) AS mrr,
       CAST(joined AS BIGINT) AS joined_customers, CAST(lost AS BIGINT) AS lost_customers,
       CAST(closing - joined + lost AS BIGINT) AS opening_customers, CAST(closing AS BIGINT) AS closing_customers,
       CASE WHEN closing - joined + lost > 0
            THEN {O.pct('CAST(lost AS BIGINT)', 'CAST(closing - joined + lost AS BIGINT)')} END AS churn_rate_pct
FROM cb_run""", _CB))
def q_mrr_customer_base(spark, sf_dir):
    return customer_base(_wh(spark, sf_dir).fact_mrr)


_PE = {
    "pe_monthly": """
SELECT customer_id, product_id, CAST(date_trunc('month', order_date) AS DATE) AS m,
       CAST(SUM(net_amount) AS DECIMAL(18,2)) AS a
FROM raw_orders WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND order_date IS NOT NULL GROUP BY 1, 2, 3""",
    "pe_win": """
SELECT *, lag(m) OVER w AS pm, lag(a) OVER w AS pa, lead(m) OVER w AS nm
FROM pe_monthly WINDOW w AS (PARTITION BY customer_id, product_id ORDER BY m)""",
    "pe_ev": f"""
SELECT customer_id, product_id, m AS event_month,
       CASE WHEN pm IS NULL THEN 'new' WHEN pm < m - INTERVAL 1 MONTH THEN 'reactivation'
            WHEN a > pa THEN 'expansion' WHEN a < pa THEN 'contraction' END AS event_type,
       CASE WHEN pm IS NULL OR pm < m - INTERVAL 1 MONTH THEN a ELSE CAST(a - pa AS DECIMAL(18,2)) END AS mrr_amount
FROM pe_win
UNION ALL
SELECT customer_id, product_id, CAST(m + INTERVAL 1 MONTH AS DATE), 'churn', CAST(-a AS DECIMAL(18,2))
FROM pe_win WHERE (nm IS NULL AND m + INTERVAL 1 MONTH <= {O.AS_OF_SQL}) OR nm > m + INTERVAL 1 MONTH""",
}


@register("mrr_events_by_product", O.sql_for("""
SELECT md5(concat_ws('|', CAST(customer_id AS VARCHAR), CAST(product_id AS VARCHAR), CAST(event_month AS VARCHAR),
                     event_type)) AS event_id,
       customer_id, product_id, event_month, event_type, CAST(mrr_amount AS DECIMAL(18,2)) AS mrr_amount
FROM pe_ev WHERE event_type IS NOT NULL""", _PE))
def q_mrr_events_by_product(spark, sf_dir):
    w = _wh(spark, sf_dir)
    return adapter.product_mrr_events(w.raw["orders"], w.as_of)


DELIVERY_CHECKS = [("order_id", "unique", None), ("order_id", "not_null", None), ("quantity", "at_least", 1),
                   ("net_amount", "greater_than", 0)]


@register("dq_deliveries", O.sql_for("""
SELECT 'order_deliveries' AS table_name, check_name, column_name, CAST(violations AS BIGINT) AS violations,
       violations = 0 AS passed
FROM (
  SELECT 'unique' AS check_name, 'order_id' AS column_name,
         (SELECT COUNT(*) FROM (SELECT order_id FROM deliveries GROUP BY 1 HAVING COUNT(*) > 1) x) AS violations
  UNION ALL SELECT 'not_null', 'order_id', COUNT(*) FILTER (WHERE order_id IS NULL) FROM deliveries
  UNION ALL SELECT 'at_least', 'quantity', COUNT(*) FILTER (WHERE quantity < 1) FROM deliveries
  UNION ALL SELECT 'greater_than', 'net_amount', COUNT(*) FILTER (WHERE NOT net_amount > 0) FROM deliveries
) t""", _DELIV))
def q_dq_deliveries(spark, sf_dir):
    """Checks of the orders as delivered: restated lines come twice, and some are returned whole."""
    return QC.dq_table(_wh(spark, sf_dir).order_deliveries, "order_deliveries", DELIVERY_CHECKS)
