"""Bronze, Silver and Gold in plain row-by-row SQL for DuckDB.

Written straight from the definitions, with the joins spelled out over date ranges and the fact's repeated rows
materialised, so it shares no method with the Spark plans. Fixed labels and cut points come from the same table.
"""

from __future__ import annotations

from shelfline.functions import bands
from shelfline.sources.star_schema_sql import BRONZE_SQL

AS_OF = "DATE '2001-08-01'"


def r(value: str, digits: int = 2) -> str:
    """Round half up in decimal."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def div(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0))"


def band(cuts: bands.Bands, value: str) -> str:
    arms = " ".join(f"WHEN {value} {test} {cut} THEN '{label}'" for test, cut, label in cuts.rows)
    return f"CASE {arms} ELSE '{cuts.otherwise}' END"


def whole(text: str) -> str:
    return f"TRY_CAST({text} AS DECIMAL(18,0))"


_STOCK = " ".join(
    f"WHEN current_stock <= reorder_point * {multiple} THEN '{label}'" for label, multiple in bands.STOCK_LEVELS
)
_TARGET = " ".join(
    f"WHEN actual_conversion_rate {test} target_conversion_rate * {multiple} THEN '{label}'"
    for test, multiple, label in bands.CONVERSION_VS_TARGET
)

TABLES: dict[str, str] = {f"bz_{name}": sql for name, sql in BRONZE_SQL.items()}

TABLES |= {
    "sv_transactions": f"""
SELECT transaction_id, transaction_date, transaction_type, n AS amount, payment_method, entity, region, account_code
FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY transaction_id ORDER BY transaction_date ASC NULLS LAST, transaction_type, n, entity) AS place
  FROM (SELECT *, {whole("REPLACE(amount, ' ', '')")} AS n FROM bz_financial_transactions) p
  WHERE n > 0) q
WHERE place = 1""",
    "sv_promotions": """
SELECT DISTINCT * FROM bz_promotions_data
WHERE NOT start_date > end_date AND discount_percentage >= 0 AND discount_percentage <= 100""",
    "sv_customers": f"""
SELECT DISTINCT *, YEAR({AS_OF}) - YEAR(date_of_birth) AS age FROM bz_customer_demographics
WHERE annual_income >= 0 AND date_of_birth IS NOT NULL AND customer_id IS NOT NULL""",
    "sv_employees": f"""
SELECT employee_id, name, date_of_birth, hire_date, department, job_title, pay AS salary, region, country,
  REPLACE(email, 'mailto:', '') AS email, YEAR({AS_OF}) - YEAR(hire_date) AS tenure_years,
  YEAR({AS_OF}) - YEAR(date_of_birth) AS age
FROM (SELECT *, {whole("REPLACE(salary, ' ', '')")} AS pay FROM bz_employee_records) p
WHERE pay > 0 AND hire_date IS NOT NULL AND employee_id IS NOT NULL""",
    "sv_suppliers": f"""
SELECT DISTINCT *, {band(bands.RELIABILITY, "reliability_score")} AS reliability_category
FROM bz_supplier_information
WHERE supplier_id IS NOT NULL AND lead_time > 0 AND reliability_score >= 0 AND reliability_score <= 1""",
    "sv_shipments": f"""
SELECT shipment_id, order_id, ship_date, estimated_delivery, shipping_method, status, cost AS shipping_cost,
  CASE WHEN destination_region <> '' THEN destination_region END AS destination_region,
  CASE WHEN destination_country <> '' THEN destination_country END AS destination_country, carrier,
  estimated_delivery - ship_date AS estimated_delivery_days,
  CASE WHEN estimated_delivery < {AS_OF} THEN 'En retard' ELSE 'Dans les temps' END AS delivery_status
FROM (SELECT *, {whole("REPLACE(shipping_cost, ' ', '')")} AS cost FROM bz_logistics_and_shipping) p
WHERE cost IS NOT NULL AND shipment_id IS NOT NULL AND estimated_delivery >= ship_date""",
    "sv_interactions": f"""
SELECT *, {band(bands.SATISFACTION, "customer_satisfaction")} AS satisfaction_category,
  CASE WHEN LOWER(resolution_status) LIKE '%resolved%' OR LOWER(resolution_status) LIKE '%closed%' THEN 1 ELSE 0 END
    AS is_resolved
FROM bz_customer_service_interactions WHERE duration_minutes >= 0 AND interaction_id IS NOT NULL""",
    "sv_campaigns": f"""
SELECT *, CASE WHEN budget > 0 AND conversion_rate > 0 THEN {div("budget", "reach * conversion_rate")} END AS cpa,
  {band(bands.CONVERSION_EFFICIENCY, "conversion_rate")} AS efficiency_category
FROM bz_marketing_campaigns
WHERE NOT start_date > end_date AND budget >= 0 AND reach >= 0 AND conversion_rate >= 0 AND conversion_rate <= 1""",
    "sv_reviews": f"""
SELECT reviewer_id, reviewer_name, rating, review_date, product_category,
  {band(bands.SENTIMENT, "rating")} AS sentiment
FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY reviewer_id ORDER BY review_date DESC NULLS FIRST, reviewer_name, rating, product_category) AS place
  FROM (
    SELECT SPLIT_PART(raw_line, ',', 1) AS reviewer_id, SPLIT_PART(raw_line, ',', 2) AS reviewer_name,
      {whole("SPLIT_PART(raw_line, ',', 3)")} AS rating, TRY_CAST(SPLIT_PART(raw_line, ',', 4) AS DATE) AS review_date,
      SPLIT_PART(raw_line, ',', 5) AS product_category
    FROM bz_product_reviews WHERE raw_line <> '') p) q
WHERE place = 1""",
    "sv_inventory": f"""
SELECT *, CASE {_STOCK} ELSE '{bands.STOCK_LEVEL_ABOVE}' END AS stock_level,
  {AS_OF} - last_restock_date AS days_since_restock
FROM bz_inventory_items WHERE product_id IS NOT NULL""",
    "sv_stores": f"""
SELECT *, CASE WHEN square_footage > 0 THEN {div("employee_count", "square_footage")} END AS employee_density
FROM bz_store_items WHERE store_id IS NOT NULL""",
    "gd_sales": f"""
SELECT t.transaction_id AS sale_id, t.transaction_date AS sale_date, t.amount AS sale_amount, t.payment_method,
  t.entity AS merchant_entity, t.region AS sale_region, t.account_code,
  YEAR(t.transaction_date) AS sale_year, MONTH(t.transaction_date) AS sale_month,
  QUARTER(t.transaction_date) AS sale_quarter, DAYOFWEEK(t.transaction_date) + 1 AS sale_day_of_week,
  CAST(DATE_TRUNC('week', t.transaction_date) AS DATE) AS sale_week_start,
  o.promotion_id, o.product_category AS promo_product_category, o.promotion_type, o.discount_percentage,
  o.start_date AS promo_start_date, o.end_date AS promo_end_date,
  CASE WHEN o.promotion_id IS NULL THEN 0 ELSE 1 END AS has_promotion,
  COALESCE(o.discount_percentage, 0) AS discount_rate,
  k.campaign_id, k.campaign_name, k.campaign_type, k.product_category AS campaign_product_category,
  k.target_audience AS campaign_target, k.budget AS campaign_budget, k.reach AS campaign_reach,
  k.conversion_rate AS campaign_conversion_rate,
  CASE WHEN k.campaign_id IS NULL THEN 0 ELSE 1 END AS has_campaign,
  CAST(t.amount AS DOUBLE) * (1 - COALESCE(o.discount_percentage, 0) / 100.0) AS net_amount,
  CASE WHEN k.campaign_id IS NOT NULL AND k.conversion_rate > 0
    THEN CAST(t.amount AS DOUBLE) * k.conversion_rate ELSE 0 END AS estimated_campaign_impact,
  {band(bands.SALE_SIZE, "t.amount")} AS amount_category,
  CASE WHEN DAYOFWEEK(t.transaction_date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type
FROM sv_transactions t
LEFT JOIN sv_promotions o ON o.region = t.region AND t.transaction_date >= o.start_date AND t.transaction_date <= o.end_date
LEFT JOIN sv_campaigns k ON k.region = t.region AND t.transaction_date >= k.start_date AND t.transaction_date <= k.end_date
WHERE t.transaction_type = 'Sale'""",
    "gd_region_days": """
SELECT sale_region, sale_date, COUNT(*) AS daily_sales_count, SUM(sale_amount) AS daily_total_revenue
FROM gd_sales GROUP BY 1, 2""",
    "gd_promotions": f"""
WITH s AS (
  SELECT promotion_id, COUNT(*) AS n, SUM(sale_amount) AS gross, SUM(net_amount) AS net, AVG(sale_amount) AS mean,
    COUNT(DISTINCT merchant_entity) AS buyers, SUM(CAST(sale_amount AS DOUBLE) - net_amount) AS cost
  FROM gd_sales WHERE promotion_id IS NOT NULL GROUP BY 1),
m AS (
  SELECT o.promotion_id, SUM(x.daily_sales_count) AS market FROM sv_promotions o
  LEFT JOIN gd_region_days x ON x.sale_region = o.region AND x.sale_date >= o.start_date AND x.sale_date <= o.end_date
  GROUP BY 1)
SELECT o.promotion_id, o.product_category, o.promotion_type, o.discount_percentage, o.start_date, o.end_date, o.region,
  o.end_date - o.start_date AS duration_days, MONTH(o.start_date) AS start_month, QUARTER(o.start_date) AS start_quarter,
  YEAR(o.start_date) AS start_year,
  CASE WHEN o.start_date > {AS_OF} THEN 'Scheduled' WHEN o.end_date < {AS_OF} THEN 'Completed'
    WHEN o.start_date <= {AS_OF} AND o.end_date >= {AS_OF} THEN 'Active' ELSE 'Unknown' END AS promotion_status,
  COALESCE(n, 0) AS total_sales, COALESCE(gross, 0) AS total_gross_revenue, COALESCE(mean, 0) AS avg_transaction_amount,
  COALESCE(buyers, 0) AS unique_customers_reached, COALESCE(cost, 0) AS total_discount_cost,
  COALESCE(net, 0) AS total_net_revenue,
  CASE WHEN cost > 0 THEN {r("(net - cost) * 100.0 / cost")} ELSE 0 END AS roi_percentage,
  CASE WHEN cost > 0 THEN {r("net / cost")} END AS revenue_per_discount_euro,
  0 AS market_share_pct,
  CASE WHEN market > 0 THEN {r("COALESCE(n, 0) * CAST(100 AS DOUBLE) / market")} ELSE 0 END AS market_share_pct_calculated,
  COALESCE(market, 0) AS total_market_sales
FROM sv_promotions o LEFT JOIN s ON s.promotion_id = o.promotion_id LEFT JOIN m ON m.promotion_id = o.promotion_id""",
    "gd_customers": f"""
WITH s AS (
  SELECT TRY_CAST(merchant_entity AS BIGINT) AS id, SUM(sale_amount) AS spent, COUNT(*) AS n, AVG(sale_amount) AS mean,
    MIN(sale_date) AS first_day, MAX(sale_date) AS last_day
  FROM gd_sales WHERE TRY_CAST(merchant_entity AS BIGINT) IS NOT NULL GROUP BY 1),
a AS (
  SELECT u.*, COALESCE(spent, 0) AS lifetime_value, COALESCE(n, 0) AS total_transactions,
    COALESCE(mean, 0) AS avg_transaction_value, COALESCE(first_day, {AS_OF}) AS first_purchase_date,
    COALESCE(last_day, {AS_OF}) AS last_purchase_date,
    COALESCE({AS_OF} - last_day, {bands.NEVER_BOUGHT_DAYS}) AS days_since_last_purchase
  FROM sv_customers u LEFT JOIN s ON s.id = u.customer_id),
g AS (
  SELECT *, {band(bands.RECENCY, "days_since_last_purchase")} AS recency_segment,
    {band(bands.MONETARY, "lifetime_value")} AS monetary_segment,
    {band(bands.FREQUENCY, "total_transactions")} AS frequency_segment FROM a)
SELECT customer_id, name AS customer_name, date_of_birth, gender, region AS customer_region,
  country AS customer_country, city AS customer_city, marital_status, annual_income, age,
  {band(bands.AGE_GROUP, "age")} AS age_group, {band(bands.INCOME_EN, "annual_income")} AS income_segment,
  lifetime_value, total_transactions, avg_transaction_value, first_purchase_date, last_purchase_date,
  days_since_last_purchase, 0 AS service_interaction_count, 0 AS avg_satisfaction_score, 0 AS complaint_count,
  CAST(NULL AS DATE) AS last_contact_date, recency_segment, monetary_segment, frequency_segment,
  CASE recency_segment
    WHEN 'Recent' THEN CASE WHEN monetary_segment IN ('VIP', 'High Value') THEN 'Champions'
      WHEN frequency_segment = 'Frequent' THEN 'Loyal Customers' ELSE 'New/Recent Customers' END
    WHEN 'Active' THEN CASE WHEN monetary_segment = 'Low Value' THEN 'Price Sensitive' ELSE 'Other' END
    ELSE CASE WHEN monetary_segment IN ('VIP', 'High Value')
      THEN CASE recency_segment WHEN 'At Risk' THEN 'At Risk High Value' ELSE 'Lost Champions' END
      WHEN monetary_segment = 'Low Value' THEN 'Price Sensitive' ELSE 'Other' END END AS customer_segment,
  CASE recency_segment WHEN 'Churned' THEN 5 WHEN 'At Risk' THEN 3 ELSE 1 END AS churn_risk_score,
  CASE WHEN recency_segment NOT IN ('Recent', 'Active') THEN 1 WHEN monetary_segment IN ('VIP', 'High Value') THEN 5
    ELSE 3 END AS loyalty_score
FROM g""",
    "gd_campaigns": f"""
WITH s AS (
  SELECT campaign_id, COUNT(*) AS n, SUM(sale_amount) AS earned, COUNT(DISTINCT merchant_entity) AS buyers,
    AVG(sale_amount) AS mean
  FROM gd_sales WHERE campaign_id IS NOT NULL GROUP BY 1),
a AS (
  SELECT k.*, COALESCE(n, 0) AS actual_sales, COALESCE(earned, 0) AS generated_revenue,
    COALESCE(buyers, 0) AS unique_customers_acquired, COALESCE(mean, 0) AS avg_transaction_value
  FROM sv_campaigns k LEFT JOIN s ON s.campaign_id = k.campaign_id),
g AS (
  SELECT campaign_id, campaign_name, campaign_type, product_category, target_audience, start_date, end_date, region,
    end_date - start_date AS campaign_duration_days, MONTH(start_date) AS start_month,
    QUARTER(start_date) AS start_quarter, YEAR(start_date) AS start_year, budget AS campaign_budget,
    reach AS estimated_reach, conversion_rate AS target_conversion_rate, actual_sales, generated_revenue,
    unique_customers_acquired, avg_transaction_value,
    CASE WHEN budget > 0 THEN {r("(CAST(generated_revenue AS DOUBLE) - budget) * 100 / budget")} ELSE 0 END
      AS roi_percentage,
    CASE WHEN budget > 0 THEN {r("CAST(generated_revenue AS DOUBLE) / budget")} ELSE 0 END AS revenue_per_euro_spent,
    CASE WHEN reach > 0 THEN {r("CAST(actual_sales AS DOUBLE) * 100 / reach", 4)} ELSE 0 END AS actual_conversion_rate,
    CASE WHEN actual_sales > 0 THEN {r("CAST(budget AS DOUBLE) / actual_sales")} END AS cost_per_acquisition,
    CASE WHEN unique_customers_acquired > 0 THEN {r("CAST(budget AS DOUBLE) / unique_customers_acquired")} END
      AS cost_per_unique_customer,
    CASE WHEN unique_customers_acquired > 0
      THEN {r("CAST(generated_revenue AS DOUBLE) / unique_customers_acquired")} ELSE 0 END AS avg_customer_lifetime_value
  FROM a)
SELECT *, {band(bands.CAMPAIGN_RATING, "roi_percentage")} AS performance_rating,
  CASE {_TARGET} ELSE '{bands.CONVERSION_BELOW}' END AS conversion_performance FROM g""",
}
