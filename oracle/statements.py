"""One DuckDB statement per registered query, written over the shared tables."""

from __future__ import annotations

from oracle.compose import statement
from oracle.tables import AS_OF, band, div, r
from shelfline.functions import bands
from shelfline.operators import checks
from shelfline.plans import explore
from shelfline.plans.registry import SHOWN_CAMPAIGNS, SHOWN_PROMOTIONS

_SOLD = "SELECT * FROM sv_transactions WHERE transaction_type = 'Sale'"
_WORD = "NULLIF(REGEXP_EXTRACT(entity, '([A-Za-z]+)'), '')"

_PROMO_DETAILS = (
    "promotion_id:t product_category:t promotion_type:t discount_percentage:f start_date:d end_date:d region:t"
    " duration_days:i promotion_status:t total_sales:i total_gross_revenue:f total_discount_cost:f"
    " total_net_revenue:f roi_percentage:f revenue_per_discount_euro:f unique_customers_reached:i market_share_pct:i"
    " avg_transaction_amount:f"
)
_CAMPAIGN_DETAILS = (
    "campaign_id:t campaign_name:t campaign_type:t product_category:t target_audience:t start_date:d end_date:d"
    " region:t campaign_duration_days:i campaign_budget:i estimated_reach:i target_conversion_pct:f actual_sales:i"
    " generated_revenue:f unique_customers_acquired:i avg_transaction_value:f roi_percentage:f"
    " revenue_per_euro_spent:f actual_conversion_pct:f cost_per_acquisition:f cost_per_unique_customer:f"
    " avg_customer_lifetime_value:f performance_rating:t conversion_performance:t"
)


def _names(columns: str) -> list[str]:
    return [item.split(":")[0] for item in columns.split()]


_PORTFOLIO = (
    "SELECT *, target_conversion_rate * 100 AS target_conversion_pct, actual_conversion_rate * 100 AS"
    " actual_conversion_pct FROM gd_campaigns WHERE campaign_budget > 0"
)


def _promos_by(key: str, extra: str, tail: str = "") -> str:
    return f"""
SELECT {key}, COUNT(*) AS promotion_count, SUM(total_gross_revenue) AS total_revenue,
  SUM(total_discount_cost) AS total_discount, AVG(roi_percentage) AS avg_roi, SUM(total_sales) AS total_transactions,
  {extra}
FROM gd_promotions WHERE {key} IS NOT NULL GROUP BY {key} {tail}"""


_PROMO_COMMON = "promotion_count:i total_revenue:f total_discount:f avg_roi:f total_transactions:i"
_PROMO_TYPE = _promos_by(
    "promotion_type",
    "AVG(discount_percentage) AS avg_discount_pct, AVG(revenue_per_discount_euro) AS avg_revenue_per_euro,"
    " SUM(unique_customers_reached) AS total_customers",
)
_PROMO_REGION = _promos_by(
    "region",
    "SUM(unique_customers_reached) AS total_customers, AVG(market_share_pct) AS avg_market_share,"
    " AVG(market_share_pct_calculated) AS avg_market_share_calculated",
)
_PROMO_CATEGORY = _promos_by(
    "product_category",
    "AVG(discount_percentage) AS avg_discount_pct, AVG(avg_transaction_amount) AS avg_ticket",
    "ORDER BY total_revenue DESC NULLS FIRST, product_category LIMIT 15",
)


def _campaigns_by(key: str, extra: str, tail: str = "") -> str:
    return f"""
SELECT {key}, COUNT(*) AS campaign_count, SUM(campaign_budget) AS total_budget,
  SUM(generated_revenue) AS total_revenue, AVG(roi_percentage) AS avg_roi,
  AVG(actual_conversion_rate) * 100 AS avg_conversion_rate, {extra}
FROM gd_campaigns WHERE {key} IS NOT NULL GROUP BY {key} {tail}"""


_CAMPAIGN_COMMON = "campaign_count:i total_budget:i total_revenue:f avg_roi:f avg_conversion_rate:f"
_CAMPAIGN_TYPE = _campaigns_by(
    "campaign_type",
    "AVG(revenue_per_euro_spent) AS avg_revenue_per_euro, SUM(unique_customers_acquired) AS total_customers,"
    " AVG(cost_per_acquisition) AS avg_cpa",
)
_CAMPAIGN_REGION = _campaigns_by(
    "region",
    "SUM(unique_customers_acquired) AS total_customers, AVG(cost_per_unique_customer) AS avg_customer_cost",
)
_CAMPAIGN_CATEGORY = _campaigns_by(
    "product_category",
    "SUM(actual_sales) AS total_sales, AVG(avg_transaction_value) AS avg_ticket",
    "ORDER BY avg_roi DESC NULLS FIRST, product_category LIMIT 15",
)


def _tests(source: str, tests: list[tuple[str, str, str]]) -> str:
    arms = [
        f"SELECT '{name}' AS test_name, COUNT(*) AS failed_records, CASE WHEN COUNT(*) = 0 THEN '{checks.PASS}'"
        f" ELSE CONCAT('{checks.FAIL}', COUNT(*), ' {complaint}') END AS test_result FROM {source} WHERE {broken}"
        for name, broken, complaint in tests
    ]
    return "\nUNION ALL ".join(arms)


_TEST_COLUMNS = "test_name:t failed_records:i test_result:t"


def _ragged(parts: list[tuple[str, str]], columns: str) -> str:
    """Union of selects with differing columns, NULL where a part lacks one."""
    arms = []
    for have, select in parts:
        listed = [name if name in have.split() else f"NULL AS {name}" for name in _names(columns)]
        arms.append(f"SELECT {', '.join(listed)} FROM ({select}) p")
    return "\nUNION ALL ".join(arms)


def _best(aspect: str, key: str, source: str, order: str, count: int, shown: str) -> str:
    return f"""SELECT '{aspect}' AS aspect, ROW_NUMBER() OVER (ORDER BY {order}, {key}) AS position, {key} AS name,
  avg_roi, {shown} FROM ({source}) b WHERE avg_roi IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (ORDER BY {order}, {key}) <= {count}"""


def _profiles() -> str:
    table = {
        "financial_transactions_clean": "sv_transactions",
        "customer_demographics_clean": "sv_customers",
        "promotions_clean": "sv_promotions",
        "marketing_campaigns_clean": "sv_campaigns",
        "inventory_clean": "sv_inventory",
        "employee_records_clean": "sv_employees",
        "supplier_information_clean": "sv_suppliers",
        "logistics_and_shipping_clean": "sv_shipments",
        "customer_service_interactions_clean": "sv_interactions",
        "product_reviews_clean": "sv_reviews",
        "store_locations_clean": "sv_stores",
    }
    arms = []
    for name, domain, first, last, key in explore.PROFILES:
        low, high = (f"MIN({first})", f"MAX({last})") if first else ("CAST(NULL AS DATE)", "CAST(NULL AS DATE)")
        arms.append(
            f"SELECT '{name}' AS table_name, '{domain}' AS business_domain, '{key}' AS primary_key,"
            f" COUNT(*) AS record_count, {low} AS min_date, {high} AS max_date,"
            f" COUNT(DISTINCT {key}) AS distinct_keys FROM {table[name]}"
        )
    union = "\nUNION ALL ".join(arms)
    return (
        "SELECT *, CASE WHEN record_count = distinct_keys THEN 'OK' ELSE 'DOUBLONS POTENTIELS' END AS data_quality"
        f" FROM ({union}) u"
    )


def _layer_counts() -> str:
    bronze = {
        "customer_demographics": "bz_customer_demographics",
        "customer_service_interactions": "bz_customer_service_interactions",
        "financial_transactions": "bz_financial_transactions",
        "promotions_data": "bz_promotions_data",
        "marketing_campaigns": "bz_marketing_campaigns",
        "logistics_and_shipping": "bz_logistics_and_shipping",
        "supplier_information": "bz_supplier_information",
        "employee_records": "bz_employee_records",
        "product_reviews": "bz_product_reviews",
        "inventory_staging": "part",
        "store_locations_staging": "bz_store_items",
    }
    silver = {
        "financial_transactions_clean": "sv_transactions",
        "promotions_clean": "sv_promotions",
        "customer_demographics_clean": "sv_customers",
        "employee_records_clean": "sv_employees",
        "supplier_information_clean": "sv_suppliers",
        "logistics_and_shipping_clean": "sv_shipments",
        "customer_service_interactions_clean": "sv_interactions",
        "marketing_campaigns_clean": "sv_campaigns",
        "product_reviews_clean": "sv_reviews",
        "inventory_clean": "sv_inventory",
        "store_locations_clean": "sv_stores",
    }
    arms = [
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS record_count FROM {source}"
        for layer, tables in (("BRONZE Layer", bronze), ("SILVER Layer", silver))
        for name, source in tables.items()
    ]
    return "\nUNION ALL ".join(arms)


def _distribution(metric: str, table: str, column: str) -> str:
    return (
        f"SELECT '{metric}' AS metric, MIN({column}) AS min_value, MAX({column}) AS max_value,"
        f" AVG(CAST({column} AS DOUBLE)) AS avg_value, MEDIAN(CAST({column} AS DOUBLE)) AS median_value,"
        f" STDDEV_SAMP(CAST({column} AS DOUBLE)) AS std_dev, COUNT(*) AS sample_size FROM {table}"
    )


_LIGHTS = " ".join(
    f"WHEN metric = '{metric}' AND value {test} {cut} THEN '{label}'" for metric, test, cut, label in bands.KPI_LIGHTS
)
_TYPES_P = ", ".join(f"'{t}'" for t in SHOWN_PROMOTIONS["types"])
_TYPES_C = ", ".join(f"'{t}'" for t in SHOWN_CAMPAIGNS["types"])
_FILTERED_PROMOS = f"""SELECT * FROM gd_promotions WHERE promotion_status = 'Completed' AND promotion_type IN ({_TYPES_P})
  AND discount_percentage >= {SHOWN_PROMOTIONS["discount_from"]}
  AND discount_percentage <= {SHOWN_PROMOTIONS["discount_to"]} AND roi_percentage >= 0"""
_FILTERED_CAMPAIGNS = f"""{_PORTFOLIO} AND campaign_type IN ({_TYPES_C}) AND roi_percentage >= 0"""

_CAMPAIGN_MATCH = """sv_campaigns k LEFT JOIN ({sold}) t
  ON t.region = k.region AND t.transaction_date >= k.start_date AND t.transaction_date <= k.end_date"""

_ENTRIES: dict[str, tuple[str, str]] = {
    "clean_financial_transactions": (
        "transaction_id:t transaction_date:d transaction_type:t amount:i payment_method:t entity:t region:t"
        " account_code:t",
        "SELECT * FROM sv_transactions",
    ),
    "clean_promotions": (
        "promotion_id:t product_category:t promotion_type:t discount_percentage:f start_date:d end_date:d region:t",
        "SELECT * FROM sv_promotions",
    ),
    "clean_customer_demographics": (
        "customer_id:i name:t date_of_birth:d gender:t region:t country:t city:t marital_status:t annual_income:i"
        " age:i",
        "SELECT * FROM sv_customers",
    ),
    "clean_employee_records": (
        "employee_id:t name:t date_of_birth:d hire_date:d department:t job_title:t salary:i region:t country:t"
        " email:t tenure_years:i age:i",
        "SELECT * FROM sv_employees",
    ),
    "clean_supplier_information": (
        "supplier_id:t supplier_name:t product_category:t region:t country:t city:t lead_time:i reliability_score:f"
        " quality_rating:t reliability_category:t",
        "SELECT * FROM sv_suppliers",
    ),
    "clean_logistics": (
        "shipment_id:t order_id:i ship_date:d estimated_delivery:d shipping_method:t status:t shipping_cost:i"
        " destination_region:t destination_country:t carrier:t estimated_delivery_days:i delivery_status:t",
        "SELECT * FROM sv_shipments",
    ),
    "clean_service_interactions": (
        "interaction_id:t interaction_date:d interaction_type:t issue_category:t description:t duration_minutes:i"
        " resolution_status:t follow_up_required:t customer_satisfaction:i customer_id:i order_id:i"
        " satisfaction_category:t is_resolved:i",
        "SELECT * FROM sv_interactions",
    ),
    "clean_marketing_campaigns": (
        "campaign_id:t campaign_name:t campaign_type:t product_category:t target_audience:t start_date:d end_date:d"
        " region:t budget:i reach:i conversion_rate:f cpa:f efficiency_category:t",
        "SELECT * FROM sv_campaigns",
    ),
    "clean_product_reviews": (
        "reviewer_id:t reviewer_name:t rating:i review_date:d product_category:t sentiment:t",
        "SELECT * FROM sv_reviews",
    ),
    "flatten_inventory": (
        "product_id:t product_category:t region:t country:t warehouse:t current_stock:i reorder_point:i lead_time:i"
        " last_restock_date:d stock_level:t days_since_restock:i",
        "SELECT * FROM sv_inventory",
    ),
    "flatten_store_locations": (
        "store_id:t store_name:t store_type:t region:t country:t city:t address:t postal_code:i square_footage:f"
        " employee_count:i employee_density:f",
        "SELECT * FROM sv_stores",
    ),
    "sales_enriched": (
        "sale_id:t sale_date:d sale_amount:i payment_method:t merchant_entity:t sale_region:t account_code:t"
        " sale_year:i sale_month:i sale_quarter:i sale_day_of_week:i sale_week_start:d promotion_id:t"
        " promo_product_category:t promotion_type:t discount_percentage:f promo_start_date:d promo_end_date:d"
        " has_promotion:i discount_rate:f campaign_id:t campaign_name:t campaign_type:t"
        " campaign_product_category:t campaign_target:t campaign_budget:i campaign_reach:i"
        " campaign_conversion_rate:f has_campaign:i net_amount:f estimated_campaign_impact:f amount_category:t"
        " day_type:t",
        "SELECT * FROM gd_sales",
    ),
    "daily_sales_summary": (
        "sale_date:d sale_region:t total_transactions:i total_revenue:f avg_transaction_value:f active_promotions:i"
        " transactions_with_promo:i promo_penetration_rate:f active_campaigns:i transactions_with_campaign:i"
        " avg_discount_rate:f total_discount_given:f cc_transactions:i cash_transactions:i transfer_transactions:i",
        f"""
SELECT sale_date, sale_region, COUNT(*) AS total_transactions, SUM(sale_amount) AS total_revenue,
  AVG(CAST(sale_amount AS DOUBLE)) AS avg_transaction_value, COUNT(DISTINCT promotion_id) AS active_promotions,
  SUM(has_promotion) AS transactions_with_promo,
  {r(div("SUM(has_promotion) * 100.0", "COUNT(*)"))} AS promo_penetration_rate,
  COUNT(DISTINCT campaign_id) AS active_campaigns, SUM(has_campaign) AS transactions_with_campaign,
  AVG(discount_rate) AS avg_discount_rate, SUM(CAST(sale_amount AS DOUBLE) - net_amount) AS total_discount_given,
  COUNT(*) FILTER (WHERE payment_method = 'Credit Card') AS cc_transactions,
  COUNT(*) FILTER (WHERE payment_method = 'Cash') AS cash_transactions,
  COUNT(*) FILTER (WHERE payment_method = 'Bank Transfer') AS transfer_transactions
FROM gd_sales GROUP BY sale_date, sale_region""",
    ),
    "daily_region_sales": (
        "sale_region:t sale_date:d daily_sales_count:i daily_total_revenue:f",
        "SELECT * FROM gd_region_days",
    ),
    "promotions_active": (
        "promotion_id:t product_category:t promotion_type:t discount_percentage:f start_date:d end_date:d region:t"
        " duration_days:i start_month:i start_quarter:i start_year:i promotion_status:t total_sales:i"
        " total_gross_revenue:f avg_transaction_amount:f unique_customers_reached:i total_discount_cost:f"
        " total_net_revenue:f roi_percentage:f revenue_per_discount_euro:f market_share_pct:i"
        " market_share_pct_calculated:f total_market_sales:i",
        "SELECT * FROM gd_promotions",
    ),
    "customers_enriched": (
        "customer_id:i customer_name:t date_of_birth:d gender:t customer_region:t customer_country:t customer_city:t"
        " marital_status:t annual_income:i age:i age_group:t income_segment:t lifetime_value:f total_transactions:i"
        " avg_transaction_value:f first_purchase_date:d last_purchase_date:d days_since_last_purchase:i"
        " service_interaction_count:i avg_satisfaction_score:i complaint_count:i last_contact_date:d"
        " recency_segment:t monetary_segment:t frequency_segment:t customer_segment:t churn_risk_score:i"
        " loyalty_score:i",
        "SELECT * FROM gd_customers",
    ),
    "marketing_performance": (
        "campaign_id:t campaign_name:t campaign_type:t product_category:t target_audience:t start_date:d end_date:d"
        " region:t campaign_duration_days:i start_month:i start_quarter:i start_year:i campaign_budget:i"
        " estimated_reach:i target_conversion_rate:f actual_sales:i generated_revenue:f unique_customers_acquired:i"
        " avg_transaction_value:f roi_percentage:f revenue_per_euro_spent:f actual_conversion_rate:f"
        " cost_per_acquisition:f cost_per_unique_customer:f avg_customer_lifetime_value:f performance_rating:t"
        " conversion_performance:t",
        "SELECT * FROM gd_campaigns",
    ),
    "table_profile": (
        "table_name:t business_domain:t primary_key:t record_count:i min_date:d max_date:d distinct_keys:i"
        " data_quality:t",
        _profiles(),
    ),
    "missing_values": (
        "table_name:t total_records:i missing_amount:i missing_date:i missing_region:i pct_missing_amount:f",
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS total_records, COUNT(*) - COUNT({a}) AS missing_amount,"
            f" COUNT(*) - COUNT({b}) AS missing_date, COUNT(*) - COUNT({c}) AS missing_region,"
            f" {r(div(f'(COUNT(*) - COUNT({a})) * 100.0', 'COUNT(*)'))} AS pct_missing_amount FROM {table}"
            for name, table, a, b, c in (
                ("financial_transactions_clean", "sv_transactions", "amount", "transaction_date", "region"),
                ("customer_demographics_clean", "sv_customers", "annual_income", "date_of_birth", "region"),
                (
                    "customer_service_interactions_clean",
                    "sv_interactions",
                    "customer_satisfaction",
                    "interaction_date",
                    "duration_minutes",
                ),
            )
        ),
    ),
    "numeric_distribution": (
        "metric:t min_value:f max_value:f avg_value:f std_dev:f sample_size:i median_value:f variability_assessment:t",
        "SELECT *, CASE WHEN std_dev > avg_value THEN 'FORTE DISPERSION' WHEN std_dev > avg_value / 2 THEN"
        " 'DISPERSION MODÉRÉE' ELSE 'FAIBLE DISPERSION' END AS variability_assessment FROM ("
        + "\nUNION ALL ".join(
            _distribution(*row)
            for row in (
                ("Montant transaction", "sv_transactions", "amount"),
                ("Revenu annuel client", "sv_customers", "annual_income"),
                ("Salaire employé", "sv_employees", "salary"),
                ("Stock actuel", "sv_inventory", "current_stock"),
            )
        )
        + ") u",
    ),
    "monthly_sales": (
        "month:d transaction_count:i total_revenue:f avg_transaction_value:f unique_entities:i",
        f"SELECT DATE_TRUNC('month', transaction_date) AS month, COUNT(*) AS transaction_count, SUM(amount) AS"
        f" total_revenue, AVG(amount) AS avg_transaction_value, COUNT(DISTINCT entity) AS unique_entities"
        f" FROM ({_SOLD}) t GROUP BY 1",
    ),
    "quarterly_growth": (
        "quarter:d total_revenue:f transaction_count:i avg_ticket:f previous_quarter_revenue:f growth_rate_pct:f",
        f"""
WITH q AS (
  SELECT DATE_TRUNC('quarter', transaction_date) AS quarter, SUM(amount) AS total_revenue, COUNT(*) AS transaction_count
  FROM ({_SOLD}) t GROUP BY 1),
p AS (SELECT *, LAG(total_revenue) OVER (ORDER BY quarter) AS previous_quarter_revenue FROM q)
SELECT *, {div("total_revenue", "transaction_count")} AS avg_ticket,
  {r(div("(total_revenue - previous_quarter_revenue) * 100.0", "previous_quarter_revenue"))} AS growth_rate_pct FROM p""",
    ),
    "region_performance": (
        "region:t transaction_count:i total_revenue:f avg_transaction_value:f unique_entities:i revenue_share_pct:f",
        f"""
SELECT region, COUNT(*) AS transaction_count, SUM(amount) AS total_revenue, AVG(amount) AS avg_transaction_value,
  COUNT(DISTINCT entity) AS unique_entities,
  {r(div("SUM(amount) * 100.0", "(SELECT SUM(amount) FROM sv_transactions WHERE transaction_type = 'Sale')"))}
    AS revenue_share_pct
FROM ({_SOLD}) t GROUP BY region""",
    ),
    "top_entities": (
        "entity:t region:t transaction_count:i total_revenue:f avg_transaction_value:f max_transaction:i"
        " min_transaction:i",
        f"""
SELECT entity, region, COUNT(*) AS transaction_count, SUM(amount) AS total_revenue, AVG(amount) AS avg_transaction_value,
  MAX(amount) AS max_transaction, MIN(amount) AS min_transaction
FROM ({_SOLD}) t GROUP BY entity, region ORDER BY total_revenue DESC NULLS FIRST, entity, region LIMIT 10""",
    ),
    "customer_segments": (
        "age_group:t gender:t marital_status:t region:t customer_count:i avg_income:f min_income:i max_income:i",
        f"""
SELECT {band(bands.AGE_GROUP, "age")} AS age_group, gender, marital_status, region, COUNT(*) AS customer_count,
  AVG(annual_income) AS avg_income, MIN(annual_income) AS min_income, MAX(annual_income) AS max_income
FROM sv_customers GROUP BY 1, 2, 3, 4""",
    ),
    "basket_by_income": (
        "income_segment:t region:t unique_customers:i transaction_count:i total_revenue:f avg_transaction_value:f"
        " revenue_per_customer:f",
        f"""
SELECT {band(bands.INCOME_FR, "annual_income")} AS income_segment, u.region,
  COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS transaction_count, SUM(amount) AS total_revenue,
  AVG(amount) AS avg_transaction_value, {div("SUM(amount)", "COUNT(DISTINCT customer_id)")} AS revenue_per_customer
FROM sv_customers u JOIN ({_SOLD}) t ON TRY_CAST(t.entity AS BIGINT) = u.customer_id
WHERE annual_income IS NOT NULL AND amount IS NOT NULL GROUP BY 1, 2""",
    ),
    "promo_vs_no_promo": (
        "product_category:t promotion_status:t transaction_count:i total_revenue:f avg_transaction_value:f",
        f"""
WITH p AS (SELECT * FROM sv_promotions WHERE start_date <= {AS_OF} AND end_date >= {AS_OF}), t AS ({_SOLD})
SELECT product_category, 'Avec promotion' AS promotion_status, COUNT(*) AS transaction_count,
  SUM(amount) AS total_revenue, AVG(amount) AS avg_transaction_value
FROM t JOIN p ON transaction_date >= start_date AND transaction_date <= end_date GROUP BY 1
UNION ALL
SELECT 'Toutes catégories', 'Sans promotion', COUNT(*), SUM(amount), AVG(amount) FROM t
WHERE NOT EXISTS (SELECT 1 FROM p WHERE t.transaction_date >= p.start_date AND t.transaction_date <= p.end_date)""",
    ),
    "promo_sensitivity": (
        "product_category:t discount_percentage:f promotion_count:i sales_during_promotion:i"
        " revenue_during_promotion:f avg_sale_during_promotion:f total_sales:i avg_sale_baseline:f lift_percentage:f",
        f"""
WITH t AS ({_SOLD}),
i AS (
  SELECT product_category, discount_percentage, COUNT(DISTINCT promotion_id) AS promotion_count,
    COUNT(transaction_id) AS sales_during_promotion, SUM(amount) AS revenue_during_promotion,
    AVG(amount) AS avg_sale_during_promotion
  FROM sv_promotions LEFT JOIN t ON transaction_date >= start_date AND transaction_date <= end_date GROUP BY 1, 2),
b AS (SELECT {_WORD} AS word, COUNT(*) AS total_sales, AVG(amount) AS avg_sale_baseline FROM t GROUP BY 1)
SELECT i.*, total_sales, avg_sale_baseline,
  {r(div("(avg_sale_during_promotion - avg_sale_baseline) * 100", "avg_sale_baseline"))} AS lift_percentage
FROM i LEFT JOIN b ON word = product_category""",
    ),
    "campaign_sales_link": (
        "campaign_name:t campaign_type:t start_date:d end_date:d budget:i reach:i conversion_rate:f resulting_sales:i"
        " campaign_revenue:f roi_percentage:f revenue_per_budget_unit:f",
        f"""
SELECT campaign_name, campaign_type, start_date, end_date, budget, reach, conversion_rate,
  COUNT(transaction_id) AS resulting_sales, SUM(amount) AS campaign_revenue,
  {r(div("budget * 100.0", "SUM(amount)"))} AS roi_percentage,
  {r(div("SUM(amount)", "budget"))} AS revenue_per_budget_unit
FROM {_CAMPAIGN_MATCH.format(sold=_SOLD)} GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    ),
    "campaign_ranking": (
        "campaign_name:t campaign_type:t region:t budget:i conversion_rate:f sales_count:i generated_revenue:f"
        " revenue_per_euro:f efficiency_rating:t efficiency_rank:i",
        f"""
WITH m AS (
  SELECT campaign_id, campaign_name, campaign_type, k.region, budget, conversion_rate,
    COUNT(transaction_id) AS sales_count, SUM(amount) AS generated_revenue,
    {r(div("SUM(amount)", "budget"))} AS revenue_per_euro
  FROM {_CAMPAIGN_MATCH.format(sold=_SOLD)} GROUP BY 1, 2, 3, 4, 5, 6)
SELECT *, {band(bands.REVENUE_PER_EURO, "revenue_per_euro")} AS efficiency_rating,
  RANK() OVER (ORDER BY revenue_per_euro DESC NULLS FIRST) AS efficiency_rank FROM m WHERE budget > 0""",
    ),
    "review_impact": (
        "product_category:t sentiment:t avg_rating:f review_count:i sales_count:i sales_revenue:f avg_sale_value:f"
        " revenue_per_review:f",
        f"""
WITH v AS (
  SELECT product_category, sentiment, AVG(rating) AS avg_rating, COUNT(reviewer_id) AS review_count
  FROM sv_reviews GROUP BY 1, 2 HAVING COUNT(reviewer_id) > 10),
s AS (
  SELECT {_WORD} AS word, COUNT(*) AS sales_count, SUM(amount) AS sales_revenue, AVG(amount) AS avg_sale_value
  FROM ({_SOLD}) t GROUP BY 1)
SELECT v.*, sales_count, sales_revenue, avg_sale_value, {r(div("sales_revenue", "review_count"))} AS revenue_per_review
FROM v LEFT JOIN s ON word = product_category""",
    ),
    "service_influence": (
        "resolution_status:t satisfaction_category:t interaction_count:i avg_duration:f follow_up_count:i"
        " avg_customer_income:f unique_interactions:i",
        f"""
SELECT resolution_status, satisfaction_category, COUNT(*) AS interaction_count, AVG(duration_minutes) AS avg_duration,
  COUNT(*) FILTER (WHERE follow_up_required = 'Yes') AS follow_up_count,
  {r("AVG(annual_income)")} AS avg_customer_income, COUNT(DISTINCT interaction_id) AS unique_interactions
FROM sv_interactions x LEFT JOIN sv_customers u ON u.customer_id = x.customer_id GROUP BY 1, 2""",
    ),
    "stockouts": (
        "product_category:t region:t country:t warehouse:t product_count:i critical_stock_items:i"
        " out_of_stock_items:i avg_days_since_restock:f avg_lead_time:f",
        f"""
SELECT product_category, region, country, warehouse, COUNT(*) AS product_count,
  COUNT(*) FILTER (WHERE current_stock <= reorder_point) AS critical_stock_items,
  COUNT(*) FILTER (WHERE current_stock = 0) AS out_of_stock_items,
  {r("AVG(days_since_restock)", 1)} AS avg_days_since_restock, {r("AVG(lead_time)", 1)} AS avg_lead_time
FROM sv_inventory GROUP BY 1, 2, 3, 4 HAVING COUNT(*) FILTER (WHERE current_stock <= reorder_point) > 0""",
    ),
    "delivery_satisfaction": (
        "shipping_method:t carrier:t delivery_status:t avg_delivery_days:f avg_satisfaction_score:f shipment_count:i"
        " high_satisfaction_pct:f",
        """
SELECT shipping_method, carrier, delivery_status, AVG(estimated_delivery_days) AS avg_delivery_days,
  AVG(customer_satisfaction) AS avg_satisfaction_score, COUNT(*) AS shipment_count,
  AVG(CASE WHEN satisfaction_category = 'Très satisfait' THEN 100.0 ELSE 0.0 END) AS high_satisfaction_pct
FROM sv_shipments s JOIN sv_interactions x ON x.order_id = s.order_id
WHERE issue_category LIKE '%DELIVERY%' GROUP BY 1, 2, 3""",
    ),
    "stock_sales_satisfaction": (
        "product_category:t region:t stock_level:t product_count:i avg_stock_level:f total_sales:f sales_count:i"
        " avg_product_rating:f sales_per_product:f business_insight:t",
        f"""
WITH j AS (
  SELECT n.product_category, n.region, n.stock_level, COUNT(DISTINCT product_id) AS product_count,
    AVG(current_stock) AS avg_stock_level, SUM(amount) AS total_sales, COUNT(transaction_id) AS sales_count,
    AVG(rating) AS avg_product_rating
  FROM sv_inventory n
  LEFT JOIN (SELECT *, {_WORD} AS word FROM ({_SOLD}) s) t ON t.word = n.product_category AND t.region = n.region
  LEFT JOIN sv_reviews v ON v.product_category = n.product_category
  GROUP BY 1, 2, 3)
SELECT *, {r(div("total_sales", "product_count"))} AS sales_per_product,
  CASE WHEN stock_level = 'Critique' AND avg_product_rating > 4 THEN 'ALERTE: Bon produit mais stock critique'
    WHEN stock_level = 'Élevé' AND total_sales IS NULL THEN 'ALERTE: Surstock produit non vendu'
    WHEN (stock_level = 'Normal' OR stock_level = 'Bas') AND avg_product_rating > 4.5
      THEN 'OPPORTUNITÉ: Augmenter stock produit populaire'
    ELSE 'Situation normale' END AS business_insight FROM j""",
    ),
    "business_dashboard": (
        "metric:t value:f unit:t status:t",
        f"""
WITH t AS ({_SOLD}),
g AS (
  SELECT campaign_id, budget, SUM(amount) AS revenue
  FROM {_CAMPAIGN_MATCH.format(sold="SELECT * FROM sv_transactions")} GROUP BY 1, 2),
k AS (
  SELECT 'CA Total' AS metric, CAST(SUM(amount) AS DOUBLE) AS value FROM t
  UNION ALL SELECT 'Nombre transactions', COUNT(*) FROM t
  UNION ALL SELECT 'Panier moyen', AVG(amount) FROM t
  UNION ALL SELECT 'Clients uniques', COUNT(DISTINCT entity) FROM t
  UNION ALL SELECT 'Taux conversion moyen', 100 * AVG(conversion_rate) FROM sv_campaigns
  UNION ALL SELECT 'Satisfaction client', AVG(customer_satisfaction) FROM sv_interactions
  UNION ALL SELECT 'Produits stock critique', COUNT(*) FROM sv_inventory WHERE stock_level = 'Critique'
  UNION ALL SELECT 'Livraisons en retard', COUNT(*) FROM sv_shipments WHERE delivery_status = 'En retard'
  UNION ALL SELECT 'ROI marketing moyen', 100 * AVG(CAST(revenue AS DOUBLE) / budget) FROM g WHERE budget > 0)
SELECT metric, {r("value")} AS value,
  CASE WHEN metric LIKE '%moyen%' THEN '€'
    WHEN metric LIKE '%taux%' OR metric LIKE '%satisfaction%' OR metric LIKE '%ROI%' THEN '%' ELSE 'unité' END AS unit,
  CASE {_LIGHTS} ELSE '{bands.KPI_LIGHT_OTHERWISE}' END AS status FROM k""",
    ),
    "monthly_report": (
        "report_month:d region:t active_customers:i total_transactions:i monthly_revenue:f avg_ticket:f"
        " max_transaction:i refund_count:i total_refunds:f",
        """
SELECT DATE_TRUNC('month', transaction_date) AS report_month, region, COUNT(DISTINCT entity) AS active_customers,
  COUNT(*) AS total_transactions, SUM(amount) AS monthly_revenue, AVG(amount) AS avg_ticket,
  MAX(amount) AS max_transaction,
  COUNT(DISTINCT transaction_id) FILTER (WHERE transaction_type = 'REFUND') AS refund_count,
  SUM(CASE WHEN transaction_type = 'REFUND' THEN amount ELSE 0 END) AS total_refunds
FROM sv_transactions GROUP BY 1, 2""",
    ),
    "sales_analysis_export_profile": (
        "month:d region:t export_rows:f export_amount:f",
        f"""
WITH t AS ({_SOLD}),
v AS (SELECT product_category, sentiment, AVG(rating) AS avg_rating FROM sv_reviews GROUP BY 1, 2),
stock AS (
  SELECT n.region, COUNT(*) AS c FROM sv_inventory n LEFT JOIN v ON v.product_category = n.product_category GROUP BY 1),
half AS (
  SELECT t.transaction_date, t.region, t.amount
  FROM t
  LEFT JOIN sv_customers u ON TRY_CAST(t.entity AS BIGINT) = u.customer_id
  LEFT JOIN sv_campaigns k ON k.region = t.region AND t.transaction_date >= k.start_date AND t.transaction_date <= k.end_date
  LEFT JOIN sv_promotions o ON t.transaction_date >= o.start_date AND t.transaction_date <= o.end_date
  LEFT JOIN sv_shipments s ON s.order_id = TRY_CAST(t.entity AS BIGINT)
  LEFT JOIN sv_interactions x ON x.customer_id = TRY_CAST(t.entity AS BIGINT))
SELECT DATE_TRUNC('month', transaction_date) AS month, h.region, SUM(COALESCE(c, 1)) AS export_rows,
  SUM(amount * COALESCE(c, 1)) AS export_amount
FROM half h LEFT JOIN stock ON stock.region = h.region GROUP BY 1, 2""",
    ),
    "sales_analysis_export_factors": (
        "month:d region:t visits:i export_rows:f rows_per_visit:f",
        f"""
WITH t AS (SELECT TRY_CAST(entity AS BIGINT) AS id, region, transaction_date AS day FROM ({_SOLD})),
v AS (SELECT product_category, sentiment FROM sv_reviews GROUP BY 1, 2),
matched AS (
  SELECT t.region, t.day, t.id,
    (SELECT COUNT(*) FROM sv_customers u WHERE u.customer_id = t.id) AS u,
    (SELECT COUNT(*) FROM sv_shipments s WHERE s.order_id = t.id) AS s,
    (SELECT COUNT(*) FROM sv_interactions x WHERE x.customer_id = t.id) AS x,
    (SELECT COUNT(*) FROM sv_campaigns k WHERE k.region = t.region AND t.day BETWEEN k.start_date AND k.end_date) AS k,
    (SELECT COUNT(*) FROM sv_promotions o WHERE t.day BETWEEN o.start_date AND o.end_date) AS o,
    (SELECT COUNT(*) FROM sv_inventory n LEFT JOIN v ON v.product_category = n.product_category WHERE n.region = t.region) AS n
  FROM t),
m AS (
  SELECT DATE_TRUNC('month', day) AS month, region, COUNT(DISTINCT (id, day)) AS visits,
    SUM(GREATEST(u, 1) * GREATEST(s, 1) * GREATEST(x, 1) * GREATEST(k, 1) * GREATEST(o, 1) * GREATEST(n, 1)) AS export_rows
  FROM matched GROUP BY 1, 2)
SELECT *, {div('export_rows', 'visits')} AS rows_per_visit FROM m""",
    ),
    "layer_counts": ("layer:t table_name:t record_count:i", _layer_counts()),
    "quality_stats": (
        "table_name:t total_records:i records_with_null:i unique_records:i null_percentage:f",
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS total_records, COUNT(*) - COUNT({column}) AS"
            f" records_with_null, COUNT(DISTINCT {key}) AS unique_records,"
            f" {r(div(f'(COUNT(*) - COUNT({column})) * 100.0', 'COUNT(*)'))} AS null_percentage FROM {table}"
            for name, table, column, key in (
                ("financial_transactions_clean", "sv_transactions", "amount", "transaction_id"),
                ("customer_demographics_clean", "sv_customers", "customer_id", "customer_id"),
                ("employee_records_clean", "sv_employees", "employee_id", "employee_id"),
            )
        ),
    ),
    "range_checks": (
        "metric:t min_value:f max_value:f avg_value:f std_dev:f",
        "\nUNION ALL ".join(
            f"SELECT '{metric}' AS metric, MIN({column}) AS min_value, MAX({column}) AS max_value,"
            f" AVG(CAST({column} AS DOUBLE)) AS avg_value, STDDEV_SAMP(CAST({column} AS DOUBLE)) AS std_dev FROM {table}"
            for metric, table, column in (
                ("SALARY", "sv_employees", "salary"),
                ("ANNUAL_INCOME", "sv_customers", "annual_income"),
                ("TRANSACTION_AMOUNT", "sv_transactions", "amount"),
            )
        ),
    ),
    "temporal_checks": (
        "dataset:t total:i future_start:i expired:i",
        "\nUNION ALL ".join(
            f"SELECT '{dataset}' AS dataset, COUNT(*) AS total, COUNT(*) FILTER (WHERE start_date > {AS_OF}) AS"
            f" future_start, COUNT(*) FILTER (WHERE end_date < {AS_OF}) AS expired FROM {table}"
            for dataset, table in (("Promotions", "sv_promotions"), ("Campagnes marketing", "sv_campaigns"))
        ),
    ),
    "sales_tests": (
        _TEST_COLUMNS,
        _tests(
            "gd_sales",
            [
                ("Test 1: Montants négatifs", "sale_amount < 0", "montants négatifs détectés"),
                ("Test 2: Discount > 100%", "discount_rate > 100", "discounts > 100% détectés"),
                (
                    "Test 3: Net amount > Sale amount",
                    "net_amount > CAST(sale_amount AS DOUBLE)",
                    "incohérences de montants détectées",
                ),
                ("Test 4: Dates futures", f"sale_date > {AS_OF}", "dates futures détectées"),
            ],
        ),
    ),
    "sales_stats": (
        "table_name:t row_count:i unique_sales:i unique_regions:i earliest_date:d latest_date:d total_revenue:f"
        " avg_transaction:f promo_coverage_pct:f campaign_coverage_pct:f",
        f"""
SELECT 'SALES_ENRICHED' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT sale_id) AS unique_sales,
  COUNT(DISTINCT sale_region) AS unique_regions, MIN(sale_date) AS earliest_date, MAX(sale_date) AS latest_date,
  {r("SUM(sale_amount)")} AS total_revenue, {r("AVG(sale_amount)")} AS avg_transaction,
  {r(div("SUM(has_promotion) * 100.0", "COUNT(*)"))} AS promo_coverage_pct,
  {r(div("SUM(has_campaign) * 100.0", "COUNT(*)"))} AS campaign_coverage_pct
FROM gd_sales""",
    ),
    "current_promotions": (
        "promotion_id:t product_category:t promotion_type:t discount_percentage:f start_date:d end_date:d region:t"
        " duration_days:i total_sales:i total_gross_revenue:f total_discount_cost:f roi_percentage:f"
        " revenue_per_discount_euro:f market_share_pct:i days_remaining:i",
        f"SELECT *, end_date - {AS_OF} AS days_remaining FROM gd_promotions WHERE promotion_status = 'Active'",
    ),
    "promotion_tests": (
        _TEST_COLUMNS,
        _tests(
            "gd_promotions",
            [
                ("Test 1: Durations négatives", "duration_days < 0", "durées négatives détectées"),
                (
                    "Test 2: Discount hors limites",
                    "discount_percentage > 100 OR discount_percentage < 0",
                    "discounts hors limites détectés",
                ),
                ("Test 3: Dates incohérentes", "end_date < start_date", "dates incohérentes détectées"),
                ("Test 4: ROI extrêmes", "ABS(roi_percentage) > 10000", "ROI extrêmes détectés"),
            ],
        ),
    ),
    "promotion_stats": (
        "table_name:t total_promotions:i unique_categories:i unique_promotion_types:i unique_regions:i"
        " earliest_promotion:d latest_promotion:d avg_discount_rate:f avg_roi:f total_generated_revenue:f"
        " total_discount_costs:f avg_market_share:f avg_market_share_calculated:f",
        f"""
SELECT 'PROMOTIONS_ACTIVE' AS table_name, COUNT(*) AS total_promotions,
  COUNT(DISTINCT product_category) AS unique_categories, COUNT(DISTINCT promotion_type) AS unique_promotion_types,
  COUNT(DISTINCT region) AS unique_regions, MIN(start_date) AS earliest_promotion, MAX(end_date) AS latest_promotion,
  {r("AVG(discount_percentage)")} AS avg_discount_rate, {r("AVG(roi_percentage)")} AS avg_roi,
  SUM(total_gross_revenue) AS total_generated_revenue, SUM(total_discount_cost) AS total_discount_costs,
  {r("AVG(market_share_pct)")} AS avg_market_share,
  {r("AVG(market_share_pct_calculated)")} AS avg_market_share_calculated FROM gd_promotions""",
    ),
    "promotion_type_performance": (
        "promotion_type:t promotion_count:i avg_discount:f total_transactions:i total_revenue:f avg_roi:f"
        " avg_revenue_per_discount:f avg_market_share:f performance_category:t",
        f"""
SELECT promotion_type, COUNT(*) AS promotion_count, {r("AVG(discount_percentage)")} AS avg_discount,
  SUM(total_sales) AS total_transactions, SUM(total_gross_revenue) AS total_revenue,
  {r("AVG(roi_percentage)")} AS avg_roi, {r("AVG(revenue_per_discount_euro)")} AS avg_revenue_per_discount,
  {r("AVG(market_share_pct)")} AS avg_market_share,
  {band(bands.PROMOTION_ROI, "AVG(roi_percentage)")} AS performance_category
FROM gd_promotions GROUP BY promotion_type""",
    ),
    "promotion_status_summary": (
        "promotion_status:t promotion_count:i avg_discount_pct:f total_transactions:i total_revenue_generated:f"
        " avg_roi:f avg_market_share:f",
        f"""
SELECT promotion_status, COUNT(*) AS promotion_count, {r("AVG(discount_percentage)")} AS avg_discount_pct,
  SUM(total_sales) AS total_transactions, SUM(total_gross_revenue) AS total_revenue_generated,
  {r("AVG(roi_percentage)")} AS avg_roi, {r("AVG(market_share_pct)")} AS avg_market_share
FROM gd_promotions GROUP BY promotion_status""",
    ),
    "promotion_final_check": (
        "message:t total_promotions:i active_promotions:i scheduled_promotions:i completed_promotions:i average_roi:f"
        " total_revenue_generated:f",
        f"""
SELECT '✅ PROMOTIONS_ACTIVE créée avec succès' AS message, COUNT(*) AS total_promotions,
  COUNT(*) FILTER (WHERE promotion_status = 'Active') AS active_promotions,
  COUNT(*) FILTER (WHERE promotion_status = 'Scheduled') AS scheduled_promotions,
  COUNT(*) FILTER (WHERE promotion_status = 'Completed') AS completed_promotions,
  {r("AVG(roi_percentage)")} AS average_roi, {r("SUM(total_gross_revenue)")} AS total_revenue_generated
FROM gd_promotions""",
    ),
    "customer_stats": (
        "table_name:t total_customers:i unique_customers:i regions_covered:i avg_lifetime_value:f avg_age:f"
        " champion_count:i at_risk_vip_count:i churned_count:i",
        f"""
SELECT 'CUSTOMERS_ENRICHED' AS table_name, COUNT(*) AS total_customers, COUNT(DISTINCT customer_id) AS unique_customers,
  COUNT(DISTINCT customer_region) AS regions_covered, {r("AVG(lifetime_value)")} AS avg_lifetime_value,
  {r("AVG(age)", 1)} AS avg_age, COUNT(*) FILTER (WHERE customer_segment = 'Champions') AS champion_count,
  COUNT(*) FILTER (WHERE customer_segment = 'At Risk High Value') AS at_risk_vip_count,
  COUNT(*) FILTER (WHERE customer_segment = 'Churned') AS churned_count FROM gd_customers""",
    ),
    "marketing_stats": (
        "table_name:t total_campaigns:i campaign_types:i avg_roi:f total_generated_revenue:f total_budget_spent:f"
        " avg_conversion_rate:f excellent_campaigns:i negative_roi_campaigns:i",
        f"""
SELECT 'MARKETING_PERFORMANCE' AS table_name, COUNT(*) AS total_campaigns,
  COUNT(DISTINCT campaign_type) AS campaign_types, {r("AVG(roi_percentage)")} AS avg_roi,
  {r("SUM(generated_revenue)")} AS total_generated_revenue, {r("SUM(campaign_budget)")} AS total_budget_spent,
  {r("AVG(actual_conversion_rate)", 4)} AS avg_conversion_rate,
  COUNT(*) FILTER (WHERE performance_rating = 'Excellent') AS excellent_campaigns,
  COUNT(*) FILTER (WHERE performance_rating = 'Negative') AS negative_roi_campaigns FROM gd_campaigns""",
    ),
    "top_performing_campaigns": (
        "campaign_name:t campaign_type:t region:t start_date:d end_date:d campaign_budget:i generated_revenue:f"
        " roi_percentage:f cost_per_acquisition:f actual_conversion_rate:f performance_rating:t"
        " conversion_performance:t",
        "SELECT * FROM gd_campaigns WHERE roi_percentage > 0 ORDER BY roi_percentage DESC, generated_revenue DESC,"
        " campaign_name LIMIT 20",
    ),
    "marketing_tests": (
        _TEST_COLUMNS,
        _tests(
            "gd_campaigns",
            [
                ("Test 1: ROI anormal (> 1000%)", "roi_percentage > 1000", "ROI anormaux détectés"),
                ("Test 2: Budgets négatifs", "campaign_budget < 0", "budgets négatifs détectés"),
                (
                    "Test 3: Conversion rate > 100%",
                    "target_conversion_rate > 100 OR actual_conversion_rate > 100",
                    "taux de conversion > 100% détectés",
                ),
            ],
        ),
    ),
    "gold_summary": (
        "dataset:t total_records:i unique_customers:i avg_lifetime_value:f",
        f"""
SELECT 'CUSTOMERS_ENRICHED' AS dataset, COUNT(*) AS total_records, COUNT(DISTINCT customer_id) AS unique_customers,
  {r("AVG(lifetime_value)")} AS avg_lifetime_value FROM gd_customers
UNION ALL
SELECT 'MARKETING_PERFORMANCE', COUNT(*), COUNT(DISTINCT campaign_id), {r("AVG(roi_percentage)")} FROM gd_campaigns""",
    ),
    "top_customers": (
        "customer_name:t customer_segment:t lifetime_value:f total_transactions:i days_since_last_purchase:i"
        " churn_risk_score:i",
        "SELECT * FROM gd_customers ORDER BY lifetime_value DESC, customer_name, customer_id LIMIT 10",
    ),
    "campaign_type_analysis": (
        "campaign_type:t campaign_count:i avg_roi:f total_revenue:f avg_cpa:f",
        f"""
SELECT campaign_type, COUNT(*) AS campaign_count, {r("AVG(roi_percentage)")} AS avg_roi,
  {r("SUM(generated_revenue)")} AS total_revenue, {r("AVG(cost_per_acquisition)")} AS avg_cpa
FROM gd_campaigns GROUP BY campaign_type""",
    ),
    "segment_distribution": (
        "customer_segment:t customer_count:i avg_lifetime_value:f avg_age:f avg_income:f at_risk_count:i",
        f"""
SELECT customer_segment, COUNT(*) AS customer_count, {r("AVG(lifetime_value)")} AS avg_lifetime_value,
  {r("AVG(age)", 1)} AS avg_age, {r("AVG(annual_income)")} AS avg_income,
  COUNT(*) FILTER (WHERE churn_risk_score > 2) AS at_risk_count FROM gd_customers GROUP BY customer_segment""",
    ),
    "sales_kpis": (
        "transactions:i revenue:f avg_ticket:f first_date:d last_date:d",
        "SELECT COUNT(*) AS transactions, SUM(sale_amount) AS revenue, AVG(sale_amount) AS avg_ticket, MIN(sale_date)"
        " AS first_date, MAX(sale_date) AS last_date FROM gd_sales WHERE sale_amount > 0",
    ),
    "daily_trend": (
        "sale_date:d daily_revenue:f daily_transactions:i",
        "SELECT sale_date, SUM(sale_amount) AS daily_revenue, COUNT(*) AS daily_transactions FROM gd_sales"
        " WHERE sale_amount > 0 GROUP BY 1 ORDER BY 1 DESC LIMIT 30",
    ),
    "top_regions": (
        "sale_region:t transactions:i revenue:f",
        "SELECT sale_region, COUNT(*) AS transactions, SUM(sale_amount) AS revenue FROM gd_sales WHERE sale_amount > 0"
        " AND sale_region IS NOT NULL GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 10",
    ),
    "recent_sales": (
        "sale_date:d sale_id:t sale_region:t sale_amount:i payment_method:t promotion:t",
        "SELECT *, CASE has_promotion WHEN 1 THEN 'Oui' ELSE 'Non' END AS promotion FROM gd_sales"
        " WHERE sale_amount > 0 ORDER BY sale_date DESC, sale_id, promotion DESC LIMIT 20",
    ),
    "promotion_types": (
        "promotion_type:t",
        "SELECT promotion_type FROM gd_promotions WHERE promotion_type IS NOT NULL GROUP BY 1",
    ),
    "promotion_kpis": (
        "total_promotions:i active_promotions:i upcoming_promotions:i total_gross_revenue:f total_discount_cost:f"
        " avg_roi:f avg_revenue_per_discount:f total_transactions:i total_customers_reached:i",
        """
SELECT COUNT(*) AS total_promotions, COUNT(*) FILTER (WHERE promotion_status = 'Active') AS active_promotions,
  COUNT(*) FILTER (WHERE promotion_status = 'Scheduled') AS upcoming_promotions,
  SUM(total_gross_revenue) AS total_gross_revenue, SUM(total_discount_cost) AS total_discount_cost,
  AVG(roi_percentage) AS avg_roi, AVG(revenue_per_discount_euro) AS avg_revenue_per_discount,
  SUM(total_sales) AS total_transactions, SUM(unique_customers_reached) AS total_customers_reached
FROM gd_promotions WHERE promotion_status IS NULL OR promotion_status <> 'EXPIRED'""",
    ),
    "promotion_details": (_PROMO_DETAILS, "SELECT * FROM gd_promotions"),
    "promo_by_type": (
        f"promotion_type:t {_PROMO_COMMON} avg_discount_pct:f avg_revenue_per_euro:f total_customers:i",
        _PROMO_TYPE,
    ),
    "promo_by_region": (
        f"region:t {_PROMO_COMMON} total_customers:i avg_market_share:f avg_market_share_calculated:f",
        _PROMO_REGION,
    ),
    "promo_by_category": (f"product_category:t {_PROMO_COMMON} avg_discount_pct:f avg_ticket:f", _PROMO_CATEGORY),
    "promo_roi_vs_discount": ("product_category:t avg_discount_pct:f avg_roi:f total_revenue:f", _PROMO_CATEGORY),
    "promo_by_period": (
        "start_year:i start_quarter:i start_month:i promotion_status:t promotion_count:i total_revenue:f"
        " total_discount:f avg_roi:f",
        """
SELECT start_year, start_quarter, start_month, promotion_status, COUNT(*) AS promotion_count,
  SUM(total_gross_revenue) AS total_revenue, SUM(total_discount_cost) AS total_discount, AVG(roi_percentage) AS avg_roi
FROM gd_promotions WHERE start_year IS NOT NULL GROUP BY 1, 2, 3, 4""",
    ),
    "promo_best": (
        "aspect:t position:i name:t avg_roi:f promotion_count:i avg_revenue_per_euro:f avg_market_share:f"
        " avg_discount_pct:f",
        "\nUNION ALL ".join(
            f"SELECT * FROM ({_best(aspect, key, source, 'avg_roi DESC, total_revenue DESC NULLS FIRST', count, shown)}) z"
            for aspect, key, source, count, shown in (
                (
                    "best_type", "promotion_type", _PROMO_TYPE, 1,
                    "promotion_count, avg_revenue_per_euro, NULL AS avg_market_share, NULL AS avg_discount_pct",
                ),
                (
                    "best_region", "region", _PROMO_REGION, 1,
                    "promotion_count, NULL AS avg_revenue_per_euro, avg_market_share, NULL AS avg_discount_pct",
                ),
                (
                    "best_category", "product_category", _PROMO_CATEGORY, 1,
                    "promotion_count, NULL AS avg_revenue_per_euro, NULL AS avg_market_share, avg_discount_pct",
                ),
                (
                    "top_region", "region", _PROMO_REGION, 5,
                    "promotion_count, NULL AS avg_revenue_per_euro, avg_market_share, NULL AS avg_discount_pct",
                ),
            )
        ),
    ),
    "promo_status_counts": (
        "active_count:i upcoming_count:i expired_count:i period_start:d period_end:d",
        """
SELECT COUNT(*) FILTER (WHERE promotion_status = 'Active') AS active_count,
  COUNT(*) FILTER (WHERE promotion_status = 'Scheduled') AS upcoming_count,
  COUNT(*) FILTER (WHERE promotion_status = 'Completed') AS expired_count, MIN(start_date) AS period_start,
  MAX(end_date) AS period_end FROM gd_promotions""",
    ),
    "campaign_types": (
        "campaign_type:t",
        "SELECT campaign_type FROM gd_campaigns WHERE campaign_type IS NOT NULL GROUP BY 1",
    ),
    "marketing_kpis": (
        "total_campaigns:i total_budget:i total_revenue:f avg_roi:f avg_conversion_rate:f total_customers_acquired:i"
        " avg_cpa:f avg_revenue_per_euro:f",
        """
SELECT COUNT(*) AS total_campaigns, SUM(campaign_budget) AS total_budget, SUM(generated_revenue) AS total_revenue,
  AVG(roi_percentage) AS avg_roi, 100 * AVG(actual_conversion_rate) AS avg_conversion_rate,
  SUM(unique_customers_acquired) AS total_customers_acquired, AVG(cost_per_acquisition) AS avg_cpa,
  AVG(revenue_per_euro_spent) AS avg_revenue_per_euro FROM gd_campaigns WHERE campaign_budget > 0""",
    ),
    "campaign_details": (_CAMPAIGN_DETAILS, _PORTFOLIO),
    "campaign_by_type": (
        f"campaign_type:t {_CAMPAIGN_COMMON} avg_revenue_per_euro:f total_customers:i avg_cpa:f",
        _CAMPAIGN_TYPE,
    ),
    "campaign_budget_vs_revenue": ("campaign_type:t total_budget:i total_revenue:f", _CAMPAIGN_TYPE),
    "campaign_by_region": (f"region:t {_CAMPAIGN_COMMON} total_customers:i avg_customer_cost:f", _CAMPAIGN_REGION),
    "campaign_by_category": (f"product_category:t {_CAMPAIGN_COMMON} total_sales:i avg_ticket:f", _CAMPAIGN_CATEGORY),
    "campaign_category_chart": (
        "product_category:t avg_roi:f",
        f"SELECT * FROM ({_CAMPAIGN_CATEGORY}) u ORDER BY avg_roi DESC NULLS FIRST, product_category LIMIT 8",
    ),
    "campaign_by_period": (
        "start_year:i start_quarter:i start_month:i campaign_count:i total_budget:i total_revenue:f avg_roi:f"
        " total_customers:i",
        """
SELECT start_year, start_quarter, start_month, COUNT(*) AS campaign_count, SUM(campaign_budget) AS total_budget,
  SUM(generated_revenue) AS total_revenue, AVG(roi_percentage) AS avg_roi,
  SUM(unique_customers_acquired) AS total_customers
FROM gd_campaigns WHERE start_year IS NOT NULL GROUP BY 1, 2, 3 ORDER BY 1 DESC, 2 DESC, 3 DESC LIMIT 12""",
    ),
    "campaign_efficiency_counts": (
        "excellent_campaigns:i efficient_campaigns:i profitable_acquisitions:i",
        f"""
SELECT COUNT(*) FILTER (WHERE roi_percentage > 100 AND actual_conversion_pct > 5) AS excellent_campaigns,
  COUNT(*) FILTER (WHERE revenue_per_euro_spent > 3) AS efficient_campaigns,
  COUNT(*) FILTER (WHERE cost_per_acquisition < 50) AS profitable_acquisitions FROM ({_PORTFOLIO}) u""",
    ),
    "campaign_best_worst": (
        "aspect:t position:i name:t avg_roi:f avg_conversion_rate:f campaign_count:i advice:t",
        "SELECT *, CASE WHEN aspect LIKE 'best%' AND avg_roi > 150 THEN 'invest' WHEN aspect LIKE 'worst%' AND"
        " avg_roi < 50 THEN 'review' END AS advice FROM ("
        + "\nUNION ALL ".join(
            f"SELECT * FROM ({_best(aspect, key, source, order, count, 'avg_conversion_rate, campaign_count')}) z"
            for aspect, key, source, order, count in (
                ("best_type", "campaign_type", _CAMPAIGN_TYPE, "avg_roi DESC", 1),
                ("best_region", "region", _CAMPAIGN_REGION, "avg_roi DESC", 1),
                ("best_category", "product_category", _CAMPAIGN_CATEGORY, "avg_roi DESC", 1),
                (
                    "worst_type", "campaign_type",
                    f"SELECT * FROM ({_CAMPAIGN_TYPE}) e WHERE (SELECT COUNT(*) FROM ({_CAMPAIGN_TYPE}) f) > 3",
                    "avg_roi", 1,
                ),
                (
                    "worst_region", "region",
                    f"SELECT * FROM ({_CAMPAIGN_REGION}) e WHERE (SELECT COUNT(*) FROM ({_CAMPAIGN_REGION}) f) > 3",
                    "avg_roi", 1,
                ),
                ("top_region", "region", _CAMPAIGN_REGION, "avg_roi DESC", 5),
            )
        )
        + ") u",
    ),
    "campaign_rating_counts": (
        "excellent_count:i good_count:i average_count:i poor_count:i period_start:d period_end:d total_budget:i",
        f"""
SELECT COUNT(*) FILTER (WHERE performance_rating = 'Excellent') AS excellent_count,
  COUNT(*) FILTER (WHERE performance_rating = 'Good') AS good_count,
  COUNT(*) FILTER (WHERE performance_rating = 'Acceptable') AS average_count,
  COUNT(*) FILTER (WHERE performance_rating = 'Poor') AS poor_count, MIN(start_date) AS period_start,
  MAX(end_date) AS period_end, SUM(campaign_budget) AS total_budget FROM ({_PORTFOLIO}) u""",
    ),
    "filter_promotions": (_PROMO_DETAILS, _FILTERED_PROMOS),
    "promo_filtered_stats": (
        "avg_roi:f total_revenue:f avg_discount:f",
        f"SELECT AVG(roi_percentage) AS avg_roi, COALESCE(SUM(total_gross_revenue), 0) AS total_revenue,"
        f" AVG(discount_percentage) AS avg_discount FROM ({_FILTERED_PROMOS}) u",
    ),
    "filter_campaigns": (_CAMPAIGN_DETAILS, _FILTERED_CAMPAIGNS),
    "campaign_filtered_stats": (
        "avg_roi:f total_budget:i avg_conversion:f",
        f"SELECT AVG(roi_percentage) AS avg_roi, COALESCE(SUM(campaign_budget), 0) AS total_budget,"
        f" AVG(actual_conversion_pct) AS avg_conversion FROM ({_FILTERED_CAMPAIGNS}) u",
    ),
}

_PROMO_REPORT = (
    f"{_PROMO_DETAILS} {_PROMO_COMMON} avg_discount_pct:f avg_revenue_per_euro:f total_customers:i avg_market_share:f"
    " avg_market_share_calculated:f avg_ticket:f"
)
_ENTRIES["promotion_report"] = (
    _PROMO_REPORT,
    _ragged(
        [
            (" ".join(_names(_PROMO_DETAILS)), "SELECT * FROM gd_promotions"),
            *[(" ".join(_names(_ENTRIES[key][0])), _ENTRIES[key][1])
              for key in ("promo_by_type", "promo_by_region", "promo_by_category")],
        ],
        _PROMO_REPORT,
    ),
)
_CAMPAIGN_REPORT = (
    f"{_CAMPAIGN_DETAILS} {_CAMPAIGN_COMMON} avg_revenue_per_euro:f total_customers:i avg_cpa:f avg_customer_cost:f"
    " total_sales:i avg_ticket:f"
)
_ENTRIES["marketing_report"] = (
    _CAMPAIGN_REPORT,
    _ragged(
        [
            (" ".join(_names(_CAMPAIGN_DETAILS)), _PORTFOLIO),
            *[(" ".join(_names(_ENTRIES[key][0])), _ENTRIES[key][1])
              for key in ("campaign_by_type", "campaign_by_region", "campaign_by_category")],
        ],
        _CAMPAIGN_REPORT,
    ),
)


def oracle_sql() -> dict[str, str]:
    return {key: statement(columns, select) for key, (columns, select) in _ENTRIES.items()}
