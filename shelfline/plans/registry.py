"""Named queries: every Silver, Gold, exploration, quality and dashboard result by key."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dialect import half_up, half_up_double
from shelfline.lakehouse import Lakehouse
from shelfline.plans import boards, explore, gold, quality

Plan = Callable[[Lakehouse], DataFrame]

# Queries with the analyst's choices fixed, so that they can be compared.
SHOWN_PROMOTIONS = {"status": "EXPIRED", "types": ("Bundle", "Coupon"), "discount_from": 10, "discount_to": 50}
SHOWN_CAMPAIGNS = {"rating": "ALL", "types": ("Email", "Social", "Print"), "year": None, "min_roi": 0}


def _filtered_promotions(lake: Lakehouse) -> DataFrame:
    return boards.filter_promotions(boards.promotion_details(lake), **SHOWN_PROMOTIONS)


def _filtered_campaigns(lake: Lakehouse) -> DataFrame:
    return boards.filter_campaigns(boards.campaign_details(lake), **SHOWN_CAMPAIGNS)


def _silver(name: str) -> Plan:
    return lambda lake: lake.silver(name)


SILVER_KEYS = {
    "clean_financial_transactions": "financial_transactions_clean",
    "clean_promotions": "promotions_clean",
    "clean_customer_demographics": "customer_demographics_clean",
    "clean_employee_records": "employee_records_clean",
    "clean_supplier_information": "supplier_information_clean",
    "clean_logistics": "logistics_and_shipping_clean",
    "clean_service_interactions": "customer_service_interactions_clean",
    "clean_marketing_campaigns": "marketing_campaigns_clean",
    "clean_product_reviews": "product_reviews_clean",
    "flatten_inventory": "inventory_clean",
    "flatten_store_locations": "store_locations_clean",
}

_EXPLORE = (
    "table_profile missing_values numeric_distribution monthly_sales quarterly_growth region_performance top_entities"
    " customer_segments basket_by_income promo_vs_no_promo promo_sensitivity campaign_sales_link campaign_ranking"
    " review_impact service_influence stockouts delivery_satisfaction stock_sales_satisfaction business_dashboard"
    " monthly_report sales_analysis_export_profile sales_analysis_export_factors"
).split()
_QUALITY = (
    "layer_counts quality_stats range_checks temporal_checks sales_tests sales_stats current_promotions promotion_tests"
    " promotion_stats promotion_type_performance promotion_status_summary promotion_final_check customer_stats"
    " marketing_stats top_performing_campaigns marketing_tests gold_summary top_customers campaign_type_analysis"
    " segment_distribution"
).split()
_BOARDS = (
    "sales_kpis daily_trend top_regions recent_sales promotion_types promotion_kpis promotion_details promo_by_type"
    " promo_by_region promo_by_category promo_roi_vs_discount promo_by_period promo_best promo_status_counts"
    " promotion_report campaign_types marketing_kpis campaign_details campaign_by_type campaign_budget_vs_revenue"
    " campaign_by_region campaign_by_category campaign_category_chart campaign_by_period campaign_efficiency_counts"
    " campaign_best_worst campaign_rating_counts marketing_report"
).split()

PLANS: dict[str, Plan] = {
    **{key: _silver(table) for key, table in SILVER_KEYS.items()},
    **{name: (lambda lake, name=name: lake.gold(name)) for name in gold.TABLES},
    **{name: getattr(explore, name) for name in _EXPLORE},
    **{name: getattr(quality, name) for name in _QUALITY},
    **{name: getattr(boards, name) for name in _BOARDS},
    "filter_promotions": _filtered_promotions,
    "promo_filtered_stats": lambda lake: boards.promo_filtered_stats(_filtered_promotions(lake)),
    "filter_campaigns": _filtered_campaigns,
    "campaign_filtered_stats": lambda lake: boards.campaign_filtered_stats(_filtered_campaigns(lake)),
}


def present(df: DataFrame) -> DataFrame:
    """Make a result comparable: no audit columns, whole numbers as bigint, the rest as double to four digits."""
    columns = []
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(field.name)
        if field.name in gold.AUDIT:
            continue
        if isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18:
            column = column.cast("bigint")
        elif isinstance(kind, T.DoubleType):
            column = half_up_double(column, 4)
        elif isinstance(kind, T.DecimalType | T.FloatType):
            column = half_up(column, 4)
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


_lakes: dict[tuple[str, str], Lakehouse] = {}


def lake_of(spark: SparkSession, folder: str) -> Lakehouse:
    """The Lakehouse over a folder; queries share its table definitions (plans, not data)."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _lakes:
        _lakes[key] = Lakehouse.from_star_schema(spark, folder)
    return _lakes[key]


def forget() -> None:
    """Drop the shared definitions, so that the next query plans anew (files may have grown meanwhile)."""
    _lakes.clear()


def _run(plan: Plan, spark: SparkSession, folder: str) -> DataFrame:
    return present(plan(lake_of(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: partial(_run, plan) for key, plan in PLANS.items()}
