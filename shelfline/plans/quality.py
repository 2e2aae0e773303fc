"""Data quality: layer counts, range and date checks, Gold data tests and summaries."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import bands
from shelfline.functions.dialect import half_up, mean, percent, ratio
from shelfline.operators.checks import verdicts
from shelfline.operators.ordered import top_rows
from shelfline.operators.stacking import stack, summarise
from shelfline.plans import silver as silver_plans
from shelfline.plans.gold import WIDE, sales_cells
from shelfline.sources.schemas import BRONZE_TABLES

if TYPE_CHECKING:
    from shelfline.lakehouse import Lakehouse

c = F.col


def layer_counts(lake: Lakehouse) -> DataFrame:
    tables = [("BRONZE Layer", name, lake.bronze(name)) for name in BRONZE_TABLES]
    tables += [("SILVER Layer", name, lake.silver(name)) for name in silver_plans.TABLES]
    parts = [
        summarise(df, {"layer": layer, "table_name": name}, record_count=F.count("*")) for layer, name, df in tables
    ]
    return stack(parts).orderBy("layer", "table_name")


def quality_stats(lake: Lakehouse) -> DataFrame:
    checked = (
        ("financial_transactions_clean", "amount", "transaction_id"),
        ("customer_demographics_clean", "customer_id", "customer_id"),
        ("employee_records_clean", "employee_id", "employee_id"),
    )
    parts = [
        summarise(
            lake.silver(table),
            {"table_name": table},
            total_records=F.count("*"),
            records_with_null=F.count_if(c(column).isNull()),
            unique_records=F.count_distinct(key),
        )
        for table, column, key in checked
    ]
    share = percent(c("records_with_null"), c("total_records"))
    return stack(parts).withColumn("null_percentage", share).orderBy(c("null_percentage").desc_nulls_first(), "table_name")


def range_checks(lake: Lakehouse) -> DataFrame:
    checked = (
        ("SALARY", "employee_records_clean", "salary"),
        ("ANNUAL_INCOME", "customer_demographics_clean", "annual_income"),
        ("TRANSACTION_AMOUNT", "financial_transactions_clean", "amount"),
    )
    parts = []
    for metric, table, column in checked:
        value = c(column).cast("double")
        parts.append(
            summarise(
                lake.silver(table),
                {"metric": metric},
                min_value=F.min(value),
                max_value=F.max(value),
                avg_value=F.avg(value),
                std_dev=F.stddev_samp(value),
            )
        )
    return stack(parts)


def temporal_checks(lake: Lakehouse) -> DataFrame:
    checked = (("Promotions", "promotions_clean"), ("Campagnes marketing", "marketing_campaigns_clean"))
    parts = [
        summarise(
            lake.silver(table),
            {"dataset": dataset},
            total=F.count("*"),
            future_start=F.count_if(c("start_date") > lake.today),
            expired=F.count_if(c("end_date") < lake.today),
        )
        for dataset, table in checked
    ]
    return stack(parts)


def sales_tests(lake: Lakehouse) -> DataFrame:
    """Tests over the fact, counted from cells: a cell's failing sales times their repetitions."""
    sales_count, campaigns = c("sales"), c("campaign_rows")
    raised = c("positive_sales") * c("price_rises") + c("negative_sales") * c("price_cuts")
    counts = sales_cells(lake).agg(
        F.sum(c("negative_sales") * c("repeats")).alias("negative"),
        F.sum(sales_count * c("over_discounts") * campaigns).alias("discount"),
        F.sum(raised * campaigns).alias("net"),
        F.sum(F.when(c("sale_date") > lake.today, sales_count * c("repeats")).otherwise(0)).alias("future"),
    )
    # Names of the tests and what they report.
    return verdicts(
        counts,
        {
            "negative": ("Test 1: Montants négatifs", "montants négatifs détectés"),
            "discount": ("Test 2: Discount > 100%", "discounts > 100% détectés"),
            "net": ("Test 3: Net amount > Sale amount", "incohérences de montants détectées"),
            "future": ("Test 4: Dates futures", "dates futures détectées"),
        },
    )


def sales_stats(lake: Lakehouse) -> DataFrame:
    """Summary of the fact. A sale id occurs once in Silver, so counting ids counts distinct ids."""
    revenue = F.sum(c("amount").cast(WIDE) * c("repeats"))
    rows = F.sum(c("sales") * c("repeats"))
    return sales_cells(lake).agg(
        F.lit("SALES_ENRICHED").alias("table_name"),
        F.coalesce(rows, F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("named_sales"), F.lit(0)).alias("unique_sales"),
        F.count_distinct("sale_region").alias("unique_regions"),
        F.min("sale_date").alias("earliest_date"),
        F.max("sale_date").alias("latest_date"),
        half_up(revenue, 2).alias("total_revenue"),
        half_up(ratio(revenue, rows), 2).alias("avg_transaction"),
        percent(F.sum(c("sales") * c("named_promotions") * c("campaign_rows")), rows).alias("promo_coverage_pct"),
        percent(F.sum(c("sales") * c("promo_rows") * c("named_campaigns")), rows).alias("campaign_coverage_pct"),
    )


def promotion_tests(lake: Lakehouse) -> DataFrame:
    discount, roi = c("discount_percentage"), c("roi_percentage")
    counts = lake.gold("promotions_active").agg(
        F.count_if(c("duration_days") < 0).alias("duration"),
        F.count_if((discount < 0) | (discount > 100)).alias("discount"),
        F.count_if(c("start_date") > c("end_date")).alias("dates"),
        F.count_if((roi > 10000) | (roi < -10000)).alias("roi"),
    )
    # Names of the tests and what they report.
    return verdicts(
        counts,
        {
            "duration": ("Test 1: Durations négatives", "durées négatives détectées"),
            "discount": ("Test 2: Discount hors limites", "discounts hors limites détectés"),
            "dates": ("Test 3: Dates incohérentes", "dates incohérentes détectées"),
            "roi": ("Test 4: ROI extrêmes", "ROI extrêmes détectés"),
        },
    )


def promotion_stats(lake: Lakehouse) -> DataFrame:
    return lake.gold("promotions_active").agg(
        F.lit("PROMOTIONS_ACTIVE").alias("table_name"),
        F.count("*").alias("total_promotions"),
        F.count_distinct("product_category").alias("unique_categories"),
        F.count_distinct("promotion_type").alias("unique_promotion_types"),
        F.count_distinct("region").alias("unique_regions"),
        F.min("start_date").alias("earliest_promotion"),
        F.max("end_date").alias("latest_promotion"),
        half_up(F.avg("discount_percentage"), 2).alias("avg_discount_rate"),
        half_up(F.avg("roi_percentage"), 2).alias("avg_roi"),
        F.sum("total_gross_revenue").alias("total_generated_revenue"),
        F.sum("total_discount_cost").alias("total_discount_costs"),
        half_up(F.avg("market_share_pct"), 2).alias("avg_market_share"),
        half_up(F.avg("market_share_pct_calculated"), 2).alias("avg_market_share_calculated"),
    )


def current_promotions(lake: Lakehouse) -> DataFrame:
    """Active promotions with the days they have left."""
    return (
        lake.gold("promotions_active")
        .where(c("promotion_status") == "Active")
        .select(
            "promotion_id",
            "product_category",
            "promotion_type",
            "discount_percentage",
            "start_date",
            "end_date",
            "region",
            "duration_days",
            "total_sales",
            "total_gross_revenue",
            "total_discount_cost",
            "roi_percentage",
            "revenue_per_discount_euro",
            "market_share_pct",
            F.datediff("end_date", lake.today).alias("days_remaining"),
        )
        .orderBy("end_date", c("roi_percentage").desc_nulls_first(), "promotion_id")
    )


def promotion_type_performance(lake: Lakehouse) -> DataFrame:
    roi = F.avg("roi_percentage")
    return (
        lake.gold("promotions_active")
        .groupBy("promotion_type")
        .agg(
            F.count("*").alias("promotion_count"),
            half_up(F.avg("discount_percentage"), 2).alias("avg_discount"),
            F.sum("total_sales").alias("total_transactions"),
            F.sum("total_gross_revenue").alias("total_revenue"),
            half_up(roi, 2).alias("avg_roi"),
            half_up(F.avg("revenue_per_discount_euro"), 2).alias("avg_revenue_per_discount"),
            half_up(F.avg("market_share_pct"), 2).alias("avg_market_share"),
            bands.PROMOTION_ROI.name(roi).alias("performance_category"),
        )
        .orderBy(c("avg_roi").desc_nulls_first(), "promotion_type")
    )


def promotion_status_summary(lake: Lakehouse) -> DataFrame:
    status = c("promotion_status")
    place = F.when(status == "Active", 1).when(status == "Scheduled", 2).when(status == "Completed", 3).otherwise(4)
    return (
        lake.gold("promotions_active")
        .groupBy("promotion_status")
        .agg(
            F.count("*").alias("promotion_count"),
            half_up(F.avg("discount_percentage"), 2).alias("avg_discount_pct"),
            F.sum("total_sales").alias("total_transactions"),
            F.sum("total_gross_revenue").alias("total_revenue_generated"),
            half_up(F.avg("roi_percentage"), 2).alias("avg_roi"),
            half_up(F.avg("market_share_pct"), 2).alias("avg_market_share"),
        )
        .orderBy(place)
    )


def promotion_final_check(lake: Lakehouse) -> DataFrame:
    status = c("promotion_status")
    return lake.gold("promotions_active").agg(
        F.lit("✅ PROMOTIONS_ACTIVE créée avec succès").alias("message"),
        F.count("*").alias("total_promotions"),
        F.count_if(status == "Active").alias("active_promotions"),
        F.count_if(status == "Scheduled").alias("scheduled_promotions"),
        F.count_if(status == "Completed").alias("completed_promotions"),
        half_up(F.avg("roi_percentage"), 2).alias("average_roi"),
        half_up(F.sum("total_gross_revenue"), 2).alias("total_revenue_generated"),
    )


def customer_stats(lake: Lakehouse) -> DataFrame:
    segment = c("customer_segment")
    return lake.gold("customers_enriched").agg(
        F.lit("CUSTOMERS_ENRICHED").alias("table_name"),
        F.count("*").alias("total_customers"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("customer_region").alias("regions_covered"),
        half_up(mean(c("lifetime_value")), 2).alias("avg_lifetime_value"),
        half_up(F.avg("age"), 1).alias("avg_age"),
        F.count_if(segment == "Champions").alias("champion_count"),
        F.count_if(segment == "At Risk High Value").alias("at_risk_vip_count"),
        F.count_if(segment == "Churned").alias("churned_count"),
    )


def marketing_stats(lake: Lakehouse) -> DataFrame:
    rating = c("performance_rating")
    return lake.gold("marketing_performance").agg(
        F.lit("MARKETING_PERFORMANCE").alias("table_name"),
        F.count("*").alias("total_campaigns"),
        F.count_distinct("campaign_type").alias("campaign_types"),
        half_up(F.avg("roi_percentage"), 2).alias("avg_roi"),
        half_up(F.sum("generated_revenue"), 2).alias("total_generated_revenue"),
        half_up(F.sum("campaign_budget"), 2).alias("total_budget_spent"),
        half_up(F.avg("actual_conversion_rate"), 4).alias("avg_conversion_rate"),
        F.count_if(rating == "Excellent").alias("excellent_campaigns"),
        F.count_if(rating == "Negative").alias("negative_roi_campaigns"),
    )


def top_performing_campaigns(lake: Lakehouse) -> DataFrame:
    profitable = lake.gold("marketing_performance").where(c("roi_percentage") > 0)
    order = [c("roi_percentage").desc(), c("generated_revenue").desc(), c("campaign_name")]
    return top_rows(profitable, order, 20).select(
        "campaign_name",
        "campaign_type",
        "region",
        "start_date",
        "end_date",
        "campaign_budget",
        "generated_revenue",
        "roi_percentage",
        "cost_per_acquisition",
        "actual_conversion_rate",
        "performance_rating",
        "conversion_performance",
    )


def marketing_tests(lake: Lakehouse) -> DataFrame:
    counts = lake.gold("marketing_performance").agg(
        F.count_if(c("roi_percentage") > 1000).alias("roi"),
        F.count_if(c("campaign_budget") < 0).alias("budget"),
        F.count_if((c("actual_conversion_rate") > 100) | (c("target_conversion_rate") > 100)).alias("conversion"),
    )
    # Names of the tests and what they report.
    return verdicts(
        counts,
        {
            "roi": ("Test 1: ROI anormal (> 1000%)", "ROI anormaux détectés"),
            "budget": ("Test 2: Budgets négatifs", "budgets négatifs détectés"),
            "conversion": ("Test 3: Conversion rate > 100%", "taux de conversion > 100% détectés"),
        },
    )


def gold_summary(lake: Lakehouse) -> DataFrame:
    customers = summarise(
        lake.gold("customers_enriched"),
        {"dataset": "CUSTOMERS_ENRICHED"},
        total_records=F.count("*"),
        unique_customers=F.count_distinct("customer_id"),
        avg_lifetime_value=half_up(mean(c("lifetime_value")), 2),
    )
    campaigns = summarise(
        lake.gold("marketing_performance"),
        {"dataset": "MARKETING_PERFORMANCE"},
        total_records=F.count("*"),
        unique_customers=F.count_distinct("campaign_id"),
        avg_lifetime_value=half_up(F.avg("roi_percentage"), 2),
    )
    return stack([customers, campaigns])


def top_customers(lake: Lakehouse) -> DataFrame:
    ranked = top_rows(
        lake.gold("customers_enriched"), [c("lifetime_value").desc(), c("customer_name"), c("customer_id")], 10
    )
    return ranked.select(
        "customer_name",
        "customer_segment",
        "lifetime_value",
        "total_transactions",
        "days_since_last_purchase",
        "churn_risk_score",
    )


def campaign_type_analysis(lake: Lakehouse) -> DataFrame:
    return (
        lake.gold("marketing_performance")
        .groupBy("campaign_type")
        .agg(
            F.count("*").alias("campaign_count"),
            half_up(F.avg("roi_percentage"), 2).alias("avg_roi"),
            half_up(F.sum("generated_revenue"), 2).alias("total_revenue"),
            half_up(F.avg("cost_per_acquisition"), 2).alias("avg_cpa"),
        )
        .orderBy(c("avg_roi").desc_nulls_first(), "campaign_type")
    )


def segment_distribution(lake: Lakehouse) -> DataFrame:
    return (
        lake.gold("customers_enriched")
        .groupBy("customer_segment")
        .agg(
            F.count("*").alias("customer_count"),
            half_up(mean(c("lifetime_value")), 2).alias("avg_lifetime_value"),
            half_up(F.avg("age"), 1).alias("avg_age"),
            half_up(mean(c("annual_income")), 2).alias("avg_income"),
            F.count_if(c("churn_risk_score") >= 3).alias("at_risk_count"),
        )
        .orderBy(c("avg_lifetime_value").desc_nulls_first(), "customer_segment")
    )


