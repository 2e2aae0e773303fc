"""Silver: one cleaning pipeline per Bronze table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import bands
from shelfline.functions.dialect import (
    flag,
    lenient_date,
    lenient_number,
    ratio,
    without_spaces,
    years_between,
)
from shelfline.operators.keep_one import keep_first
from shelfline.sources.schemas import INVENTORY_FIELDS, STORE_FIELDS


def financial_transactions(bronze: DataFrame, as_of: Column) -> DataFrame:
    """Whole positive amounts; then the earliest row of each transaction id."""
    amounts = bronze.withColumn("amount", lenient_number(without_spaces(F.col("amount"))))
    return keep_first(
        amounts.where(F.col("amount") > 0),
        "transaction_id",
        [F.col("transaction_date").asc_nulls_last()],
        ties=["transaction_type", "amount", "entity"],
    )


def promotions(bronze: DataFrame, as_of: Column) -> DataFrame:
    ordered = F.col("start_date") <= F.col("end_date")
    return bronze.where(ordered & F.col("discount_percentage").between(0, 100)).distinct()


def customer_demographics(bronze: DataFrame, as_of: Column) -> DataFrame:
    known = F.col("customer_id").isNotNull() & F.col("date_of_birth").isNotNull() & (F.col("annual_income") >= 0)
    return bronze.where(known).distinct().withColumn("age", years_between(F.col("date_of_birth"), as_of))


def employee_records(bronze: DataFrame, as_of: Column) -> DataFrame:
    parsed = bronze.withColumns(
        {
            "salary": lenient_number(without_spaces(F.col("salary"))),
            "email": F.replace("email", F.lit("mailto:"), F.lit("")),
            "tenure_years": years_between(F.col("hire_date"), as_of),
            "age": years_between(F.col("date_of_birth"), as_of),
        }
    )
    return parsed.where((F.col("salary") > 0) & F.col("employee_id").isNotNull() & F.col("hire_date").isNotNull())


def supplier_information(bronze: DataFrame, as_of: Column) -> DataFrame:
    valid = (F.col("lead_time") > 0) & F.col("reliability_score").between(0, 1) & F.col("supplier_id").isNotNull()
    return (
        bronze.where(valid).distinct().withColumn("reliability_category", bands.RELIABILITY.name(F.col("reliability_score")))
    )


def logistics_and_shipping(bronze: DataFrame, as_of: Column) -> DataFrame:
    parsed = bronze.withColumns(
        {
            "shipping_cost": lenient_number(without_spaces(F.col("shipping_cost"))),
            "destination_region": F.nullif("destination_region", F.lit("")),
            "destination_country": F.nullif("destination_country", F.lit("")),
            "estimated_delivery_days": F.datediff("estimated_delivery", "ship_date"),
            "delivery_status": F.when(as_of > F.col("estimated_delivery"), "En retard").otherwise("Dans les temps"),
        }
    )
    return parsed.where(
        F.col("shipping_cost").isNotNull()
        & F.col("shipment_id").isNotNull()
        & (F.col("ship_date") <= F.col("estimated_delivery"))
    )


def customer_service_interactions(bronze: DataFrame, as_of: Column) -> DataFrame:
    status = F.col("resolution_status")
    rated = bronze.where(F.col("interaction_id").isNotNull() & (F.col("duration_minutes") >= 0))
    return rated.withColumns(
        {
            "satisfaction_category": bands.SATISFACTION.name(F.col("customer_satisfaction")),
            "is_resolved": flag(status.ilike("%resolved%") | status.ilike("%closed%")),
        }
    )


def marketing_campaigns(bronze: DataFrame, as_of: Column) -> DataFrame:
    budget, reach, rate = F.col("budget"), F.col("reach"), F.col("conversion_rate")
    valid = (F.col("start_date") <= F.col("end_date")) & (budget >= 0) & (reach >= 0) & rate.between(0, 1)
    return bronze.where(valid).withColumns(
        {
            "cpa": F.when((rate > 0) & (budget > 0), ratio(budget, reach * rate)),
            "efficiency_category": bands.CONVERSION_EFFICIENCY.name(rate),
        }
    )


def product_reviews(bronze: DataFrame, as_of: Column) -> DataFrame:
    """Fields cut at every comma; the latest review of each reviewer, where an unreadable date counts as latest."""

    def field(position: int) -> Column:
        return F.split_part("raw_line", F.lit(","), F.lit(position))

    parsed = bronze.where(F.col("raw_line") != "").select(
        field(1).alias("reviewer_id"),
        field(2).alias("reviewer_name"),
        lenient_number(field(3)).alias("rating"),
        lenient_date(field(4)).alias("review_date"),
        field(5).alias("product_category"),
    )
    latest = keep_first(parsed, "reviewer_id", [F.col("review_date").desc_nulls_first()])
    return latest.withColumn("sentiment", bands.SENTIMENT.name(F.col("rating")))


def _elements(bronze: DataFrame, fields: tuple[tuple[str, str], ...]) -> DataFrame:
    """One row per array element with typed fields; elements lacking the first field are dropped."""
    key = fields[0][0]
    spark = bronze.sparkSession
    items = bronze.lateralJoin(spark.tvf.variant_explode(F.col("raw_data").outer())).select("value")
    typed = [F.try_variant_get("value", f"$.{name}", kind).alias(name) for name, kind in fields]
    return items.select(*typed).where(F.col(key).isNotNull())


def inventory(bronze: DataFrame, as_of: Column) -> DataFrame:
    return _elements(bronze, INVENTORY_FIELDS).withColumns(
        {
            "stock_level": bands.stock_level(F.col("current_stock"), F.col("reorder_point")),
            "days_since_restock": F.datediff(as_of, F.col("last_restock_date")),
        }
    )


def store_locations(bronze: DataFrame, as_of: Column) -> DataFrame:
    area = F.col("square_footage")
    return _elements(bronze, STORE_FIELDS).withColumn(
        "employee_density", F.when(area > 0, ratio(F.col("employee_count"), area))
    )


# Silver table -> (Bronze table, cleaning pipeline).
TABLES = {
    "financial_transactions_clean": ("financial_transactions", financial_transactions),
    "promotions_clean": ("promotions_data", promotions),
    "customer_demographics_clean": ("customer_demographics", customer_demographics),
    "employee_records_clean": ("employee_records", employee_records),
    "supplier_information_clean": ("supplier_information", supplier_information),
    "logistics_and_shipping_clean": ("logistics_and_shipping", logistics_and_shipping),
    "customer_service_interactions_clean": ("customer_service_interactions", customer_service_interactions),
    "marketing_campaigns_clean": ("marketing_campaigns", marketing_campaigns),
    "product_reviews_clean": ("product_reviews", product_reviews),
    "inventory_clean": ("inventory_staging", inventory),
    "store_locations_clean": ("store_locations_staging", store_locations),
}
