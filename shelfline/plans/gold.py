"""Gold: the enriched sales fact and the promotion, customer and campaign tables.

A sale joins every promotion and every campaign running in its region on its day, so all sales of one (region, day)
cell repeat the same number of times. Only ``sales_enriched`` writes those repetitions out. Everything computed *over*
it works on cells: sales are aggregated per cell once, running promotions and campaigns are counted per cell, and the
repetition is a multiplication.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import bands
from shelfline.functions.dialect import flag, half_up, lenient_id, percent, ratio, years_between
from shelfline.operators.intervals import days_covered, range_stats, range_visitors, running_keys, split_by_ranges
from shelfline.operators.sizing import measured_side
from shelfline.operators.visitor_sets import merged, set_sizes, visitor_sets
from shelfline.plans import cells

if TYPE_CHECKING:
    from shelfline.lakehouse import Lakehouse

CELL = ["sale_region", "sale_date"]
RANGE = ["region", "start_date", "end_date"]
WIDE = "decimal(38,0)"


def audited(df: DataFrame, source: str) -> DataFrame:
    """Add the audit columns every Gold table carries."""
    return df.withColumns(
        {
            "created_at": F.current_timestamp(),
            "created_by": F.current_user(),
            "data_version": F.lit("v1.0"),
            "data_source": F.lit(source),
        }
    )


AUDIT = ("created_at", "created_by", "data_version", "data_source")


def sales(lake: Lakehouse) -> DataFrame:
    """Transactions of type Sale under their Gold names."""
    sold = lake.silver("financial_transactions_clean").where(F.col("transaction_type") == "Sale")
    return sold.select(
        F.col("transaction_id").alias("sale_id"),
        F.col("transaction_date").alias("sale_date"),
        F.col("amount").alias("sale_amount"),
        "payment_method",
        F.col("entity").alias("merchant_entity"),
        F.col("region").alias("sale_region"),
        "account_code",
    )


def _cells_of(per_range: DataFrame) -> DataFrame:
    return days_covered(per_range, day="sale_date").withColumnRenamed("region", "sale_region")


def promotion_cells(lake: Lakehouse) -> DataFrame:
    """Counts of the promotions running in each cell, summed per distinct range before expanding into days."""
    discount = F.coalesce(F.col("discount_percentage"), F.lit(0.0))
    kept = 1 - discount / 100.0
    counts = {
        "promotions": F.count("*"),
        "named_promotions": F.count("promotion_id"),
        "discount_points": F.sum(discount),
        "over_discounts": F.count_if(discount > 100),
        "price_rises": F.count_if(kept > 1),
        "price_cuts": F.count_if(kept < 1),
    }
    per_range = lake.silver("promotions_clean").groupBy(*RANGE).agg(*[e.alias(name) for name, e in counts.items()])
    return _cells_of(per_range).groupBy(*CELL).agg(*[F.sum(name).alias(name) for name in counts])


def campaign_cells(lake: Lakehouse) -> DataFrame:
    """Counts of the campaigns running in each cell."""
    counts = {"campaigns": F.count("*"), "named_campaigns": F.count("campaign_id")}
    campaigns = lake.silver("marketing_campaigns_clean")
    per_range = campaigns.groupBy(*RANGE).agg(*[e.alias(name) for name, e in counts.items()])
    return _cells_of(per_range).groupBy(*CELL).agg(*[F.sum(name).alias(name) for name in counts])


OFFER_COUNTS = ("promotions", "named_promotions", "over_discounts", "price_rises", "price_cuts")
OFFER_COUNTS += ("campaigns", "named_campaigns")


def offer_cells(lake: Lakehouse) -> DataFrame:
    """Cells in which any promotion or campaign runs."""
    return with_repeats(promotion_cells(lake).join(campaign_cells(lake), CELL, "full"))


def with_repeats(offers: DataFrame) -> DataFrame:
    """How often the fact repeats a sale of each cell: ``promo_rows`` and ``campaign_rows`` from each side, 1 where
    nothing runs, and ``repeats``, their product."""
    filled = offers.fillna(0, subset=list(OFFER_COUNTS)).fillna(0.0, subset=["discount_points"])
    return (
        filled.withColumn("promo_rows", F.greatest(F.lit(1), F.col("promotions")))
        .withColumn("campaign_rows", F.greatest(F.lit(1), F.col("campaigns")))
        .withColumn("repeats", F.col("promo_rows") * F.col("campaign_rows"))
    )


SALES_SUMS = ("sales", "named_sales", "amount", "positive_sales", "negative_sales", "card_sales", "cash_sales", "transfer_sales")


def sales_cells(lake: Lakehouse, paid_only: bool = False) -> DataFrame:
    """Sales of each cell with the cell's repetitions; one row per region and day however many sales.

    From the written cells where there are any. ``paid_only``: sales of positive amounts.
    """
    days = cells.written(lake, "transaction_days", "Sale")
    if days is None:
        days = lake.silver("financial_transactions_clean").where(F.col("transaction_type") == "Sale")
        days = days.where(F.col("amount") > 0) if paid_only else days
        sums = {name: e for name, e in cells.measures().items() if name in SALES_SUMS}
    else:
        days = days.where("paid") if paid_only else days
        sums = {name: F.sum(name) for name in SALES_SUMS}
    by_cell = days.groupBy(F.col("region").alias("sale_region"), F.col("transaction_date").alias("sale_date"))
    summed = by_cell.agg(*[e.alias(name) for name, e in sums.items()])
    offers = promotion_cells(lake).join(campaign_cells(lake), CELL, "full")
    return with_repeats(summed.join(offers, CELL, "left"))


def _sales_columns(lake: Lakehouse) -> DataFrame:
    """Sales with the columns that depend on the sale alone; ``paid`` is the amount to calculate with."""
    day, amount = F.col("sale_date"), F.col("sale_amount")
    return sales(lake).withColumns(
        {
            "paid": amount.cast("double"),
            "sale_year": F.year(day),
            "sale_month": F.month(day),
            "sale_quarter": F.quarter(day),
            "sale_day_of_week": F.dayofweek(day),
            "sale_week_start": F.trunc(day, "week"),
            "amount_category": bands.SALE_SIZE.name(amount),
            "day_type": F.when(F.dayofweek(day).isin(1, 7), "Weekend").otherwise("Weekday"),
        }
    )


def _promotion_days(lake: Lakehouse) -> DataFrame:
    """One row per promotion and cell it runs in."""
    return _cells_of(lake.silver("promotions_clean").withColumns(
        {"promo_start_date": F.col("start_date"), "promo_end_date": F.col("end_date")}
    )).select(
        *CELL,
        "promotion_id",
        F.col("product_category").alias("promo_product_category"),
        "promotion_type",
        "discount_percentage",
        "promo_start_date",
        "promo_end_date",
    )


def _campaign_days(lake: Lakehouse) -> DataFrame:
    """One row per campaign and cell it runs in."""
    return _cells_of(lake.silver("marketing_campaigns_clean")).select(
        *CELL,
        "campaign_id",
        "campaign_name",
        "campaign_type",
        F.col("product_category").alias("campaign_product_category"),
        F.col("target_audience").alias("campaign_target"),
        F.col("budget").alias("campaign_budget"),
        F.col("reach").alias("campaign_reach"),
        F.col("conversion_rate").alias("campaign_conversion_rate"),
    )


def sales_enriched(lake: Lakehouse) -> DataFrame:
    """Each sale with the promotions and campaigns running in its region on its day.

    Sales, campaigns and promotions are each dealt by cell once and combined there row by row, so what is shuffled, sorted
    and held grows with the sales and the days of the ranges, not with their product. The number of tasks is given, as
    adaptive execution would merge them by the bytes they read, which do not show the rows they make. Columns are made on
    the side they depend on, before its rows repeat.
    """
    dealt = _sales_columns(lake)
    dealt = dealt.repartition(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), *CELL)
    paid, rate = F.col("paid"), F.col("campaign_conversion_rate")
    has_campaign = F.col("campaign_id").isNotNull()
    with_campaigns = dealt.join(measured_side(_campaign_days(lake)), CELL, "left").withColumns(
        {
            "has_campaign": flag(has_campaign),
            "estimated_campaign_impact": F.when(has_campaign & (rate > 0), paid * rate).otherwise(0.0),
        }
    )
    fact = with_campaigns.join(measured_side(_promotion_days(lake)), CELL, "left")
    discount = F.coalesce(F.col("discount_percentage"), F.lit(0.0))
    enriched = fact.select(
        "sale_id",
        "sale_date",
        "sale_amount",
        "payment_method",
        "merchant_entity",
        "sale_region",
        "account_code",
        "sale_year",
        "sale_month",
        "sale_quarter",
        "sale_day_of_week",
        "sale_week_start",
        "promotion_id",
        "promo_product_category",
        "promotion_type",
        "discount_percentage",
        "promo_start_date",
        "promo_end_date",
        flag(F.col("promotion_id").isNotNull()).alias("has_promotion"),
        discount.alias("discount_rate"),
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "campaign_product_category",
        "campaign_target",
        "campaign_budget",
        "campaign_reach",
        "campaign_conversion_rate",
        "has_campaign",
        (paid * (1 - discount / 100.0)).alias("net_amount"),
        "estimated_campaign_impact",
        "amount_category",
        "day_type",
    )
    return audited(enriched, "SALES_ENRICHED")


def daily_sales_summary(lake: Lakehouse) -> DataFrame:
    """Day by region: volumes, promotion and campaign reach, discounts and payment methods."""
    c = F.col
    running = {
        "active_promotions": running_keys(
            lake.silver("promotions_clean"), "promotion_id", on=["region"], day="sale_date", name="active_promotions"
        ),
        "active_campaigns": running_keys(
            lake.silver("marketing_campaigns_clean"), "campaign_id", on=["region"], day="sale_date",
            name="active_campaigns",
        ),
    }
    days = sales_cells(lake)
    for name, counts in running.items():
        days = days.join(counts.withColumnRenamed("region", "sale_region"), CELL, "left").fillna(0, subset=[name])
    return days.select(
        "sale_date",
        "sale_region",
        (c("sales") * c("repeats")).alias("total_transactions"),
        (c("amount").cast(WIDE) * c("repeats")).alias("total_revenue"),
        ratio(c("amount"), c("sales")).alias("avg_transaction_value"),
        "active_promotions",
        (c("sales") * c("named_promotions") * c("campaign_rows")).alias("transactions_with_promo"),
        percent(c("named_promotions"), c("promo_rows")).alias("promo_penetration_rate"),
        "active_campaigns",
        (c("sales") * c("promo_rows") * c("named_campaigns")).alias("transactions_with_campaign"),
        ratio(c("discount_points"), c("promo_rows")).alias("avg_discount_rate"),
        (c("amount").cast("double") * c("campaign_rows") * c("discount_points") / 100.0).alias("total_discount_given"),
        (c("card_sales") * c("repeats")).alias("cc_transactions"),
        (c("cash_sales") * c("repeats")).alias("cash_transactions"),
        (c("transfer_sales") * c("repeats")).alias("transfer_transactions"),
    )


def daily_region_sales(lake: Lakehouse) -> DataFrame:
    return sales_cells(lake).select(
        *CELL,
        (F.col("sales") * F.col("repeats")).alias("daily_sales_count"),
        (F.col("amount").cast(WIDE) * F.col("repeats")).alias("daily_total_revenue"),
    )


def _cells_by_region(lake: Lakehouse) -> DataFrame:
    """Cells keyed as promotions and campaigns are, with the totals a range sums up."""
    c = F.col
    return sales_cells(lake).select(
        c("sale_region").alias("region"),
        "sale_date",
        (c("sales") * c("campaign_rows")).alias("sales_per_promotion"),
        (c("amount").cast(WIDE) * c("campaign_rows")).alias("amount_per_promotion"),
        (c("sales") * c("promo_rows")).alias("sales_per_campaign"),
        (c("amount").cast(WIDE) * c("promo_rows")).alias("amount_per_campaign"),
        (c("sales") * c("repeats")).alias("all_sales"),
    )


def _buyers(ranges: DataFrame, key: str, lake: Lakehouse) -> DataFrame:
    """Exact distinct buying entities per ``key`` over its ranges: (key, unique_buyers).

    A key's ranges are merged into islands. A key with one island takes the count of that island. The buyers of several
    islands may be the same ones, also through visits in between, so they are merged as sets: the bitmaps of an island's days
    once an island, then those of a key's islands. No buyer is listed beside a key.
    """
    visits = sales(lake).select(F.col("sale_region").alias("region"), "sale_date", "merchant_entity")
    single, several = split_by_ranges(ranges, key, ["region"])
    counted = range_visitors(
        single, visits, visitor="merchant_entity", day="sale_date", on=["region"], name="unique_buyers"
    )
    of_single = single.join(counted, RANGE).select(key, "unique_buyers")
    days = days_covered(several.select(*RANGE).distinct(), day="sale_date")
    wanted = measured_side(days.select("region", "sale_date").distinct())
    sets = visitor_sets(visits.join(wanted, ["region", "sale_date"], "left_semi"), ["region", "sale_date"], "merchant_entity")
    of_island = merged(measured_side(days).join(sets, ["region", "sale_date"]), RANGE)
    of_several = set_sizes(several.join(of_island, RANGE), [key], "unique_buyers")
    return of_single.unionByName(of_several)


def promotion_sales(lake: Lakehouse) -> DataFrame:
    """Sales of each promotion id, as summed over the fact, and all sales in its region and period."""
    promotions = lake.silver("promotions_clean").where(F.col("promotion_id").isNotNull())
    over_range = range_stats(
        promotions,
        _cells_by_region(lake),
        [
            F.sum("sales_per_promotion").alias("range_sales"),
            F.sum("amount_per_promotion").alias("range_amount"),
            F.sum("all_sales").alias("range_market"),
        ],
        day="sale_date",
        on=["region"],
    )
    share = F.col("discount_percentage") / 100.0
    amount = F.col("range_amount").cast("double")
    summed = (
        promotions.select("promotion_id", "discount_percentage", *RANGE)
        .join(over_range, RANGE)
        .groupBy("promotion_id")
        .agg(
            F.sum("range_sales").alias("sale_count"),
            F.sum("range_amount").alias("total_revenue"),
            F.sum(amount * (1 - share)).alias("total_net_revenue"),
            F.sum(amount * share).alias("total_discount_given"),
            F.sum("range_market").alias("total_sales_in_period"),
        )
    )
    return summed.join(_buyers(promotions, "promotion_id", lake), "promotion_id", "left")


def promotions_active(lake: Lakehouse) -> DataFrame:
    """Promotion catalogue with status, sales, return and market share."""
    c, today = F.col, lake.today
    start, end = c("start_date"), c("end_date")
    joined = lake.silver("promotions_clean").join(promotion_sales(lake), "promotion_id", "left")
    sold = F.coalesce("sale_count", F.lit(0))
    net, cost = F.coalesce("total_net_revenue", F.lit(0.0)), F.coalesce("total_discount_given", F.lit(0.0))
    market = c("total_sales_in_period")
    table = joined.select(
        "promotion_id",
        "product_category",
        "promotion_type",
        "discount_percentage",
        "start_date",
        "end_date",
        "region",
        F.datediff(end, start).alias("duration_days"),
        F.month(start).alias("start_month"),
        F.quarter(start).alias("start_quarter"),
        F.year(start).alias("start_year"),
        F.when(today < start, "Scheduled")
        .when(today.between(start, end), "Active")
        .when(today > end, "Completed")
        .otherwise("Unknown")
        .alias("promotion_status"),
        sold.alias("total_sales"),
        F.coalesce(c("total_revenue"), F.lit(0).cast(WIDE)).alias("total_gross_revenue"),
        F.coalesce(ratio(c("total_revenue"), c("sale_count")), F.lit(0.0)).alias("avg_transaction_amount"),
        F.coalesce("unique_buyers", F.lit(0)).alias("unique_customers_reached"),
        cost.alias("total_discount_cost"),
        net.alias("total_net_revenue"),
        F.when(cost > 0, percent(net - cost, cost)).otherwise(0.0).alias("roi_percentage"),
        F.when(cost > 0, half_up(ratio(net, cost), 2)).alias("revenue_per_discount_euro"),
        F.lit(0).alias("market_share_pct"),
        F.when(market > 0, percent(sold, market)).otherwise(0.0).alias("market_share_pct_calculated"),
        F.coalesce(market, F.lit(0)).alias("total_market_sales"),
    )
    return audited(table, "PROMOTIONS_ACTIVE")


def customer_sales(lake: Lakehouse) -> DataFrame:
    """Purchases of each numeric entity, as summed over the fact."""
    offers = measured_side(offer_cells(lake).select(*CELL, "repeats"))
    repeats = F.coalesce("repeats", F.lit(1))
    return (
        sales(lake)
        .withColumn("customer_id", lenient_id(F.col("merchant_entity")))
        .where(F.col("customer_id").isNotNull())
        .join(offers, CELL, "left")
        .groupBy("customer_id")
        .agg(
            F.sum(F.col("sale_amount").cast(WIDE) * repeats).alias("total_spent"),
            F.sum(repeats).alias("transaction_count"),
            F.min("sale_date").alias("first_day"),
            F.max("sale_date").alias("last_day"),
        )
    )


def customers_enriched(lake: Lakehouse) -> DataFrame:
    """Customers with purchase behaviour and recency, value and frequency segments."""
    c, today = F.col, lake.today
    joined = lake.silver("customer_demographics_clean").join(customer_sales(lake), "customer_id", "left")
    idle = F.coalesce(F.datediff(today, c("last_day")), F.lit(bands.NEVER_BOUGHT_DAYS))
    spent = F.coalesce(c("total_spent"), F.lit(0).cast(WIDE))
    count = F.coalesce("transaction_count", F.lit(0))
    measured = joined.select(
        "customer_id",
        c("name").alias("customer_name"),
        "date_of_birth",
        "gender",
        c("region").alias("customer_region"),
        c("country").alias("customer_country"),
        c("city").alias("customer_city"),
        "marital_status",
        "annual_income",
        years_between(c("date_of_birth"), today).alias("age"),
        bands.AGE_GROUP.name(c("age")).alias("age_group"),
        bands.INCOME_EN.name(c("annual_income")).alias("income_segment"),
        spent.alias("lifetime_value"),
        count.alias("total_transactions"),
        F.coalesce(ratio(c("total_spent"), c("transaction_count")), F.lit(0.0)).alias("avg_transaction_value"),
        F.coalesce(c("first_day"), today).alias("first_purchase_date"),
        F.coalesce(c("last_day"), today).alias("last_purchase_date"),
        idle.alias("days_since_last_purchase"),
        F.lit(0).alias("service_interaction_count"),
        F.lit(0).alias("avg_satisfaction_score"),
        F.lit(0).alias("complaint_count"),
        F.lit(None).cast("date").alias("last_contact_date"),
        bands.RECENCY.name(idle).alias("recency_segment"),
        bands.MONETARY.name(spent).alias("monetary_segment"),
        bands.FREQUENCY.name(count).alias("frequency_segment"),
    )
    recency, money = c("recency_segment"), c("monetary_segment")
    valuable = money.isin("VIP", "High Value")
    engaged = recency.isin("Recent", "Active")
    segmented = measured.withColumns(
        {
            "customer_segment": F.when((recency == "Recent") & valuable, "Champions")
            .when((recency == "Recent") & (c("frequency_segment") == "Frequent"), "Loyal Customers")
            .when((recency == "At Risk") & valuable, "At Risk High Value")
            .when((recency == "Churned") & valuable, "Lost Champions")
            .when(recency == "Recent", "New/Recent Customers")
            .when(money == "Low Value", "Price Sensitive")
            .otherwise("Other"),
            "churn_risk_score": F.when(recency == "Churned", 5).when(recency == "At Risk", 3).otherwise(1),
            "loyalty_score": F.when(valuable & engaged, 5)
            .when(money.isin("Medium Value", "Low Value") & engaged, 3)
            .otherwise(1),
        }
    )
    return audited(segmented, "CUSTOMERS_ENRICHED")


def campaign_sales(lake: Lakehouse) -> DataFrame:
    """Sales of each campaign id, as summed over the fact."""
    campaigns = lake.silver("marketing_campaigns_clean").where(F.col("campaign_id").isNotNull())
    over_range = range_stats(
        campaigns,
        _cells_by_region(lake),
        [F.sum("sales_per_campaign").alias("range_sales"), F.sum("amount_per_campaign").alias("range_amount")],
        day="sale_date",
        on=["region"],
    )
    summed = (
        campaigns.select("campaign_id", *RANGE)
        .join(over_range, RANGE)
        .groupBy("campaign_id")
        .agg(F.sum("range_sales").alias("sold"), F.sum("range_amount").alias("revenue"))
    )
    return summed.join(_buyers(campaigns, "campaign_id", lake), "campaign_id", "left")


def marketing_performance(lake: Lakehouse, target_as_percent: bool = False) -> DataFrame:
    """Campaigns with sales, return and ratings.

    The actual conversion rate is a percentage and the target a fraction; they are compared as they stand unless
    ``target_as_percent`` asks for the target to be scaled first.
    """
    c = F.col
    joined = lake.silver("marketing_campaigns_clean").join(campaign_sales(lake), "campaign_id", "left")
    budget, start, end = c("budget"), c("start_date"), c("end_date")
    sold = F.coalesce("sold", F.lit(0))
    revenue = F.coalesce(c("revenue"), F.lit(0).cast(WIDE))
    buyers = F.coalesce("unique_buyers", F.lit(0))
    earned = revenue.cast("double")
    measured = joined.select(
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "product_category",
        "target_audience",
        "start_date",
        "end_date",
        "region",
        F.datediff(end, start).alias("campaign_duration_days"),
        F.month(start).alias("start_month"),
        F.quarter(start).alias("start_quarter"),
        F.year(start).alias("start_year"),
        budget.alias("campaign_budget"),
        c("reach").alias("estimated_reach"),
        c("conversion_rate").alias("target_conversion_rate"),
        sold.alias("actual_sales"),
        revenue.alias("generated_revenue"),
        buyers.alias("unique_customers_acquired"),
        F.coalesce(ratio(c("revenue"), c("sold")), F.lit(0.0)).alias("avg_transaction_value"),
        F.when(budget > 0, percent(earned - budget, budget)).otherwise(0.0).alias("roi_percentage"),
        F.when(budget > 0, half_up(ratio(earned, budget), 2)).otherwise(0.0).alias("revenue_per_euro_spent"),
        F.when(c("reach") > 0, percent(sold, c("reach"), 4)).otherwise(0.0).alias("actual_conversion_rate"),
        F.when(sold > 0, half_up(ratio(budget, sold), 2)).alias("cost_per_acquisition"),
        F.when(buyers > 0, half_up(ratio(budget, buyers), 2)).alias("cost_per_unique_customer"),
        F.when(buyers > 0, half_up(ratio(earned, buyers), 2)).otherwise(0.0).alias("avg_customer_lifetime_value"),
    )
    target = c("target_conversion_rate") * 100 if target_as_percent else c("target_conversion_rate")
    rated = measured.withColumns(
        {
            "performance_rating": bands.CAMPAIGN_RATING.name(c("roi_percentage")),
            "conversion_performance": bands.against(
                c("actual_conversion_rate"), target, bands.CONVERSION_VS_TARGET, bands.CONVERSION_BELOW
            ),
        }
    )
    return audited(rated, "MARKETING_PERFORMANCE")


TABLES = {
    "sales_enriched": sales_enriched,
    "daily_sales_summary": daily_sales_summary,
    "daily_region_sales": daily_region_sales,
    "promotions_active": promotions_active,
    "customers_enriched": customers_enriched,
    "marketing_performance": marketing_performance,
}

# Layout of the written Gold tables: clustering columns, then an id that spreads a hot cluster over several tasks.
CLUSTERING = {
    "sales_enriched": (("sale_date", "sale_region"), "sale_id"),
    "promotions_active": (("start_date", "region", "promotion_type"), "promotion_id"),
    "customers_enriched": (("customer_region", "customer_segment", "income_segment"), "customer_id"),
    "marketing_performance": (("start_date", "region", "campaign_type"), "campaign_id"),
}
