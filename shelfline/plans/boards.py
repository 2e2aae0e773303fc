"""Queries behind the sales, promotion and campaign dashboards.

The analyst's filters are function parameters; an empty selection or ``ALL`` means no filter, as on the dashboards.
"""

from __future__ import annotations

from collections.abc import Collection
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.dialect import ratio
from shelfline.operators.ordered import top_rows
from shelfline.operators.stacking import stack, stack_ragged
from shelfline.plans.gold import CELL, WIDE, offer_cells, sales, sales_cells

if TYPE_CHECKING:
    from shelfline.lakehouse import Lakehouse

c = F.col
ALL = "ALL"

# Dashboard choices and the table values they stand for.
STATUS_CHOICES = {"ACTIVE": "Active", "UPCOMING": "Scheduled", "EXPIRED": "Completed"}
RATING_CHOICES = {"EXCELLENT": "Excellent", "GOOD": "Good", "AVERAGE": "Acceptable", "POOR": "Poor"}


# Sales


def _paid_cells(lake: Lakehouse) -> DataFrame:
    return sales_cells(lake, paid_only=True)


def _rows() -> Column:
    return F.sum(c("sales") * c("repeats"))


def _revenue() -> Column:
    return F.sum(c("amount").cast(WIDE) * c("repeats"))


def sales_kpis(lake: Lakehouse) -> DataFrame:
    return _paid_cells(lake).agg(
        F.coalesce(_rows(), F.lit(0)).alias("transactions"),
        _revenue().alias("revenue"),
        ratio(_revenue(), _rows()).alias("avg_ticket"),
        F.min("sale_date").alias("first_date"),
        F.max("sale_date").alias("last_date"),
    )


def daily_trend(lake: Lakehouse) -> DataFrame:
    """Last 30 sale days, oldest first."""
    days = (
        _paid_cells(lake)
        .groupBy("sale_date")
        .agg(_revenue().alias("daily_revenue"), _rows().alias("daily_transactions"))
    )
    return top_rows(days, [c("sale_date").desc_nulls_first()], 30).orderBy("sale_date")


def top_regions(lake: Lakehouse) -> DataFrame:
    regions = (
        _paid_cells(lake)
        .where(c("sale_region").isNotNull())
        .groupBy("sale_region")
        .agg(_rows().alias("transactions"), _revenue().alias("revenue"))
    )
    return top_rows(regions, [c("revenue").desc_nulls_first(), c("sale_region")], 10)


def recent_sales(lake: Lakehouse) -> DataFrame:
    """Last 20 rows of the fact.

    Every sale has at least one row there, so they belong to the last 20 sales; only those are repeated. A sale's
    rows agree on the columns shown: whether a named promotion runs is the same for all, unless unnamed ones mix in.
    """
    order = [c("sale_date").desc_nulls_first(), c("sale_id")]
    latest = top_rows(sales(lake).where(c("sale_amount") > 0), order, 20)
    offers = offer_cells(lake).select(*CELL, "promo_rows", "named_promotions", "campaign_rows")
    known = latest.join(offers, CELL, "left").fillna({"promo_rows": 1, "named_promotions": 0, "campaign_rows": 1})
    with_promotion = c("named_promotions") * c("campaign_rows")
    without = (c("promo_rows") - c("named_promotions")) * c("campaign_rows")

    def times(count: Column, label: str) -> Column:
        return F.array_repeat(F.lit(label), F.least(count, F.lit(20)).cast("int"))

    shown = known.withColumn("promotion", F.explode(F.concat(times(with_promotion, "Oui"), times(without, "Non"))))
    columns = ["sale_date", "sale_id", "sale_region", "sale_amount", "payment_method", "promotion"]
    return top_rows(shown, [*order, c("promotion").desc()], 20).select(*columns)


# Promotions


def promotion_types(lake: Lakehouse) -> DataFrame:
    kinds = lake.gold("promotions_active").select("promotion_type").where(c("promotion_type").isNotNull())
    return kinds.distinct().orderBy("promotion_type")


def promotion_kpis(lake: Lakehouse) -> DataFrame:
    """Global promotion figures; the status test names a label the table never holds, so it removes nothing."""
    status = c("promotion_status")
    kept = lake.gold("promotions_active").where((status != "EXPIRED") | status.isNull())
    return kept.agg(
        F.count("*").alias("total_promotions"),
        F.count_if(status == STATUS_CHOICES["ACTIVE"]).alias("active_promotions"),
        F.count_if(status == STATUS_CHOICES["UPCOMING"]).alias("upcoming_promotions"),
        F.sum("total_gross_revenue").alias("total_gross_revenue"),
        F.sum("total_discount_cost").alias("total_discount_cost"),
        F.avg("roi_percentage").alias("avg_roi"),
        F.avg("revenue_per_discount_euro").alias("avg_revenue_per_discount"),
        F.sum("total_sales").alias("total_transactions"),
        F.sum("unique_customers_reached").alias("total_customers_reached"),
    )


def promotion_details(lake: Lakehouse) -> DataFrame:
    catalogue = lake.gold("promotions_active").select(
        "promotion_id",
        "product_category",
        "promotion_type",
        "discount_percentage",
        "start_date",
        "end_date",
        "region",
        "duration_days",
        "promotion_status",
        "total_sales",
        "total_gross_revenue",
        "total_discount_cost",
        "total_net_revenue",
        "roi_percentage",
        "revenue_per_discount_euro",
        "unique_customers_reached",
        "market_share_pct",
        "avg_transaction_amount",
    )
    return catalogue.orderBy(
        c("start_date").desc_nulls_first(), c("roi_percentage").desc_nulls_first(), c("promotion_id")
    )


def _promotions_by(lake: Lakehouse, key: str, **measures: Column) -> DataFrame:
    known = lake.gold("promotions_active").where(c(key).isNotNull())
    common = {
        "promotion_count": F.count("*"),
        "total_revenue": F.sum("total_gross_revenue"),
        "total_discount": F.sum("total_discount_cost"),
        "avg_roi": F.avg("roi_percentage"),
        "total_transactions": F.sum("total_sales"),
    }
    return known.groupBy(key).agg(*[column.alias(name) for name, column in {**common, **measures}.items()])


def _by_revenue() -> Column:
    return c("total_revenue").desc_nulls_first()


def promo_by_type(lake: Lakehouse) -> DataFrame:
    return _promotions_by(
        lake,
        "promotion_type",
        avg_discount_pct=F.avg("discount_percentage"),
        avg_revenue_per_euro=F.avg("revenue_per_discount_euro"),
        total_customers=F.sum("unique_customers_reached"),
    ).orderBy(_by_revenue(), "promotion_type")


def promo_by_region(lake: Lakehouse) -> DataFrame:
    return _promotions_by(
        lake,
        "region",
        total_customers=F.sum("unique_customers_reached"),
        avg_market_share=F.avg("market_share_pct"),
        avg_market_share_calculated=F.avg("market_share_pct_calculated"),
    ).orderBy(_by_revenue(), "region")


def promo_by_category(lake: Lakehouse) -> DataFrame:
    categories = _promotions_by(
        lake,
        "product_category",
        avg_discount_pct=F.avg("discount_percentage"),
        avg_ticket=F.avg("avg_transaction_amount"),
    )
    return top_rows(categories, [_by_revenue(), c("product_category")], 15)


def promo_roi_vs_discount(lake: Lakehouse) -> DataFrame:
    """Category table behind the return-against-discount chart."""
    return promo_by_category(lake).select("product_category", "avg_discount_pct", "avg_roi", "total_revenue")


def promo_by_period(lake: Lakehouse) -> DataFrame:
    period = ["start_year", "start_quarter", "start_month"]
    return (
        lake.gold("promotions_active")
        .where(c("start_year").isNotNull())
        .groupBy(*period, "promotion_status")
        .agg(
            F.count("*").alias("promotion_count"),
            F.sum("total_gross_revenue").alias("total_revenue"),
            F.sum("total_discount_cost").alias("total_discount"),
            F.avg("roi_percentage").alias("avg_roi"),
        )
        .orderBy(*[c(part).desc() for part in period], "promotion_status")
    )


def filter_promotions(
    details: DataFrame,
    status: str = ALL,
    types: Collection[str] = (),
    discount_from: float = 0,
    discount_to: float = 100,
    min_roi: float = 0,
) -> DataFrame:
    """Promotions matching the analyst's choices; unknown values never match a bound."""
    kept = details
    if status != ALL:
        kept = kept.where(c("promotion_status") == STATUS_CHOICES.get(status, status))
    if types:
        kept = kept.where(c("promotion_type").isin(*types))
    return kept.where(
        c("discount_percentage").between(discount_from, discount_to) & (c("roi_percentage") >= min_roi)
    )


def promo_filtered_stats(filtered: DataFrame) -> DataFrame:
    return filtered.agg(
        F.avg("roi_percentage").alias("avg_roi"),
        F.coalesce(F.sum("total_gross_revenue"), F.lit(0)).alias("total_revenue"),
        F.avg("discount_percentage").alias("avg_discount"),
    )


def _pick(df: DataFrame, aspect: str, key: str, order: list[Column], count: int, **shown: Column) -> DataFrame:
    """First ``count`` rows that have a mean ROI, as (aspect, position, name, avg_roi, shown measures)."""
    total_order = [*order, c(key)]
    picked = top_rows(df.where(c("avg_roi").isNotNull()), total_order, count)
    return picked.select(
        F.lit(aspect).alias("aspect"),
        F.row_number().over(Window.orderBy(*total_order)).alias("position"),
        c(key).alias("name"),
        "avg_roi",
        *[column.alias(name) for name, column in shown.items()],
    )


def promo_best(lake: Lakehouse) -> DataFrame:
    """Best type, region and category by mean ROI, and the five best regions."""
    best = [c("avg_roi").desc(), _by_revenue()]
    count, market = c("promotion_count"), c("avg_market_share")
    regions = promo_by_region(lake)
    return stack_ragged(
        [
            _pick(
                promo_by_type(lake), "best_type", "promotion_type", best, 1,
                promotion_count=count, avg_revenue_per_euro=c("avg_revenue_per_euro"),
            ),
            _pick(regions, "best_region", "region", best, 1, promotion_count=count, avg_market_share=market),
            _pick(
                promo_by_category(lake), "best_category", "product_category", best, 1,
                promotion_count=count, avg_discount_pct=c("avg_discount_pct"),
            ),
            _pick(regions, "top_region", "region", best, 5, promotion_count=count, avg_market_share=market),
        ]
    )


def promo_status_counts(lake: Lakehouse) -> DataFrame:
    status = c("promotion_status")
    return lake.gold("promotions_active").agg(
        *[F.count_if(status == value).alias(f"{label.lower()}_count") for label, value in STATUS_CHOICES.items()],
        F.min("start_date").alias("period_start"),
        F.max("end_date").alias("period_end"),
    )


def promotion_report(lake: Lakehouse) -> DataFrame:
    """Catalogue and the three rollups in one frame; columns a part lacks are NULL."""
    return stack_ragged(
        [promotion_details(lake), promo_by_type(lake), promo_by_region(lake), promo_by_category(lake)]
    )


# Campaigns


def _funded(lake: Lakehouse) -> DataFrame:
    return lake.gold("marketing_performance").where(c("campaign_budget") > 0)


def campaign_types(lake: Lakehouse) -> DataFrame:
    kinds = lake.gold("marketing_performance").select("campaign_type").where(c("campaign_type").isNotNull())
    return kinds.distinct().orderBy("campaign_type")


def _conversion() -> Column:
    return F.avg("actual_conversion_rate") * 100


def marketing_kpis(lake: Lakehouse) -> DataFrame:
    return _funded(lake).agg(
        F.count("*").alias("total_campaigns"),
        F.sum("campaign_budget").alias("total_budget"),
        F.sum("generated_revenue").alias("total_revenue"),
        F.avg("roi_percentage").alias("avg_roi"),
        _conversion().alias("avg_conversion_rate"),
        F.sum("unique_customers_acquired").alias("total_customers_acquired"),
        F.avg("cost_per_acquisition").alias("avg_cpa"),
        F.avg("revenue_per_euro_spent").alias("avg_revenue_per_euro"),
    )


def campaign_details(lake: Lakehouse) -> DataFrame:
    portfolio = _funded(lake).select(
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "product_category",
        "target_audience",
        "start_date",
        "end_date",
        "region",
        "campaign_duration_days",
        "campaign_budget",
        "estimated_reach",
        (c("target_conversion_rate") * 100).alias("target_conversion_pct"),
        "actual_sales",
        "generated_revenue",
        "unique_customers_acquired",
        "avg_transaction_value",
        "roi_percentage",
        "revenue_per_euro_spent",
        (c("actual_conversion_rate") * 100).alias("actual_conversion_pct"),
        "cost_per_acquisition",
        "cost_per_unique_customer",
        "avg_customer_lifetime_value",
        "performance_rating",
        "conversion_performance",
    )
    return portfolio.orderBy(
        c("start_date").desc_nulls_first(), c("roi_percentage").desc_nulls_first(), c("campaign_id")
    )


def _campaigns_by(lake: Lakehouse, key: str, **measures: Column) -> DataFrame:
    known = lake.gold("marketing_performance").where(c(key).isNotNull())
    common = {
        "campaign_count": F.count("*"),
        "total_budget": F.sum("campaign_budget"),
        "total_revenue": F.sum("generated_revenue"),
        "avg_roi": F.avg("roi_percentage"),
        "avg_conversion_rate": _conversion(),
    }
    return known.groupBy(key).agg(*[column.alias(name) for name, column in {**common, **measures}.items()])


def _by_roi() -> Column:
    return c("avg_roi").desc_nulls_first()


def campaign_by_type(lake: Lakehouse) -> DataFrame:
    return _campaigns_by(
        lake,
        "campaign_type",
        avg_revenue_per_euro=F.avg("revenue_per_euro_spent"),
        total_customers=F.sum("unique_customers_acquired"),
        avg_cpa=F.avg("cost_per_acquisition"),
    ).orderBy(_by_roi(), "campaign_type")


def campaign_budget_vs_revenue(lake: Lakehouse) -> DataFrame:
    """Type table behind the budget-against-revenue chart."""
    return campaign_by_type(lake).select("campaign_type", "total_budget", "total_revenue")


def campaign_by_region(lake: Lakehouse) -> DataFrame:
    return _campaigns_by(
        lake,
        "region",
        total_customers=F.sum("unique_customers_acquired"),
        avg_customer_cost=F.avg("cost_per_unique_customer"),
    ).orderBy(_by_roi(), "region")


def campaign_by_category(lake: Lakehouse) -> DataFrame:
    categories = _campaigns_by(
        lake, "product_category", total_sales=F.sum("actual_sales"), avg_ticket=F.avg("avg_transaction_value")
    )
    return top_rows(categories, [_by_roi(), c("product_category")], 15)


def campaign_category_chart(lake: Lakehouse) -> DataFrame:
    """Eight leading categories of the category table."""
    leading = top_rows(campaign_by_category(lake), [_by_roi(), c("product_category")], 8)
    return leading.select("product_category", "avg_roi")


def campaign_by_period(lake: Lakehouse) -> DataFrame:
    """Latest 12 months in which campaigns start."""
    period = ["start_year", "start_quarter", "start_month"]
    months = (
        lake.gold("marketing_performance")
        .where(c("start_year").isNotNull())
        .groupBy(*period)
        .agg(
            F.count("*").alias("campaign_count"),
            F.sum("campaign_budget").alias("total_budget"),
            F.sum("generated_revenue").alias("total_revenue"),
            F.avg("roi_percentage").alias("avg_roi"),
            F.sum("unique_customers_acquired").alias("total_customers"),
        )
    )
    return top_rows(months, [c(part).desc() for part in period], 12)


def filter_campaigns(
    details: DataFrame,
    rating: str = ALL,
    types: Collection[str] = (),
    year: int | None = None,
    min_roi: float = 0,
) -> DataFrame:
    """Campaigns matching the analyst's choices; ``year`` is the start year, None for all."""
    kept = details
    if rating != ALL:
        kept = kept.where(c("performance_rating") == RATING_CHOICES.get(rating, rating))
    if types:
        kept = kept.where(c("campaign_type").isin(*types))
    if year is not None:
        kept = kept.where(F.year("start_date") == year)
    return kept.where(c("roi_percentage") >= min_roi)


def campaign_filtered_stats(filtered: DataFrame) -> DataFrame:
    return filtered.agg(
        F.avg("roi_percentage").alias("avg_roi"),
        F.coalesce(F.sum("campaign_budget"), F.lit(0)).alias("total_budget"),
        F.avg("actual_conversion_pct").alias("avg_conversion"),
    )


def campaign_efficiency_counts(lake: Lakehouse) -> DataFrame:
    conversion = c("actual_conversion_rate") * 100
    return _funded(lake).agg(
        F.count_if((c("roi_percentage") > 100) & (conversion > 5)).alias("excellent_campaigns"),
        F.count_if(c("revenue_per_euro_spent") > 3).alias("efficient_campaigns"),
        F.count_if(c("cost_per_acquisition") < 50).alias("profitable_acquisitions"),
    )


def campaign_best_worst(lake: Lakehouse) -> DataFrame:
    """Best type, region and category with an advice to invest, worst type and region with one to review.

    A worst row is only shown among more than three; the advice is NULL where the mean ROI does not call for one.
    """
    best = [c("avg_roi").desc()]
    shown = {"avg_conversion_rate": c("avg_conversion_rate"), "campaign_count": c("campaign_count")}
    kinds, regions, categories = campaign_by_type(lake), campaign_by_region(lake), campaign_by_category(lake)

    def lowest(df: DataFrame, aspect: str, key: str) -> DataFrame:
        enough = df.withColumn("_groups", F.count("*").over(Window.partitionBy())).where(c("_groups") > 3)
        return _pick(enough, aspect, key, [c("avg_roi").asc()], 1, **shown)

    rows = stack(
        [
            _pick(kinds, "best_type", "campaign_type", best, 1, **shown),
            _pick(regions, "best_region", "region", best, 1, **shown),
            _pick(categories, "best_category", "product_category", best, 1, **shown),
            lowest(kinds, "worst_type", "campaign_type"),
            lowest(regions, "worst_region", "region"),
            _pick(regions, "top_region", "region", best, 5, **shown),
        ]
    )
    aspect, roi = c("aspect"), c("avg_roi")
    advice = F.when(aspect.startswith("best") & (roi > 150), "invest").when(
        aspect.startswith("worst") & (roi < 50), "review"
    )
    return rows.withColumn("advice", advice)


def campaign_rating_counts(lake: Lakehouse) -> DataFrame:
    rating = c("performance_rating")
    return _funded(lake).agg(
        *[F.count_if(rating == value).alias(f"{label.lower()}_count") for label, value in RATING_CHOICES.items()],
        F.min("start_date").alias("period_start"),
        F.max("end_date").alias("period_end"),
        F.sum("campaign_budget").alias("total_budget"),
    )


def marketing_report(lake: Lakehouse) -> DataFrame:
    """Portfolio and the three rollups in one frame; columns a part lacks are NULL."""
    return stack_ragged(
        [campaign_details(lake), campaign_by_type(lake), campaign_by_region(lake), campaign_by_category(lake)]
    )
