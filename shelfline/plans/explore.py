"""Exploration of Silver: profiles, sales analyses and cross-domain analyses."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import bands
from shelfline.functions.dialect import half_up, leading_word, lenient_id, mean, percent, ratio
from shelfline.operators.intervals import days_covered, interval_join, range_stats
from shelfline.operators.ordered import exact_median, rank_by, top_rows
from shelfline.operators.stacking import stack, summarise, unpivot_row
from shelfline.plans import cells
from shelfline.plans import silver as silver_plans
from shelfline.plans.export import review_scores, sales_analysis_export, sales_analysis_export_factors

if TYPE_CHECKING:
    from shelfline.lakehouse import Lakehouse

c = F.col
WIDE = "decimal(38,0)"

# Silver table, business domain, first date, last date, key.
PROFILES = (
    ("financial_transactions_clean", "Transactions financières", "transaction_date", "transaction_date", "transaction_id"),
    ("customer_demographics_clean", "Démographie clients", "date_of_birth", "date_of_birth", "customer_id"),
    ("promotions_clean", "Promotions commerciales", "start_date", "end_date", "promotion_id"),
    ("marketing_campaigns_clean", "Campagnes marketing", "start_date", "end_date", "campaign_id"),
    ("inventory_clean", "Gestion stocks", "last_restock_date", "last_restock_date", "product_id"),
    ("employee_records_clean", "Ressources humaines", "hire_date", "hire_date", "employee_id"),
    ("supplier_information_clean", "Gestion fournisseurs", None, None, "supplier_id"),
    ("logistics_and_shipping_clean", "Logistique", "ship_date", "estimated_delivery", "shipment_id"),
    ("customer_service_interactions_clean", "Service client", "interaction_date", "interaction_date", "interaction_id"),
    ("product_reviews_clean", "Avis clients", "review_date", "review_date", "reviewer_id"),
    ("store_locations_clean", "Points de vente", None, None, "store_id"),
)

# Measure name, Silver table, column.
MEASURES = (
    ("Montant transaction", "financial_transactions_clean", "amount"),
    ("Revenu annuel client", "customer_demographics_clean", "annual_income"),
    ("Salaire employé", "employee_records_clean", "salary"),
    ("Stock actuel", "inventory_clean", "current_stock"),
)

# Recommendation rows (priority, text, impact, effort, department).
RECOMMENDATIONS = (
    (1, "Augmenter le stock des produits avec avis >4.5 et stock bas", "Augmentation CA de 15-20%", "Faible", "Logistique"),
    (2, "Cibler les campagnes sur les régions à fort panier moyen", "+10% ROI marketing", "Moyenne", "Marketing"),
    (3, "Améliorer le taux de résolution des tickets service client", "+20% satisfaction client", "Moyenne", "Service Client"),
    (4, "Négocier les délais avec les fournisseurs fiables mais lents", "-30% ruptures stock", "Élevée", "Achats"),
    (5, "Créer promotions ciblées pour clients revenu élevé", "+25% fidélisation", "Faible", "Marketing"),
)


def _transactions(lake: Lakehouse) -> DataFrame:
    return lake.silver("financial_transactions_clean")


def _sold(lake: Lakehouse) -> DataFrame:
    return _transactions(lake).where(c("transaction_type") == "Sale")


def catalog_overview(lake: Lakehouse) -> DataFrame:
    """Columns, nullable columns and numeric columns of each Silver table, from the schemas alone."""
    rows = []
    for table in silver_plans.TABLES:
        fields = lake.silver(table).schema.fields
        numeric = [f for f in fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "decimal", "float", "double")]
        rows.append((table, len(fields), sum(f.nullable for f in fields), len(numeric)))
    names = "table_name string, column_count long, nullable_columns long, numeric_columns long"
    return lake.spark.createDataFrame(rows, names).orderBy("table_name")


def table_profile(lake: Lakehouse) -> DataFrame:
    """Volume, date span and key uniqueness of the Silver tables."""
    parts = []
    for table, domain, first, last, key in PROFILES:
        no_date = F.lit(None).cast("date")
        parts.append(
            summarise(
                lake.silver(table),
                {"table_name": table, "business_domain": domain, "primary_key": key},
                record_count=F.count("*"),
                min_date=F.min(first) if first else no_date,
                max_date=F.max(last) if last else no_date,
                distinct_keys=F.count_distinct(key),
            )
        )
    unique = c("record_count") == c("distinct_keys")
    return (
        stack(parts)
        .withColumn("data_quality", F.when(unique, "OK").otherwise("DOUBLONS POTENTIELS"))
        .orderBy(c("record_count").desc(), "table_name")
    )


def missing_values(lake: Lakehouse) -> DataFrame:
    checked = (
        ("financial_transactions_clean", "amount", "transaction_date", "region"),
        ("customer_demographics_clean", "annual_income", "date_of_birth", "region"),
        ("customer_service_interactions_clean", "customer_satisfaction", "interaction_date", "duration_minutes"),
    )
    parts = [
        summarise(
            lake.silver(table),
            {"table_name": table},
            total_records=F.count("*"),
            missing_amount=F.count_if(c(value).isNull()),
            missing_date=F.count_if(c(date).isNull()),
            missing_region=F.count_if(c(third).isNull()),
        )
        for table, value, date, third in checked
    ]
    return stack(parts).withColumn("pct_missing_amount", percent(c("missing_amount"), c("total_records")))


def numeric_distribution(lake: Lakehouse) -> DataFrame:
    """Minimum, maximum, mean, median, deviation and dispersion class of four measures."""
    parts = []
    for name, table, column in MEASURES:
        df = lake.silver(table)
        spread = summarise(
            df,
            {"metric": name},
            min_value=F.min(column),
            max_value=F.max(column),
            avg_value=mean(c(column)),
            std_dev=F.stddev_samp(c(column).cast("double")),
            sample_size=F.count("*"),
        ).withColumn("median_value", exact_median(df, column).scalar())
        parts.append(spread.withColumns({n: c(n).cast("double") for n in ("min_value", "max_value")}))
    deviation, average = c("std_dev"), c("avg_value")
    return stack(parts).withColumn(
        "variability_assessment",
        F.when(deviation > average, "FORTE DISPERSION")
        .when(deviation > average * 0.5, "DISPERSION MODÉRÉE")
        .otherwise("FAIBLE DISPERSION"),
    )


def monthly_sales(lake: Lakehouse) -> DataFrame:
    month = {"month": F.trunc("transaction_date", "month")}
    from_cells = cells.summary(
        lake, month, "Sale", "unique_entities",
        transaction_count=F.sum("sales"), total_revenue=cells.total_amount(), avg_transaction_value=cells.mean_amount(),
    )
    if from_cells is not None:
        return from_cells.orderBy("month")
    return (
        _sold(lake)
        .groupBy(F.trunc("transaction_date", "month").alias("month"))
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").alias("total_revenue"),
            mean(c("amount")).alias("avg_transaction_value"),
            F.count_distinct("entity").alias("unique_entities"),
        )
        .orderBy("month")
    )


def quarterly_growth(lake: Lakehouse) -> DataFrame:
    quarters = (
        _sold(lake)
        .groupBy(F.trunc("transaction_date", "quarter").alias("quarter"))
        .agg(F.sum("amount").alias("total_revenue"), F.count("*").alias("transaction_count"))
    )
    previous = F.lag("total_revenue").over(Window.orderBy("quarter"))
    change = c("total_revenue") - c("previous_quarter_revenue")
    return (
        quarters.withColumn("avg_ticket", ratio(c("total_revenue"), c("transaction_count")))
        .withColumn("previous_quarter_revenue", previous)
        .withColumn("growth_rate_pct", percent(change, c("previous_quarter_revenue")))
        .orderBy("quarter")
    )


def region_performance(lake: Lakehouse) -> DataFrame:
    regions = cells.summary(
        lake, {"region": c("region")}, "Sale", "unique_entities",
        transaction_count=F.sum("sales"), total_revenue=cells.total_amount(), avg_transaction_value=cells.mean_amount(),
    )
    if regions is None:
        regions = (
            _sold(lake)
            .groupBy("region")
            .agg(
                F.count("*").alias("transaction_count"),
                F.sum("amount").alias("total_revenue"),
                mean(c("amount")).alias("avg_transaction_value"),
                F.count_distinct("entity").alias("unique_entities"),
            )
        )
    everything = F.sum("total_revenue").over(Window.partitionBy())
    return regions.withColumn("revenue_share_pct", percent(c("total_revenue"), everything)).orderBy(
        c("total_revenue").desc_nulls_first(), "region"
    )


def top_entities(lake: Lakehouse) -> DataFrame:
    entities = (
        _sold(lake)
        .groupBy("entity", "region")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("amount").alias("total_revenue"),
            mean(c("amount")).alias("avg_transaction_value"),
            F.max("amount").alias("max_transaction"),
            F.min("amount").alias("min_transaction"),
        )
    )
    return top_rows(entities, [c("total_revenue").desc_nulls_first(), c("entity"), c("region")], 10)


def customer_segments(lake: Lakehouse) -> DataFrame:
    return (
        lake.silver("customer_demographics_clean")
        .groupBy(bands.AGE_GROUP.name(c("age")).alias("age_group"), "gender", "marital_status", "region")
        .agg(
            F.count("*").alias("customer_count"),
            mean(c("annual_income")).alias("avg_income"),
            F.min("annual_income").alias("min_income"),
            F.max("annual_income").alias("max_income"),
        )
        .orderBy("age_group", "gender", c("customer_count").desc(), "marital_status", "region")
    )


def basket_by_income(lake: Lakehouse) -> DataFrame:
    """Revenue per customer by income segment and region; sales are summed per entity before they meet customers."""
    spending = (
        _sold(lake)
        .select(lenient_id(c("entity")).alias("customer_id"), "amount")
        .where(c("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("amount").alias("sales"), F.sum("amount").alias("spent"))
    )
    customers = lake.silver("customer_demographics_clean").where(c("annual_income").isNotNull())
    revenue = F.sum(c("spent").cast(WIDE))
    buyers = F.count_distinct("customer_id")
    return (
        customers.join(spending, "customer_id")
        .groupBy(bands.INCOME_FR.name(c("annual_income")).alias("income_segment"), "region")
        .agg(
            buyers.alias("unique_customers"),
            F.sum("sales").alias("transaction_count"),
            revenue.alias("total_revenue"),
            ratio(revenue, F.sum("sales")).alias("avg_transaction_value"),
            ratio(revenue, buyers).alias("revenue_per_customer"),
        )
        .orderBy(c("revenue_per_customer").desc_nulls_first(), "income_segment", "region")
    )


def _daily_sold(lake: Lakehouse, *keys: str) -> DataFrame:
    """Sales per day (and keys): one row per calendar cell however many sales."""
    return (
        _sold(lake)
        .groupBy(*keys, "transaction_date")
        .agg(
            F.count("*").alias("sales"),
            F.count("transaction_id").alias("named_sales"),
            F.sum("amount").alias("amount"),
        )
    )


def promo_vs_no_promo(lake: Lakehouse) -> DataFrame:
    """Sales dated inside the promotions valid today, per category, against sales on days none of them covers."""
    current = lake.silver("promotions_clean").where(lake.today.between(c("start_date"), c("end_date")))
    span = ["start_date", "end_date"]
    daily = _daily_sold(lake)
    per_range = range_stats(
        current, daily, [F.sum("sales").alias("sales"), F.sum("amount").alias("amount")], day="transaction_date"
    )
    counted, revenue = F.sum("sales"), F.sum(c("amount").cast(WIDE))
    measures = [
        counted.alias("transaction_count"),
        revenue.alias("total_revenue"),
        ratio(revenue, counted).alias("avg_transaction_value"),
    ]
    inside = (
        current.join(per_range, span)
        .groupBy("product_category")
        .agg(*measures)
        .withColumn("promotion_status", F.lit("Avec promotion"))
    )
    outside = (
        interval_join(daily, current.select(*span).distinct(), point="transaction_date", how="left_anti")
        .agg(*measures)
        .fillna(0, subset=["transaction_count"])
        .withColumns({"product_category": F.lit("Toutes catégories"), "promotion_status": F.lit("Sans promotion")})
    )
    columns = ["product_category", "promotion_status", "transaction_count", "total_revenue", "avg_transaction_value"]
    return stack([inside.select(*columns), outside.select(*columns)]).orderBy("product_category", "promotion_status")


def _by_leading_word(lake: Lakehouse, *keys: str) -> DataFrame:
    return (
        _sold(lake)
        .groupBy(leading_word(c("entity")).alias("inferred_category"), *keys)
        .agg(
            F.count("*").alias("sales"),
            F.count("transaction_id").alias("named_sales"),
            F.sum("amount").alias("amount"),
            mean(c("amount")).alias("avg_amount"),
        )
    )


def promo_sensitivity(lake: Lakehouse) -> DataFrame:
    """Sales during promotions by category and discount, against the category's usual sale."""
    promotions = lake.silver("promotions_clean")
    per_range = range_stats(
        promotions,
        _daily_sold(lake),
        [
            F.sum("named_sales").alias("named_sales"),
            F.sum("sales").alias("sales"),
            F.sum("amount").alias("amount"),
        ],
        day="transaction_date",
    )
    revenue = F.sum(c("amount").cast(WIDE))
    during = (
        promotions.join(per_range, ["start_date", "end_date"], "left")
        .groupBy("product_category", "discount_percentage")
        .agg(
            F.count_distinct("promotion_id").alias("promotion_count"),
            F.coalesce(F.sum("named_sales"), F.lit(0)).alias("sales_during_promotion"),
            revenue.alias("revenue_during_promotion"),
            ratio(revenue, F.sum("sales")).alias("avg_sale_during_promotion"),
        )
    )
    baseline = _by_leading_word(lake).select(
        "inferred_category", c("sales").alias("total_sales"), c("avg_amount").alias("avg_sale_baseline")
    )
    usual = c("avg_sale_baseline")
    return (
        during.join(baseline, c("product_category") == c("inferred_category"), "left")
        .drop("inferred_category")
        .withColumn("lift_percentage", percent(c("avg_sale_during_promotion") - usual, usual))
        .orderBy(c("lift_percentage").desc_nulls_first(), "product_category", "discount_percentage")
    )


def _campaigns_with_sales(lake: Lakehouse) -> DataFrame:
    """Campaigns with the sales of their region during their run."""
    campaigns = lake.silver("marketing_campaigns_clean")
    per_range = range_stats(
        campaigns,
        _daily_sold(lake, "region"),
        [F.sum("named_sales").alias("named_sales"), F.sum("amount").alias("amount")],
        day="transaction_date",
        on=["region"],
    )
    return campaigns.join(per_range, ["region", "start_date", "end_date"], "left")


def campaign_sales_link(lake: Lakehouse) -> DataFrame:
    keys = ["campaign_name", "campaign_type", "start_date", "end_date", "budget", "reach", "conversion_rate"]
    revenue = c("campaign_revenue")
    return (
        _campaigns_with_sales(lake)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("named_sales"), F.lit(0)).alias("resulting_sales"),
            F.sum(c("amount").cast(WIDE)).alias("campaign_revenue"),
        )
        .withColumns(
            {
                "roi_percentage": percent(c("budget"), revenue),
                "revenue_per_budget_unit": half_up(ratio(revenue, c("budget")), 2),
            }
        )
        .orderBy(c("roi_percentage").desc_nulls_first(), *keys)
    )


def campaign_ranking(lake: Lakehouse) -> DataFrame:
    """Campaigns with a budget by revenue per euro, rated and ranked."""
    keys = ["campaign_id", "campaign_name", "campaign_type", "region", "budget", "conversion_rate"]
    metrics = (
        _campaigns_with_sales(lake)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("named_sales"), F.lit(0)).alias("sales_count"),
            F.sum(c("amount").cast(WIDE)).alias("generated_revenue"),
        )
        .where(c("budget") > 0)
        .withColumn("revenue_per_euro", half_up(ratio(c("generated_revenue"), c("budget")), 2))
        .withColumn("efficiency_rating", bands.REVENUE_PER_EURO.name(c("revenue_per_euro")))
    )
    return (
        rank_by(metrics, "revenue_per_euro", "efficiency_rank").drop("campaign_id").orderBy("efficiency_rank", "campaign_name")
    )


def review_impact(lake: Lakehouse) -> DataFrame:
    reviews = (
        lake.silver("product_reviews_clean")
        .groupBy("product_category", "sentiment")
        .agg(mean(c("rating")).alias("avg_rating"), F.count("reviewer_id").alias("review_count"))
        .where(c("review_count") > 10)
    )
    sold = _by_leading_word(lake).select(
        "inferred_category",
        c("sales").alias("sales_count"),
        c("amount").alias("sales_revenue"),
        c("avg_amount").alias("avg_sale_value"),
    )
    return (
        reviews.join(sold, c("product_category") == c("inferred_category"), "left")
        .drop("inferred_category")
        .withColumn("revenue_per_review", half_up(ratio(c("sales_revenue"), c("review_count")), 2))
        .orderBy(c("revenue_per_review").desc_nulls_first(), "product_category", "sentiment")
    )


def service_influence(lake: Lakehouse) -> DataFrame:
    """Interactions by resolution and satisfaction with the income of the customers behind them.

    Interactions are summed per customer, and customers per id, before the two meet; a customer id that occurs
    several times repeats the interaction as the row-by-row join would.
    """
    keys = ["resolution_status", "satisfaction_category"]
    interactions = lake.silver("customer_service_interactions_clean")
    per_customer = interactions.groupBy(*keys, "customer_id").agg(
        F.count("*").alias("calls"),
        F.sum("duration_minutes").alias("minutes"),
        F.count("duration_minutes").alias("timed"),
        F.count_if(c("follow_up_required") == "Yes").alias("follow_ups"),
    )
    incomes = lake.silver("customer_demographics_clean").groupBy("customer_id").agg(
        F.count("*").alias("entries"),
        F.sum("annual_income").alias("income"),
        F.count("annual_income").alias("incomes"),
    )
    repeats = F.coalesce("entries", F.lit(1))
    summed = (
        per_customer.join(incomes, "customer_id", "left")
        .groupBy(*keys)
        .agg(
            F.sum(c("calls") * repeats).alias("interaction_count"),
            ratio(F.sum(c("minutes") * repeats), F.sum(c("timed") * repeats)).alias("avg_duration"),
            F.sum(c("follow_ups") * repeats).alias("follow_up_count"),
            half_up(ratio(F.sum(c("calls") * c("income").cast(WIDE)), F.sum(c("calls") * c("incomes"))), 2).alias(
                "avg_customer_income"
            ),
        )
    )
    unique = interactions.groupBy(*keys).agg(F.count_distinct("interaction_id").alias("unique_interactions"))
    other = unique.select(*[c(key).alias(f"_{key}") for key in keys], "unique_interactions")
    same = summed[keys[0]].eqNullSafe(other[f"_{keys[0]}"]) & summed[keys[1]].eqNullSafe(other[f"_{keys[1]}"])
    return (
        summed.join(other, same)
        .drop(*[f"_{key}" for key in keys])
        .orderBy(c("interaction_count").desc(), *[c(key).asc_nulls_last() for key in keys])
    )


def stockouts(lake: Lakehouse) -> DataFrame:
    keys = ["product_category", "region", "country", "warehouse"]
    stock = c("current_stock")
    return (
        lake.silver("inventory_clean")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("product_count"),
            F.count_if(stock <= c("reorder_point")).alias("critical_stock_items"),
            F.count_if(stock == 0).alias("out_of_stock_items"),
            half_up(mean(c("days_since_restock")), 1).alias("avg_days_since_restock"),
            half_up(mean(c("lead_time")), 1).alias("avg_lead_time"),
        )
        .where(c("critical_stock_items") > 0)
        .orderBy(c("critical_stock_items").desc(), *keys)
    )


def delivery_satisfaction(lake: Lakehouse) -> DataFrame:
    """Promised delivery time against satisfaction, over orders with a delivery complaint.

    Shipments and interactions are summed per order first; an order with many of both costs one row on each side.
    """
    keys = ["shipping_method", "carrier", "delivery_status"]
    shipments = (
        lake.silver("logistics_and_shipping_clean")
        .groupBy("order_id", *keys)
        .agg(F.count("*").alias("shipments"), F.sum("estimated_delivery_days").alias("days"))
    )
    complaints = (
        lake.silver("customer_service_interactions_clean")
        .where(c("issue_category").like("%DELIVERY%"))
        .groupBy("order_id")
        .agg(
            F.count("*").alias("calls"),
            F.sum("customer_satisfaction").alias("score"),
            F.count("customer_satisfaction").alias("scored"),
            F.count_if(c("satisfaction_category") == "Très satisfait").alias("delighted"),
        )
    )
    pairs = F.sum(c("shipments") * c("calls"))
    return (
        shipments.join(complaints, "order_id")
        .groupBy(*keys)
        .agg(
            ratio(F.sum(c("days") * c("calls")), pairs).alias("avg_delivery_days"),
            ratio(F.sum(c("shipments") * c("score")), F.sum(c("shipments") * c("scored"))).alias("avg_satisfaction_score"),
            pairs.alias("shipment_count"),
            ratio(F.sum(c("shipments") * c("delighted")) * 100, pairs).alias("high_satisfaction_pct"),
        )
        .orderBy(c("avg_satisfaction_score").desc_nulls_first(), *keys)
    )


def stock_sales_satisfaction(lake: Lakehouse) -> DataFrame:
    """Stock against sales and ratings by category, region and stock level.

    Joined row by row, each inventory row of a group would repeat for every sale and review of its category. All rows
    of a group repeat equally, so the totals are the group's own times the sums of the other two sides.
    """
    keys = ["product_category", "region", "stock_level"]
    stock = lake.silver("inventory_clean").groupBy(*keys).agg(
        F.count("*").alias("items"),
        F.count_distinct("product_id").alias("product_count"),
        mean(c("current_stock")).alias("avg_stock_level"),
    )
    sold = _by_leading_word(lake, "region").select(
        c("inferred_category").alias("product_category"), "region", "named_sales", "amount"
    )
    reviews = (
        lake.silver("product_reviews_clean")
        .groupBy("product_category")
        .agg(F.count("*").alias("reviews"), mean(c("rating")).alias("avg_product_rating"))
    )
    repeats = c("items") * F.greatest(F.lit(1), F.coalesce("reviews", F.lit(0)))
    level, rating, total = c("stock_level"), c("avg_product_rating"), c("total_sales")
    # The insights.
    insight = (
        F.when((level == "Critique") & (rating > 4), "ALERTE: Bon produit mais stock critique")
        .when((level == "Élevé") & total.isNull(), "ALERTE: Surstock produit non vendu")
        .when(level.isin("Normal", "Bas") & (rating > 4.5), "OPPORTUNITÉ: Augmenter stock produit populaire")
        .otherwise("Situation normale")
    )
    return (
        stock.join(sold, ["product_category", "region"], "left")
        .join(reviews, "product_category", "left")
        .withColumns(
            {
                "total_sales": c("amount").cast(WIDE) * repeats,
                "sales_count": F.coalesce(c("named_sales") * repeats, F.lit(0)),
            }
        )
        .withColumns(
            {
                "sales_per_product": half_up(ratio(total, c("product_count")), 2),
                "business_insight": insight,
            }
        )
        .select(
            *keys,
            "product_count",
            "avg_stock_level",
            "total_sales",
            "sales_count",
            "avg_product_rating",
            "sales_per_product",
            "business_insight",
        )
        .orderBy(total.desc_nulls_last(), *keys)
    )


def business_dashboard(lake: Lakehouse) -> DataFrame:
    """Nine KPIs with unit and traffic light, one aggregate per source table."""
    sold = c("transaction_type") == "Sale"
    daily = _transactions(lake).groupBy("region", "transaction_date").agg(
        F.sum("amount").alias("amount"),
        F.sum(F.when(sold, c("amount"))).alias("sold_amount"),
        F.count_if(sold).alias("sold_count"),
    )
    volume = daily.agg(
        F.sum("sold_amount").alias("revenue"),
        F.coalesce(F.sum("sold_count"), F.lit(0)).alias("count"),
        ratio(F.sum("sold_amount"), F.sum("sold_count")).alias("ticket"),
    )
    campaigns = lake.silver("marketing_campaigns_clean")
    per_range = range_stats(
        campaigns, daily, [F.sum("amount").alias("amount")], day="transaction_date", on=["region"]
    )
    returns = (
        campaigns.select("campaign_id", "budget", "region", "start_date", "end_date")
        .join(per_range, ["region", "start_date", "end_date"], "left")
        .groupBy("campaign_id", "budget")
        .agg(F.sum(c("amount").cast(WIDE)).alias("revenue"))
        .agg((F.avg(F.when(c("budget") > 0, ratio(c("revenue"), c("budget")))) * 100).alias("roi"))
    )
    # The names of the indicators.
    sources = [
        (volume, {"revenue": "CA Total", "count": "Nombre transactions", "ticket": "Panier moyen"}),
        (_sold(lake).agg(F.count_distinct("entity").alias("buyers")), {"buyers": "Clients uniques"}),
        (campaigns.agg((F.avg("conversion_rate") * 100).alias("rate")), {"rate": "Taux conversion moyen"}),
        (
            lake.silver("customer_service_interactions_clean").agg(mean(c("customer_satisfaction")).alias("score")),
            {"score": "Satisfaction client"},
        ),
        (
            lake.silver("inventory_clean").agg(F.count_if(c("stock_level") == "Critique").alias("low")),
            {"low": "Produits stock critique"},
        ),
        (
            lake.silver("logistics_and_shipping_clean").agg(F.count_if(c("delivery_status") == "En retard").alias("late")),
            {"late": "Livraisons en retard"},
        ),
        (returns, {"roi": "ROI marketing moyen"}),
    ]
    kpis = stack([unpivot_row(row, "metric", "value", names) for row, names in sources])
    metric = c("metric")
    unit = (
        F.when(metric.like("%moyen%"), "€")
        .when(metric.like("%taux%") | metric.like("%satisfaction%") | metric.like("%ROI%"), "%")
        .otherwise("unité")
    )
    return kpis.select(
        metric, half_up(c("value"), 2).alias("value"), unit.alias("unit"), bands.kpi_light(metric, c("value")).alias("status")
    )


def recommendations(lake: Lakehouse) -> DataFrame:
    """Fixed recommendations, highest priority number first."""
    names = "priority int, recommendation string, business_impact string, estimated_effort string, responsible_department string"
    rows = lake.spark.createDataFrame(RECOMMENDATIONS, names)
    rank = F.rank().over(Window.orderBy(c("priority").desc()))
    return rows.withColumn("recommendation_rank", rank).drop("priority").orderBy("recommendation_rank")


def monthly_report(lake: Lakehouse) -> DataFrame:
    """Month by region; a transaction id occurs once in Silver, so refunds need no second distinct count."""
    refund = c("transaction_type") == "REFUND"
    from_cells = cells.summary(
        lake, {"report_month": F.trunc("transaction_date", "month"), "region": c("region")}, None, "active_customers",
        total_transactions=F.sum("sales"), monthly_revenue=cells.total_amount(), avg_ticket=cells.mean_amount(),
        max_transaction=F.max("largest"), refund_count=F.coalesce(F.sum(F.when(refund, c("named_sales"))), F.lit(0)),
        total_refunds=cells.total_amount(F.when(refund, c("amount")).otherwise(0)),
    )
    if from_cells is not None:
        first = ["report_month", "region", "active_customers"]
        return from_cells.select(*first, *(name for name in from_cells.columns if name not in first))
    return (
        _transactions(lake)
        .groupBy(F.trunc("transaction_date", "month").alias("report_month"), "region")
        .agg(
            F.count_distinct("entity").alias("active_customers"),
            F.count("*").alias("total_transactions"),
            F.sum("amount").alias("monthly_revenue"),
            mean(c("amount")).alias("avg_ticket"),
            F.max("amount").alias("max_transaction"),
            F.count(F.when(refund, c("transaction_id"))).alias("refund_count"),
            F.sum(F.when(refund, c("amount")).otherwise(0)).alias("total_refunds"),
        )
    )


def sales_analysis_export_profile(lake: Lakehouse) -> DataFrame:
    """Rows and amount of the whole export view by month and region, without writing the view out.

    Each sale's matches are counted side by side and multiplied.
    """
    sale = (
        _sold(lake)
        .select("transaction_date", "region", "amount", lenient_id(c("entity")).alias("_id"))
        .groupBy("_id", "region", "transaction_date")
        .agg(F.count("*").alias("sales"), F.sum("amount").alias("amount"))
    )

    def counted(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.where(c(key).isNotNull()).groupBy(c(key).alias("_id")).agg(F.count("*").alias(name))

    per_id = [
        counted(lake.silver("customer_demographics_clean"), "customer_id", "customers"),
        counted(lake.silver("logistics_and_shipping_clean"), "order_id", "shipments"),
        counted(lake.silver("customer_service_interactions_clean"), "customer_id", "interactions"),
    ]
    for side in per_id:
        sale = sale.join(side, "_id", "left")
    repeats = F.lit(1).cast(WIDE)
    for name in ("customers", "shipments", "interactions"):
        repeats = repeats * F.greatest(F.lit(1), F.coalesce(name, F.lit(0)))
    cells = (
        sale.withColumn("_repeats", repeats)
        .groupBy("region", "transaction_date")
        .agg(F.sum(c("sales") * c("_repeats")).alias("rows"), F.sum(c("amount") * c("_repeats")).alias("amount"))
    )

    span = ["start_date", "end_date"]
    campaigns = lake.silver("marketing_campaigns_clean").groupBy("region", *span).agg(F.count("*").alias("campaigns"))
    campaigns = days_covered(campaigns, day="transaction_date").groupBy("region", "transaction_date").agg(
        F.sum("campaigns").alias("campaigns")
    )
    promotions = lake.silver("promotions_clean").groupBy(*span).agg(F.count("*").alias("promotions"))
    promotions = days_covered(promotions, day="transaction_date").groupBy("transaction_date").agg(
        F.sum("promotions").alias("promotions")
    )
    scores = review_scores(lake).groupBy("product_category").agg(F.count("*").alias("scores"))
    stock = (
        lake.silver("inventory_clean")
        .groupBy("region", "product_category")
        .agg(F.count("*").alias("items"))
        .join(scores, "product_category", "left")
        .groupBy("region")
        .agg(F.sum(c("items") * F.coalesce("scores", F.lit(1))).alias("stock"))
    )
    together = cells.join(campaigns, ["region", "transaction_date"], "left").join(promotions, "transaction_date", "left")
    together = together.join(stock, "region", "left")
    factor = F.lit(1).cast(WIDE)
    for name in ("campaigns", "promotions", "stock"):
        factor = factor * F.coalesce(name, F.lit(1))
    return (
        together.withColumn("_factor", factor)
        .groupBy(F.trunc("transaction_date", "month").alias("month"), "region")
        .agg(
            F.sum(c("rows") * c("_factor")).alias("export_rows"),
            F.sum(c("amount") * c("_factor")).alias("export_amount"),
        )
    )
