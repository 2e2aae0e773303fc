"""Gold and cross-domain results on small hand-made tables, against row-by-row joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline import Lakehouse
from shelfline.plans import explore, gold, quality, registry
from shelfline.plans.build import VIEW_COMMENTS, VIEWS, build
from shelfline.sources.tables import write_report

TODAY = dt.date(2020, 3, 1)
RANDOM = random.Random(11)


def some_day(span=60):
    return dt.date(2020, 1, 1) + dt.timedelta(RANDOM.randrange(span))


@pytest.fixture(scope="module")
def lake(spark):
    """Overlapping promotions and campaigns, ids with several ranges, NULL regions, a hot day and repeated customers."""
    regions = ["N", "S", None]
    sales = [
        (f"T{i}", some_day(), RANDOM.choice(["Sale", "Sale", "REFUND"]), str(RANDOM.randrange(1, 4000)), "Cash",
         RANDOM.choice(["1", "2", "3", "4", "PROMO shop", "LARGE 9"]), RANDOM.choice(regions), "AC")
        for i in range(150)
    ] + [(f"H{i}", dt.date(2020, 1, 20), "Sale", "10", "Cash", "2", "N", "AC") for i in range(60)]
    sales += [(None, some_day(), "Sale", "5", "Cash", "1", "N", "AC")]
    promotions = []
    for i in range(25):
        start = some_day()
        promotions.append(
            (f"P{i % 18}", RANDOM.choice(["PROMO", "LARGE"]), "Bundle", float(RANDOM.randrange(0, 60)), start,
             start + dt.timedelta(RANDOM.randrange(0, 30)), RANDOM.choice(regions))
        )
    campaigns = []
    for i in range(20):
        start = some_day()
        campaigns.append(
            (f"C{i % 15}", f"name {i}", "TV", "PROMO", "Adults", start, start + dt.timedelta(RANDOM.randrange(0, 30)),
             RANDOM.choice(regions), RANDOM.randrange(0, 900), RANDOM.randrange(0, 50), 0.05)
        )
    customers = [
        (k, f"cust {k}", dt.date(1990, 1, 1), "F", "N", "X", "Y", "Single", income)
        for k, income in ((1, 20000), (2, 70000), (2, 80000), (5, 1000))
    ]
    calls = [
        (f"I{i}", some_day(), "call", "DELIVERY DELAY", "d", 5, "Closed", "Yes", RANDOM.randrange(1, 6),
         RANDOM.randrange(1, 4), RANDOM.randrange(1, 4))
        for i in range(8)
    ]
    shipments = [
        (f"S{i}", RANDOM.randrange(1, 5), some_day(), dt.date(2020, 4, 1), "Express", "ok", "5", "", "", "c")
        for i in range(7)
    ]
    reviews = [(f"R{i},Ann,{1 + i % 5},2020-01-0{1 + i % 9},{'PROMO' if i % 2 else 'OTHER'}",) for i in range(9)]
    from shelfline.sources import schemas

    def frame(name, rows):
        return spark.createDataFrame(rows, schemas.CSV_SCHEMAS[name]).cache()

    documents = spark.createDataFrame(
        [('[{"product_id":"A","product_category":"PROMO","region":"N","current_stock":5,"reorder_point":9},'
          '{"product_id":"B","product_category":"OTHER","region":"N","current_stock":50,"reorder_point":9}]',),
         ('[{"product_id":"C","product_category":"PROMO","region":"S","current_stock":12,"reorder_point":9}]',)],
        "t string",
    ).select(F.parse_json("t").alias("raw_data"))
    return Lakehouse.from_frames(
        spark,
        TODAY,
        financial_transactions=frame("financial_transactions", sales),
        promotions_data=frame("promotions_data", promotions),
        marketing_campaigns=frame("marketing_campaigns", campaigns),
        customer_demographics=frame("customer_demographics", customers),
        customer_service_interactions=frame("customer_service_interactions", calls),
        logistics_and_shipping=frame("logistics_and_shipping", shipments),
        supplier_information=frame("supplier_information", []),
        employee_records=frame("employee_records", []),
        product_reviews=spark.createDataFrame(reviews, "raw_line string"),
        inventory_staging=documents,
        store_locations_staging=documents,
    )


def views(lake):
    for name in (
        "financial_transactions_clean", "promotions_clean", "marketing_campaigns_clean", "customer_demographics_clean",
        "logistics_and_shipping_clean", "customer_service_interactions_clean", "inventory_clean", "product_reviews_clean",
    ):
        lake.silver(name).createOrReplaceTempView(name)
    lake.gold("sales_enriched").createOrReplaceTempView("fact")


def rows(df):
    return sorted(map(repr, (tuple(row) for row in df.collect())))


def test_fact_repeats_a_sale_for_each_promotion_and_campaign(lake, spark):
    views(lake)
    want = spark.sql("""
        SELECT f.transaction_id, f.transaction_date, p.promotion_id, m.campaign_id, p.start_date, m.campaign_name
        FROM financial_transactions_clean f
        LEFT JOIN promotions_clean p ON f.region = p.region AND f.transaction_date BETWEEN p.start_date AND p.end_date
        LEFT JOIN marketing_campaigns_clean m ON f.region = m.region AND f.transaction_date BETWEEN m.start_date AND m.end_date
        WHERE f.transaction_type = 'Sale'""")
    got = lake.gold("sales_enriched").select(
        "sale_id", "sale_date", "promotion_id", "campaign_id", "promo_start_date", "campaign_name"
    )
    assert rows(got) == rows(want)


def shuffled_records(plan):
    """Rows written by the shuffles of an executed plan."""
    name = plan.getClass().getSimpleName()
    inner = {"AdaptiveSparkPlanExec": "executedPlan", "ShuffleQueryStageExec": "plan", "BroadcastQueryStageExec": "plan"}
    if name in inner:
        return shuffled_records(getattr(plan, inner[name])())
    children = plan.children()
    below = sum(shuffled_records(children.apply(i)) for i in range(children.size()))
    return below + (plan.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0)


def test_fact_shuffles_no_combinations_and_spreads_its_rows(spark):
    from shelfline.sources import schemas

    days = [dt.date(2020, 1, d) for d in range(1, 21)]
    tables = {
        "financial_transactions": [(f"T{i}", days[i % 20], "Sale", "7", "Cash", "1", "N", "AC") for i in range(40)],
        "promotions_data": [(f"P{i}", "PROMO", "Bundle", 5.0, days[0], days[19], "N") for i in range(15)],
        "marketing_campaigns": [
            (f"C{i}", "name", "TV", "PROMO", "Adults", days[0], days[19], "N", 9, 9, 0.05) for i in range(15)
        ],
    }
    frames = {name: spark.createDataFrame(rows, schemas.CSV_SCHEMAS[name]) for name, rows in tables.items()}
    fact = gold.sales_enriched(Lakehouse.from_frames(spark, TODAY, **frames))
    got = fact.select("sale_id", "promotion_id", "campaign_id", F.spark_partition_id().alias("task"))
    found = got.collect()
    assert len(found) == len({row[:3] for row in found}) == 40 * 15 * 15
    # 300 days of promotions, 300 of campaigns and the sales; combinations of a day's promotions and campaigns are 4,500.
    assert shuffled_records(got._jdf.queryExecution().executedPlan()) < 1500
    assert len({row.task for row in found}) > 3


def test_day_summary_equals_aggregating_the_fact(lake, spark):
    views(lake)
    want = spark.sql("""
        SELECT sale_date, sale_region, COUNT(*) n, CAST(SUM(sale_amount) AS BIGINT) revenue,
          COUNT(DISTINCT promotion_id) promos, SUM(has_promotion) with_promo, COUNT(DISTINCT campaign_id) campaigns,
          SUM(has_campaign) with_campaign, ROUND(AVG(discount_rate), 6) rate,
          ROUND(SUM(sale_amount - net_amount), 4) given, COUNT_IF(payment_method = 'Cash') cash
        FROM fact GROUP BY 1, 2""")
    got = gold.daily_sales_summary(lake).select(
        "sale_date", "sale_region", "total_transactions", F.col("total_revenue").cast("bigint"), "active_promotions",
        "transactions_with_promo", "active_campaigns", "transactions_with_campaign", F.round("avg_discount_rate", 6),
        F.round("total_discount_given", 4), "cash_transactions",
    )
    assert rows(got) == rows(want)


def test_promotions_and_campaigns_with_several_ranges(lake, spark):
    views(lake)
    spread = spark.sql("SELECT 1 FROM promotions_clean GROUP BY promotion_id HAVING COUNT(*) > 1")
    assert spread.count() > 0
    want = spark.sql("""
        SELECT promotion_id, COUNT(*) n, CAST(SUM(sale_amount) AS BIGINT) revenue, COUNT(DISTINCT merchant_entity) buyers,
          ROUND(SUM(net_amount), 3) net FROM fact WHERE promotion_id IS NOT NULL GROUP BY 1""")
    got = gold.promotions_active(lake).where("total_sales > 0").select(
        "promotion_id", "total_sales", F.col("total_gross_revenue").cast("bigint"), "unique_customers_reached",
        F.round("total_net_revenue", 3),
    )
    assert rows(got.distinct()) == rows(want)
    market = spark.sql("""
        SELECT p.promotion_id, SUM(d.n) FROM promotions_clean p
        JOIN (SELECT sale_region, sale_date, COUNT(*) n FROM fact GROUP BY 1, 2) d
          ON p.region = d.sale_region AND d.sale_date BETWEEN p.start_date AND p.end_date GROUP BY 1""")
    shares = gold.promotions_active(lake).where("total_market_sales > 0").select("promotion_id", "total_market_sales")
    assert rows(shares.distinct()) == rows(market)
    want = spark.sql("""
        SELECT campaign_id, COUNT(*) n, COUNT(DISTINCT merchant_entity) buyers FROM fact
        WHERE campaign_id IS NOT NULL GROUP BY 1""")
    got = gold.marketing_performance(lake).where("actual_sales > 0")
    assert rows(got.select("campaign_id", "actual_sales", "unique_customers_acquired").distinct()) == rows(want)


def test_customers_sum_over_the_fact(lake, spark):
    views(lake)
    want = spark.sql("""
        SELECT CAST(merchant_entity AS BIGINT), CAST(SUM(sale_amount) AS BIGINT), COUNT(*), MIN(sale_date), MAX(sale_date)
        FROM fact WHERE TRY_CAST(merchant_entity AS BIGINT) IN (1, 2) GROUP BY 1""")
    got = gold.customers_enriched(lake).where("total_transactions > 0").select(
        "customer_id", F.col("lifetime_value").cast("bigint"), "total_transactions", "first_purchase_date",
        "last_purchase_date",
    )
    assert rows(got.distinct()) == rows(want)
    never = gold.customers_enriched(lake).where("customer_id = 5").first()
    assert (never.days_since_last_purchase, never.customer_segment, never.churn_risk_score) == (999, "Price Sensitive", 5)
    assert never.last_purchase_date == TODAY


def test_sales_summaries_equal_the_fact(lake, spark):
    views(lake)
    stats = quality.sales_stats(lake).first()
    want = spark.sql("""
        SELECT COUNT(*) n, COUNT(DISTINCT sale_id) ids, SUM(has_promotion) * 100.0D / COUNT(*) promo,
          SUM(has_campaign) * 100.0D / COUNT(*) camp FROM fact""").first()
    assert (stats.row_count, stats.unique_sales) == (want.n, want.ids)
    assert abs(stats.promo_coverage_pct - want.promo) < 0.01 and abs(stats.campaign_coverage_pct - want.camp) < 0.01
    assert [row.failed_records for row in quality.sales_tests(lake).collect()] == [0, 0, 0, 0]


def test_crosses_equal_the_row_by_row_join(lake, spark):
    views(lake)
    want = spark.sql("""
        SELECT i.product_category, i.region, i.stock_level, COUNT(DISTINCT i.product_id), CAST(SUM(f.amount) AS BIGINT),
          COUNT(f.transaction_id), ROUND(AVG(CAST(r.rating AS DOUBLE)), 6)
        FROM inventory_clean i
        LEFT JOIN financial_transactions_clean f ON regexp_substr(f.entity, '([A-Za-z]+)') = i.product_category
          AND f.region = i.region AND f.transaction_type = 'Sale'
        LEFT JOIN product_reviews_clean r ON r.product_category = i.product_category
        GROUP BY 1, 2, 3""")
    got = explore.stock_sales_satisfaction(lake).select(
        "product_category", "region", "stock_level", "product_count", F.col("total_sales").cast("bigint"), "sales_count",
        F.round("avg_product_rating", 6),
    )
    assert rows(got) == rows(want)
    want = spark.sql("""
        SELECT c.resolution_status, c.satisfaction_category, COUNT(*), ROUND(AVG(d.annual_income), 2)
        FROM customer_service_interactions_clean c LEFT JOIN customer_demographics_clean d ON c.customer_id = d.customer_id
        GROUP BY 1, 2""")
    got = explore.service_influence(lake).select(
        "resolution_status", "satisfaction_category", "interaction_count", "avg_customer_income"
    )
    assert rows(got) == rows(want)


def test_export_view_and_its_profile(lake, spark):
    views(lake)
    want = spark.sql("""
        SELECT f.transaction_id IS NULL AS x, f.transaction_date, f.entity, f.region, CAST(f.amount AS BIGINT) amount,
          d.customer_id, m.campaign_name, p.discount_percentage, i.product_category, i.current_stock, l.delivery_status,
          c.satisfaction_category, r.sentiment
        FROM financial_transactions_clean f
        LEFT JOIN customer_demographics_clean d ON TRY_CAST(f.entity AS BIGINT) = d.customer_id
        LEFT JOIN marketing_campaigns_clean m ON f.transaction_date BETWEEN m.start_date AND m.end_date AND f.region = m.region
        LEFT JOIN promotions_clean p ON f.transaction_date BETWEEN p.start_date AND p.end_date
        LEFT JOIN inventory_clean i ON f.region = i.region
        LEFT JOIN logistics_and_shipping_clean l ON TRY_CAST(f.entity AS BIGINT) = l.order_id
        LEFT JOIN customer_service_interactions_clean c ON TRY_CAST(f.entity AS BIGINT) = c.customer_id
        LEFT JOIN (SELECT product_category, sentiment FROM product_reviews_clean GROUP BY 1, 2) r
          ON i.product_category = r.product_category
        WHERE f.transaction_type = 'Sale'""").drop("x")
    got = explore.sales_analysis_export(lake).select(
        "transaction_date", "entity", "region", F.col("amount").cast("bigint").alias("amount"), "customer_id",
        "campaign_name", "discount_percentage", "product_category", "current_stock", "delivery_status",
        "satisfaction_category", "sentiment",
    )
    assert len(explore.sales_analysis_export(lake).columns) == 23
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    totals = want.groupBy(F.trunc("transaction_date", "month"), "region").agg(
        F.count("*"), F.sum("amount")
    )
    profile = explore.sales_analysis_export_profile(lake).select(
        "month", "region", F.col("export_rows").cast("bigint"), F.col("export_amount").cast("bigint")
    )
    assert rows(profile) == rows(totals)


def test_static_and_catalog_tables(lake):
    assert [row.recommendation_rank for row in explore.recommendations(lake).collect()] == [1, 2, 3, 4, 5]
    assert explore.recommendations(lake).first().responsible_department == "Marketing"
    catalog = {row.table_name: row for row in explore.catalog_overview(lake).collect()}
    assert len(catalog) == 11 and catalog["promotions_clean"].column_count == 7
    assert catalog["promotions_clean"].numeric_columns == 1


def test_target_can_be_read_as_percent(lake):
    plain, scaled = gold.marketing_performance(lake), gold.marketing_performance(lake, target_as_percent=True)
    assert plain.count() == scaled.count()
    assert plain.where("conversion_performance = 'Exceeds Target'").count() >= scaled.where(
        "conversion_performance = 'Exceeds Target'"
    ).count()


def test_built_tables_serve_the_queries(spark, lake, tmp_path):
    before = rows(registry.present(gold.promotions_active(lake)))
    written = Lakehouse.from_frames(spark, TODAY, **{name: lake.bronze(name) for name in (
        "financial_transactions", "promotions_data", "marketing_campaigns", "customer_demographics",
        "customer_service_interactions", "logistics_and_shipping", "supplier_information", "employee_records",
        "product_reviews", "inventory_staging", "store_locations_staging")})
    build(written, prefix="test_")
    assert rows(registry.present(written.gold("promotions_active"))) == before
    build(written, prefix="test_")  # replaces tables it reads
    assert spark.table("test_gold.sales_enriched").count() == lake.gold("sales_enriched").count()
    detail = {row.col_name: row for row in spark.sql("DESCRIBE EXTENDED test_gold.promotions_active").collect()}
    assert "performance" in detail["Comment"].data_type and "Revenu net" in detail["roi_percentage"].comment
    other = spark.newSession()
    for name, (plan, order) in VIEWS.items():
        view, want = other.table(f"test_gold.{name}").drop(*gold.AUDIT), plan(lake).drop(*gold.AUDIT)
        assert view.columns == want.columns and view.count() == want.count(), name
        if order:
            assert [r[0] for r in view.collect()] == [r[0] for r in want.collect()], name
        text = {row.col_name: row.data_type for row in other.sql(f"DESCRIBE EXTENDED test_gold.{name}").collect()}
        assert text["Type"] == "VIEW" and text.get("Comment") == VIEW_COMMENTS.get(name)
    assert len(VIEWS) + 1 == 8 and other.table("test_gold.sales_analysis_export").limit(5).count() == 5
    assert not [t.name for t in other.catalog.listTables("test_gold") if t.name.endswith(("__flat", "__next", "__old"))]
    report = str(tmp_path / "report")
    write_report(registry.PLANS["promotion_report"](written), report)
    assert spark.read.option("header", "true").csv(report).count() == registry.PLANS["promotion_report"](lake).count()


@pytest.mark.parametrize("key", ["sales_enriched", "daily_sales_summary", "promotions_active", "customers_enriched",
                                 "marketing_performance", "promo_sensitivity", "promo_vs_no_promo"])
def test_plans_have_no_nested_loops(small_lake, key):
    plan = registry.PLANS[key](small_lake)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
