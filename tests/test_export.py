"""The factorised export: bags, their expansion, and the written view."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.lakehouse import Lakehouse
from shelfline.operators.factors import bags, expanded
from shelfline.plans import explore, export


@pytest.fixture(scope="module")
def lake(spark, day):
    """A hot customer, text and null entities, null regions and days, repeated rows on every side."""

    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    sales = [("7", "N", day("2024-01-05"), 10 + i % 3, "Sale") for i in range(9)]
    sales += [("7", "S", day("2024-02-01"), 5, "Sale"), ("8", "N", day("2024-01-06"), 6, "Sale"), ("shop", "N", day("2024-01-05"), 7, "Sale")]
    sales += [(None, None, None, 8, "Sale"), ("shop", None, day("2024-01-05"), 9, "Sale"), ("7", "N", None, 1, "Sale"), ("8", "N", day("2024-01-05"), 3, "REFUND")]
    return Lakehouse.from_frames(
        spark,
        dt.date(2024, 6, 30),
        financial_transactions_clean=table(sales, "entity string, region string, transaction_date date, amount long, transaction_type string"),
        customer_demographics_clean=table([(7, 30, "F", 10, "Single"), (7, 30, "F", 10, "Single"), (None, 1, "M", 1, "x")], "customer_id long, age int, gender string, annual_income long, marital_status string"),
        marketing_campaigns_clean=table(
            [(f"c{i % 4}", "Email", day("2024-01-01"), day("2024-01-05"), "N") for i in range(7)] + [("lost", "TV", day("2024-01-01"), day("2024-03-01"), None)],
            "campaign_name string, campaign_type string, start_date date, end_date date, region string",
        ),
        promotions_clean=table([("Bundle", 5.0 + i % 5, day("2024-01-05"), day("2024-01-06")) for i in range(8)], "promotion_type string, discount_percentage double, start_date date, end_date date"),
        inventory_clean=table([("N", f"k{i % 3}", "Bas", i, 5) for i in range(6)] + [(None, "k0", "Bas", 1, 1)], "region string, product_category string, stock_level string, current_stock int, reorder_point int"),
        logistics_and_shipping_clean=table([(7, "Air", "x"), (7, "Air", "x"), (7, "Sea", "y"), (None, "Air", "z")], "order_id long, shipping_method string, delivery_status string"),
        customer_service_interactions_clean=table([(7, "Neutre"), (8, "Neutre"), (None, "x")], "customer_id long, satisfaction_category string"),
        product_reviews_clean=table([("k0", "Positive", 4), ("k0", "Negative", 1), ("k1", "Positive", 5)], "product_category string, sentiment string, rating int"),
    )


def row_by_row(lake):
    """The view as chained joins."""
    t = lake.silver
    sold = t("financial_transactions_clean").where("transaction_type = 'Sale'").withColumn("id", F.expr("try_cast(entity as bigint)")).alias("f")
    scores = t("product_reviews_clean").groupBy("product_category", "sentiment").agg(F.avg("rating").alias("avg_rating")).alias("r")
    return (
        sold.join(t("customer_demographics_clean").alias("d"), F.expr("f.id = d.customer_id"), "left")
        .join(t("marketing_campaigns_clean").alias("m"), F.expr("f.transaction_date between m.start_date and m.end_date and f.region = m.region"), "left")
        .join(t("promotions_clean").alias("p"), F.expr("f.transaction_date between p.start_date and p.end_date"), "left")
        .join(t("inventory_clean").alias("i"), F.expr("f.region = i.region"), "left")
        .join(t("logistics_and_shipping_clean").alias("l"), F.expr("f.id = l.order_id"), "left")
        .join(t("customer_service_interactions_clean").alias("c"), F.expr("f.id = c.customer_id"), "left")
        .join(scores, F.expr("i.product_category = r.product_category"), "left")
        .selectExpr(
            "transaction_date", "entity", "f.region", "amount", "transaction_type", "d.customer_id", "age", "gender", "annual_income", "marital_status",
            "campaign_name", "campaign_type", "promotion_type", "discount_percentage", "i.product_category", "stock_level", "current_stock", "reorder_point",
            "shipping_method", "delivery_status", "satisfaction_category", "sentiment", "avg_rating",
        )
    )


@pytest.mark.parametrize("chunk", [1, 2, 1024])
def test_factors_expand_to_the_row_by_row_join(lake, chunk):
    want = row_by_row(lake)
    got = export.combinations(export.joined(export.export_factors(lake, chunk)))
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_bags_are_bounded_and_lose_nothing(spark):
    rows = spark.createDataFrame([("hot", i % 500) for i in range(5000)] + [(None, 1), (None, 1), ("cold", None)], "k string, v int")
    found = bags(rows, ["k"], ["v"], "bag", chunk=20).collect()
    assert len([r for r in found if r.k == "hot"]) > 15 and max(len(r.bag) for r in found) < 60
    assert Counter((r.k, e.v) for r in found for e in r.bag for _ in range(e.times)) == Counter(map(tuple, rows.collect()))
    lone = spark.createDataFrame([("x",)], "k string").join(bags(rows.where("false"), ["k"], ["v"], "bag"), "k", "left")
    assert [tuple(r) for r in expanded(lone, ["bag"]).collect()] == [("x", None)]


def test_nothing_is_shuffled_after_the_matches_multiply(lake):
    plan = explore.sales_analysis_export(lake)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Exchange")]
    assert above.count("Generate explode(") == 8  # seven bags and the copies
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_whole_view_is_written_month_after_month(spark, lake, day):
    spark.sql("CREATE DATABASE IF NOT EXISTS export_test")
    name = "export_test.sales_analysis_export"
    want = Counter(map(tuple, row_by_row(lake).collect()))
    written = export.write_export(lake, name)
    assert Counter(tuple(r)[:-1] for r in written.collect()) == want
    assert {r.month for r in written.select("month").collect()} == {None, day("2024-01-01"), day("2024-02-01")}
    again = export.write_export(lake, name, first=day("2024-02-15"))  # a rerun replaces its months and keeps the others
    assert Counter(tuple(r)[:-1] for r in again.collect()) == want


def test_every_session_reads_the_export_view(spark, lake):
    spark.sql("CREATE DATABASE IF NOT EXISTS export_test")
    want = row_by_row(lake)
    for _ in range(2):  # a rerun replaces the view and its factors
        view = export.create_export_view(lake, "export_test.export_view")
    assert view.columns == want.columns
    assert Counter(map(tuple, view.collect())) == Counter(map(tuple, want.collect()))
    other = spark.newSession().sql("SELECT * FROM export_test.export_view WHERE transaction_date = DATE '2024-02-01'")
    assert Counter(map(tuple, other.collect())) == Counter(tuple(r) for r in want.collect() if str(r.transaction_date) == "2024-02-01")
    scans = [line for line in other._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line]
    assert sum("EqualTo(day,2024-02-01)" in line for line in scans) >= 3  # visits, campaigns and promotions


def test_rows_are_read_once_for_sizes_and_entries(spark):
    rows = spark.createDataFrame([(i % 40, i) for i in range(2000)], "k long, v long")
    found = bags(rows, ["k"], ["v"], "bag", chunk=5)
    assert sum(len(r.bag) for r in found.collect()) == 2000
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan ExistingRDD") == 1 and "ReusedExchange" in plan


def test_rows_that_stand_for_several_give_the_same_bags(spark):
    rows = spark.createDataFrame([("a", i % 3) for i in range(10)] + [(None, None)] * 2, "k string, v int")
    counted = rows.groupBy("k", "v").agg(F.count("*").alias("n"))
    halves = counted.selectExpr("k", "v", "n - 1 n").where("n > 0").unionAll(counted.selectExpr("k", "v", "1L n"))

    def entries(df):
        return Counter((r.k, e.v, e.times) for r in df.collect() for e in r.bag)

    assert entries(bags(halves, ["k"], ["v"], "bag", copies="n")) == entries(bags(rows, ["k"], ["v"], "bag"))


def test_documents_of_a_small_part_file_are_built_by_all_tasks(spark):
    from shelfline.sources.star_schema import _inventory_documents

    part = spark.range(0, 40, 1, 1).selectExpr("id p_partkey", "'LARGE' p_type", "3 p_size")
    documents = _inventory_documents(part)
    assert documents.count() == 40 and documents.rdd.getNumPartitions() == 8
