import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.operators.keep_one import keep_first
from shelfline.operators.ordered import exact_median, rank_by


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(3)
    rows = [(i, float(int(rng.expovariate(0.01)))) for i in range(1500)]
    rows += [(i, 77.0) for i in range(2000, 2800)] + [(i, None) for i in range(3000, 3005)] + [(9000, 1e12)]
    return spark.createDataFrame(rows, "id int, v double").cache()


def test_median_matches_builtin(values, spark):
    for df in (values, values.where("id < 1501"), values.where("id < 4"), spark.createDataFrame([(2.0,), (5.0,)], "v double")):
        assert exact_median(df, "v").first()[0] == df.agg(F.median("v")).first()[0]


def test_median_of_nothing_is_null(spark):
    assert exact_median(spark.createDataFrame([], "v double"), "v").first()[0] is None


def test_rank_matches_window(values):
    want = values.withColumn("place", F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())))
    got = rank_by(values, "v", "place")
    assert got.select("id", "place").exceptAll(want.select("id", F.col("place").cast("bigint"))).isEmpty()
    assert got.count() == values.count()


def test_null_ratings_rank_first(spark):
    ranked = rank_by(spark.createDataFrame([(2,), (None,), (1,)], "v int"), "v", "place").collect()
    assert {(row.v, row.place) for row in ranked} == {(None, 1), (2, 2), (1, 3)}


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m")], "k string, n int, s string")
    kept = keep_first(df, "k", [F.col("n").asc_nulls_last()])
    assert {tuple(row) for row in kept.collect()} == {("a", 1, "y"), (None, 4, "m")}
    assert kept._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_keep_first_shuffles_a_hash_in_place_of_unused_columns(spark):
    df = spark.createDataFrame([("a", 1, "x", "p", 1.0), ("a", 1, "x", "q", 2.0), ("a", 1, "y", "p", 3.0), ("b", 2, "z", None, None)], "k string, n int, s string, t string, v double")
    kept = keep_first(df, "k", [F.col("n").asc_nulls_last()], ties=["s"])
    rows = {tuple(row) for row in kept.collect()}
    assert kept.columns == df.columns and len(rows) == 2 and ("b", 2, "z", None, None) in rows
    assert rows == {tuple(row) for row in keep_first(df.repartition(3), "k", [F.col("n").asc_nulls_last()], ties=["s"]).collect()}
    assert [row.s for row in kept.where("k = 'a'").collect()] == ["x"]


def test_quarterly_growth_shuffles_no_unused_column(spark, day):
    from shelfline import Lakehouse
    from shelfline.plans import explore
    from shelfline.sources import schemas

    rows = [(f"T{i % 7}", day("2024-01-05"), "Sale", str(i + 1), "Cash", "7", "N", "A") for i in range(20)]
    lake = Lakehouse.from_frames(spark, day("2024-06-30"), financial_transactions=spark.createDataFrame(rows, schemas.CSV_SCHEMAS["financial_transactions"]).repartition(3))
    plan = explore.quarterly_growth(lake)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchange = [block for block in plan.split("\n\n") if "Exchange" in block and "hashpartitioning(transaction_id" in block]
    assert len(exchange) == 1 and "_hash" in exchange[0]
    for unused in ("payment_method", "region", "account_code"):
        assert unused not in exchange[0]
