import math
import random

import pytest
from pyspark.sql import functions as F

from shelfline.functions import bands
from shelfline.functions.dialect import (
    half_up,
    half_up_double,
    leading_word,
    lenient_date,
    lenient_id,
    lenient_number,
    ratio,
    without_spaces,
    years_between,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"), [("1 234", 1234), ("12.5", 13), ("0.4", 0), ("", None), ("12a", None), (" 7 ", 7), (None, None)]
)
def test_number_parsing(spark, text, want):
    assert one(spark, lenient_number(without_spaces(F.lit(text).cast("string")))) == want


@pytest.mark.parametrize(("text", "want"), [("2000-02-29", "2000-02-29"), ("2024", None), ("2000-13-45", None), ("x", None)])
def test_date_parsing(spark, text, want):
    got = one(spark, lenient_date(F.lit(text)))
    assert (got and got.isoformat()) == want


def test_identifiers(spark):
    assert [one(spark, lenient_id(F.lit(t))) for t in ("42", "shop 42", "", "9" * 30)] == [42, None, None, None]


def test_years_count_boundaries(spark):
    assert one(spark, years_between(F.lit("2000-12-31").cast("date"), F.lit("2001-01-01").cast("date"))) == 1


def test_rounding_is_half_away_from_zero_despite_binary_noise(spark):
    assert one(spark, half_up(F.lit(2.675), 2)) == 2.68
    assert one(spark, half_up(F.lit(2.1249999999999996), 2)) == 2.13
    assert one(spark, half_up(F.lit(-2.5), 0)) == -3.0


@pytest.mark.parametrize("digits", [0, 2, 4])
def test_quick_rounding_equals_rounding_through_decimals(spark, digits):
    draw = random.Random(digits)
    values = [None, float("nan"), 0.0, -0.0, -1e-9, 1e-9, 2.675, 1.00005, 1e12, -1e12, 123456789012345.67, 1e25]
    for _ in range(4000):
        tie = (draw.randrange(-10**9, 10**9) + 0.5) / 10**digits
        values += [tie, math.nextafter(tie, 0), tie + draw.choice([-1, 1]) * 10.0 ** -draw.randrange(4, 12)]
        values += [draw.uniform(-1, 1) * 10.0 ** draw.randrange(-6, 16), draw.randrange(1, 10**6) * (1 - draw.randrange(100) / 100)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(2)
    got = df.select(F.col("x"), half_up_double(F.col("x"), digits).alias("a"), half_up(F.col("x"), digits).alias("b"))
    # As text, so that a negative zero counts.
    assert got.where("NOT CAST(a AS STRING) <=> CAST(b AS STRING)").limit(5).collect() == []


def test_zero_divisor_gives_null(spark):
    assert one(spark, ratio(F.lit(5), F.lit(0))) is None


def test_leading_word(spark):
    assert [one(spark, leading_word(F.lit(t))) for t in ("PROMO shop 1", "123", "12ab3")] == ["PROMO", None, "ab"]


@pytest.mark.parametrize(
    ("table", "value", "name"),
    [
        (bands.RECENCY, 30, "Recent"), (bands.RECENCY, 31, "Active"), (bands.RECENCY, 90, "Active"),
        (bands.RECENCY, 91, "At Risk"), (bands.RECENCY, 180, "At Risk"), (bands.RECENCY, 181, "Churned"),
        (bands.MONETARY, 999, "Low Value"), (bands.MONETARY, 1000, "Medium Value"),
        (bands.MONETARY, 5000, "High Value"), (bands.MONETARY, 10000, "VIP"),
        (bands.FREQUENCY, 2, "Rare"), (bands.FREQUENCY, 3, "Occasional"), (bands.FREQUENCY, 10, "Regular"),
        (bands.FREQUENCY, 20, "Frequent"),
        (bands.AGE_GROUP, 24, "18-24"), (bands.AGE_GROUP, 25, "25-34"), (bands.AGE_GROUP, None, "65+"),
        (bands.SATISFACTION, None, "Insatisfait"), (bands.SENTIMENT, None, "Unknown"), (bands.SENTIMENT, 3, "Neutral"),
        (bands.CAMPAIGN_RATING, 0, "Negative"), (bands.CAMPAIGN_RATING, 200.01, "Excellent"),
    ],
)
def test_cut_points(spark, table, value, name):
    assert one(spark, table.name(F.lit(value).cast("double"))) == name
