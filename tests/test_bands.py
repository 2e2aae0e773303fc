"""Every cut point and label, written out: the oracle shares the tables and would not notice a wrong one."""

import pytest
from pyspark.sql import functions as F

from shelfline.functions import bands

AT = {
    "RELIABILITY": [(0.9, "Excellent"), (0.89, "Bon"), (0.7, "Bon"), (0.69, "Moyen"), (0.5, "Moyen"), (0.49, "À améliorer")],
    "SATISFACTION": [(4, "Très satisfait"), (3, "Satisfait"), (2, "Neutre"), (1, "Insatisfait"), (None, "Insatisfait")],
    "CONVERSION_EFFICIENCY": [(0.11, "Très efficace"), (0.1, "Efficace"), (0.05, "Moyenne"), (0.02, "Peu efficace")],
    "SENTIMENT": [(4, "Positive"), (3, "Neutral"), (2, "Negative"), (None, "Unknown")],
    "AGE_GROUP": [(24, "18-24"), (25, "25-34"), (35, "35-44"), (45, "45-54"), (55, "55-64"), (65, "65+")],
    "INCOME_FR": [(29999, "Faible revenu"), (30000, "Revenu moyen"), (60000, "Revenu élevé"), (100000, "Très haut revenu")],
    "INCOME_EN": [
        (29999, "Low Income"), (30000, "Lower Middle Income"), (60000, "Upper Middle Income"), (100000, "High Income"), (150000, "Very High Income"),
    ],
    "RECENCY": [(30, "Recent"), (31, "Active"), (90, "Active"), (91, "At Risk"), (180, "At Risk"), (181, "Churned")],
    "MONETARY": [(10000, "VIP"), (9999, "High Value"), (5000, "High Value"), (4999, "Medium Value"), (1000, "Medium Value"), (999, "Low Value")],
    "FREQUENCY": [(20, "Frequent"), (19, "Regular"), (10, "Regular"), (9, "Occasional"), (3, "Occasional"), (2, "Rare")],
    "SALE_SIZE": [(999, "Low"), (1000, "Medium"), (5000, "High"), (10000, "Very High")],
    "CAMPAIGN_RATING": [(201, "Excellent"), (200, "Good"), (100, "Acceptable"), (50, "Poor"), (0, "Negative")],
    "REVENUE_PER_EURO": [(11, "TRÈS EFFICACE"), (10, "EFFICACE"), (5, "MOYENNE"), (2, "PEU EFFICACE")],
    "PROMOTION_ROI": [(101, "High Performing"), (100, "Medium Performing"), (50, "Low Performing"), (0, "Negative ROI")],
}


def test_all_tables_are_pinned():
    assert set(AT) == {name for name, value in vars(bands).items() if isinstance(value, bands.Bands)}


@pytest.mark.parametrize("name", sorted(AT))
def test_cut_points(spark, name):
    values = spark.createDataFrame([(float(v) if v is not None else None, label) for v, label in AT[name]], "v double, label string")
    wrong = values.where(~getattr(bands, name).name(F.col("v")).eqNullSafe(F.col("label")))
    assert wrong.collect() == []


def test_relative_cut_points(spark):
    stock = [(10, 10, "Critique"), (11, 10, "Bas"), (15, 10, "Bas"), (16, 10, "Normal"), (30, 10, "Normal"), (31, 10, "Élevé"), (None, 10, "Élevé")]
    rows = spark.createDataFrame(stock, "a int, b int, label string")
    assert rows.where(bands.stock_level(F.col("a"), F.col("b")) != F.col("label")).collect() == []
    lights = [
        ("Satisfaction client", 4, "🟢 Excellent"), ("Satisfaction client", 3, "🟡 Satisfaisant"), ("Satisfaction client", 2, "🔴 À améliorer"),
        ("Produits stock critique", 11, "🔴 Critique"), ("Produits stock critique", 6, "🟡 Attention"), ("Produits stock critique", 5, "🟢 Bon"),
        ("Livraisons en retard", 21, "🔴 Critique"), ("Livraisons en retard", 11, "🟡 À surveiller"), ("Livraisons en retard", 10, "🟢 Bon"),
        ("CA Total", 10, "➖ Normal"),
    ]
    rows = spark.createDataFrame(lights, "metric string, v int, label string")
    assert rows.where(bands.kpi_light(F.col("metric"), F.col("v")) != F.col("label")).collect() == []
