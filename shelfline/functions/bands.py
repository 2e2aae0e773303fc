"""Threshold tables: a value is named by the first cut it passes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_TESTS = {
    ">": lambda value, cut: value > cut,
    ">=": lambda value, cut: value >= cut,
    "<": lambda value, cut: value < cut,
    "<=": lambda value, cut: value <= cut,
    "=": lambda value, cut: value == cut,
}


class Bands(NamedTuple):
    """Ordered ``(test, cut, name)`` rows and the name for everything else, NULL included."""

    rows: tuple[tuple[str, float, str], ...]
    otherwise: str

    def name(self, value: Column) -> Column:
        chosen = None
        for test, cut, label in self.rows:
            hit = _TESTS[test](value, F.lit(cut))
            chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
        return chosen.otherwise(self.otherwise)


# Names and cut points the results must carry exactly.

RELIABILITY = Bands(((">=", 0.9, "Excellent"), (">=", 0.7, "Bon"), (">=", 0.5, "Moyen")), "À améliorer")
SATISFACTION = Bands(((">=", 4, "Très satisfait"), (">=", 3, "Satisfait"), (">=", 2, "Neutre")), "Insatisfait")
CONVERSION_EFFICIENCY = Bands(
    ((">", 0.1, "Très efficace"), (">", 0.05, "Efficace"), (">", 0.02, "Moyenne")), "Peu efficace"
)
SENTIMENT = Bands(((">=", 4, "Positive"), ("=", 3, "Neutral"), ("<=", 2, "Negative")), "Unknown")
AGE_GROUP = Bands(
    (("<", 25, "18-24"), ("<", 35, "25-34"), ("<", 45, "35-44"), ("<", 55, "45-54"), ("<", 65, "55-64")), "65+"
)
INCOME_FR = Bands(
    (("<", 30000, "Faible revenu"), ("<", 60000, "Revenu moyen"), ("<", 100000, "Revenu élevé")), "Très haut revenu"
)
INCOME_EN = Bands(
    (
        ("<", 30000, "Low Income"),
        ("<", 60000, "Lower Middle Income"),
        ("<", 100000, "Upper Middle Income"),
        ("<", 150000, "High Income"),
    ),
    "Very High Income",
)
RECENCY = Bands((("<=", 30, "Recent"), ("<=", 90, "Active"), ("<=", 180, "At Risk")), "Churned")
MONETARY = Bands(((">=", 10000, "VIP"), (">=", 5000, "High Value"), (">=", 1000, "Medium Value")), "Low Value")
FREQUENCY = Bands(((">=", 20, "Frequent"), (">=", 10, "Regular"), (">=", 3, "Occasional")), "Rare")
SALE_SIZE = Bands((("<", 1000, "Low"), ("<", 5000, "Medium"), ("<", 10000, "High")), "Very High")
CAMPAIGN_RATING = Bands(
    ((">", 200, "Excellent"), (">", 100, "Good"), (">", 50, "Acceptable"), (">", 0, "Poor")), "Negative"
)
REVENUE_PER_EURO = Bands(((">", 10, "TRÈS EFFICACE"), (">", 5, "EFFICACE"), (">", 2, "MOYENNE")), "PEU EFFICACE")
PROMOTION_ROI = Bands(
    ((">", 100, "High Performing"), (">", 50, "Medium Performing"), (">", 0, "Low Performing")), "Negative ROI"
)

# Value used for "days since last purchase" of customers who never bought.
NEVER_BOUGHT_DAYS = 999

# Stock level: current stock against multiples of the reorder point.
STOCK_LEVELS = (("Critique", 1.0), ("Bas", 1.5), ("Normal", 3.0))
STOCK_LEVEL_ABOVE = "Élevé"

# Campaign conversion against its target: (test, multiple of the target, name).
CONVERSION_VS_TARGET = ((">", 1.2, "Exceeds Target"), (">=", 1.0, "Meets Target"), (">", 0.8, "Below Target"))
CONVERSION_BELOW = "Underperforming"

# KPI traffic lights: (metric, test, cut, name), first match wins.
KPI_LIGHTS = (
    ("Satisfaction client", ">=", 4, "🟢 Excellent"),
    ("Satisfaction client", ">=", 3, "🟡 Satisfaisant"),
    ("Satisfaction client", "<", 3, "🔴 À améliorer"),
    ("Produits stock critique", ">", 10, "🔴 Critique"),
    ("Produits stock critique", ">", 5, "🟡 Attention"),
    ("Produits stock critique", "<=", 5, "🟢 Bon"),
    ("Livraisons en retard", ">", 20, "🔴 Critique"),
    ("Livraisons en retard", ">", 10, "🟡 À surveiller"),
    ("Livraisons en retard", "<=", 10, "🟢 Bon"),
)
KPI_LIGHT_OTHERWISE = "➖ Normal"


def against(value: Column, base: Column, rows: tuple[tuple[str, float, str], ...], otherwise: str) -> Column:
    """Like ``Bands.name`` with cuts given as multiples of another column."""
    chosen = None
    for test, multiple, label in rows:
        cut = base if multiple == 1.0 else base * F.lit(multiple)
        hit = _TESTS[test](value, cut)
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    return chosen.otherwise(otherwise)


def stock_level(stock: Column, reorder_point: Column) -> Column:
    rows = tuple(("<=", multiple, label) for label, multiple in STOCK_LEVELS)
    return against(stock, reorder_point, rows, STOCK_LEVEL_ABOVE)


def kpi_light(metric: Column, value: Column) -> Column:
    chosen = None
    for name, test, cut, label in KPI_LIGHTS:
        hit = (metric == name) & _TESTS[test](value, F.lit(cut))
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    return chosen.otherwise(KPI_LIGHT_OTHERWISE)
