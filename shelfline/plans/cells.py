"""Written (region, day, type) cells of the transactions, and the queries that read them instead of the transactions.

``build`` writes the two tables. They grow with the calendar and, for the sets, with the visitors, not with the
transactions. A query asks ``written``; where nothing is written, it reads the transactions themselves.

* ``transaction_days``: counts and sums, which add up over any cells. Behind ``gold.sales_cells`` it answers the daily tables,
  promotions, campaigns, the boards, tests and statistics over the enriched fact; with the sets, the three below.
* ``entity_sets``: the distinct entities as bitmaps, which merge over any cells: ``monthly_sales``, ``region_performance`` and
  ``monthly_report`` take their exact distinct counts from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dialect import ratio
from shelfline.operators.visitor_sets import set_sizes, visitor_sets

if TYPE_CHECKING:
    from shelfline.lakehouse import Lakehouse

KEYS = ["region", "transaction_date", "transaction_type"]
#: Table, columns its files are clustered by, column that spreads a hot cluster.
TABLES = {
    "transaction_days": (("transaction_date", "region"), "transaction_type"),
    "entity_sets": (("transaction_date", "region"), "_part"),
}


def measures() -> dict[str, Column]:
    """What is kept of a cell's transactions; every one can be added up (``largest``: compared)."""
    method = F.col("payment_method")
    return {
        "sales": F.count("*"),
        "named_sales": F.count("transaction_id"),
        "amount": F.sum("amount"),
        "amounts": F.count("amount"),
        "largest": F.max("amount"),
        "positive_sales": F.count_if(F.col("amount") > 0),
        "negative_sales": F.count_if(F.col("amount") < 0),
        "card_sales": F.count_if(method == "Credit Card"),
        "cash_sales": F.count_if(method == "Cash"),
        "transfer_sales": F.count_if(method == "Bank Transfer"),
    }


def transaction_days(lake: Lakehouse) -> DataFrame:
    """Per cell, and apart for positive amounts (``paid``), the ``measures``."""
    rows = lake.silver("financial_transactions_clean").groupBy(*KEYS, (F.col("amount") > 0).alias("paid"))
    return rows.agg(*[e.alias(name) for name, e in measures().items()])


def entity_sets(lake: Lakehouse) -> DataFrame:
    """Per cell the distinct entities, as bitmaps."""
    return visitor_sets(lake.silver("financial_transactions_clean"), KEYS, "entity")


def written(lake: Lakehouse, name: str, of_type: str | None = None) -> DataFrame | None:
    """The written table, of one transaction type or of all, if ``build`` wrote it."""
    table = lake.written("gold", name)
    return table if table is None or of_type is None else table.where(F.col("transaction_type") == of_type)


def summary(lake: Lakehouse, keys: dict[str, Column], of_type: str | None, visitors: str, **aggregates: Column) -> DataFrame | None:
    """Aggregates over written cells by ``keys`` (name: expression), with the distinct entities as ``visitors``.

    None if the cells are not written. ``aggregates`` are over the columns of ``transaction_days``.
    """
    days, sets = written(lake, "transaction_days", of_type), written(lake, "entity_sets", of_type)
    if days is None or sets is None:
        return None
    names = list(keys)
    counted = set_sizes(sets.withColumns(keys), names, visitors)
    counted = counted.select(*[F.col(n).alias(f"_{n}") for n in names], visitors)
    totals = days.withColumns(keys).groupBy(*names).agg(*[e.alias(name) for name, e in aggregates.items()])
    same = F.lit(True)
    for n in names:
        same &= totals[n].eqNullSafe(counted[f"_{n}"])
    return totals.join(counted, same, "left").select(*totals.columns, F.coalesce(visitors, F.lit(0)).alias(visitors))


def total_amount(amount: Column | None = None) -> Column:
    """The sum of amounts, of the type it has over the transactions."""
    return F.sum(F.col("amount") if amount is None else amount).cast("decimal(28,0)")


def mean_amount() -> Column:
    return ratio(F.sum("amount"), F.sum("amounts"))
