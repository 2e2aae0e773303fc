"""The wide export view for reporting tools, kept as factors and written period after period."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dialect import lenient_id, mean, ratio
from shelfline.operators.factors import CHUNK, bags, expanded
from shelfline.operators.intervals import days_covered
from shelfline.sources.tables import create_view, replace_partitions, replace_table

if TYPE_CHECKING:
    from shelfline.lakehouse import Lakehouse

SALE = ("entity", "amount", "transaction_type")
CUSTOMER = ("customer_id", "age", "gender", "annual_income", "marital_status")
CAMPAIGN = ("campaign_name", "campaign_type")
PROMOTION = ("promotion_type", "discount_percentage")
STOCK = ("product_category", "stock_level", "current_stock", "reorder_point", "sentiment", "avg_rating")
SHIPMENT = ("shipping_method", "delivery_status")
INTERACTION = ("satisfaction_category",)
WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class ExportFactors:
    """The view as four tables of bags.

    ``visits``: per (id, region, day) its sales, and the customers, shipments and interactions of the id. ``campaigns``: per
    (region, day) those running. ``promotions``: per day those running. ``stock``: per region its items with review scores.
    """

    visits: DataFrame
    campaigns: DataFrame
    promotions: DataFrame
    stock: DataFrame


def review_scores(lake: Lakehouse) -> DataFrame:
    """Mean rating by category and sentiment."""
    return lake.silver("product_reviews_clean").groupBy("product_category", "sentiment").agg(mean(F.col("rating")).alias("avg_rating"))


def export_factors(lake: Lakehouse, chunk: int = CHUNK) -> ExportFactors:
    """The bags of the export view; each table grows with its inputs (ranges: with the days they cover).

    Equal promotions are counted before they are expanded into days, equal items before they meet their review scores.
    """
    sold = lake.silver("financial_transactions_clean").where(F.col("transaction_type") == "Sale")
    sold = sold.select(lenient_id(F.col("entity")).alias("id"), "region", F.col("transaction_date").alias("day"), *SALE)
    visits = bags(sold, ["id", "region", "day"], SALE, "sales", chunk)

    def of_id(table: str, key: str, entry: tuple[str, ...], name: str) -> DataFrame:
        rows = lake.silver(table).where(F.col(key).isNotNull())
        return bags(rows.withColumn("id", F.col(key)), ["id"], entry, name, chunk)

    visits = visits.join(of_id("customer_demographics_clean", "customer_id", CUSTOMER, "customers"), "id", "left")
    visits = visits.join(of_id("logistics_and_shipping_clean", "order_id", SHIPMENT, "shipments"), "id", "left")
    visits = visits.join(of_id("customer_service_interactions_clean", "customer_id", INTERACTION, "interactions"), "id", "left")

    copies = F.count(F.lit(1)).alias("copies")
    campaigns = days_covered(lake.silver("marketing_campaigns_clean").where("region is not null"))
    promotions = days_covered(lake.silver("promotions_clean").groupBy("start_date", "end_date", *PROMOTION).agg(copies))
    items = lake.silver("inventory_clean").where("region is not null")
    items = items.groupBy("region", *STOCK[:4]).agg(copies).join(review_scores(lake), "product_category", "left")
    return ExportFactors(
        visits,
        bags(campaigns, ["region", "day"], CAMPAIGN, "campaigns", chunk),
        bags(promotions, ["day"], PROMOTION, "promotions", chunk, "copies"),
        bags(items, ["region"], STOCK, "stock", chunk, "copies"),
    )


def joined(factors: ExportFactors) -> DataFrame:
    """The visits with all their bags side by side, nothing multiplied but chunks."""
    rows = factors.visits.join(factors.campaigns, ["region", "day"], "left").join(factors.promotions, "day", "left")
    return rows.join(factors.stock, "region", "left")


def combinations(rows: DataFrame) -> DataFrame:
    """The rows of the view that ``joined`` stands for."""
    rows = expanded(rows, ["sales", "customers", "campaigns", "promotions", "stock", "shipments", "interactions"])

    def of(name: str, entry: tuple[str, ...]) -> list:
        return [F.col(f"{name}.{column}") for column in entry]

    return rows.select(
        F.col("day").alias("transaction_date"),
        "sales.entity",
        "region",
        "sales.amount",
        "sales.transaction_type",
        *of("customers", CUSTOMER),
        *of("campaigns", CAMPAIGN),
        *of("promotions", PROMOTION),
        *of("stock", STOCK[:4]),
        *of("shipments", SHIPMENT),
        *of("interactions", INTERACTION),
        *of("stock", STOCK[4:]),
    )


def sales_analysis_export(lake: Lakehouse) -> DataFrame:
    """Wide view for reporting tools: every sale with all matching customers, campaigns, promotions, stock items of its
    region, shipments, interactions and review scores.

    The matches multiply, by definition of the view. They are joined as bags and multiplied after the last shuffle, so what
    is shuffled grows with the inputs and with the output. ``write_export`` writes the whole view.
    """
    return combinations(joined(export_factors(lake)))


def written_factors(lake: Lakehouse, name: str) -> ExportFactors:
    """The factors as tables, ``name`` with a suffix each."""
    factors = export_factors(lake)
    return ExportFactors(*(replace_table(getattr(factors, part.name), f"{name}__{part.name}") for part in fields(ExportFactors)))


def create_export_view(lake: Lakehouse, name: str) -> DataFrame:
    """Write the factors and create the whole view over them in the catalogue.

    The stored text joins the factors and multiplies them, so every session can read the view, and a filter on its date or
    region reaches the factors before anything is multiplied.
    """
    written_factors(lake, name)
    entries = {"sales": SALE, "customers": CUSTOMER, "campaigns": CAMPAIGN, "promotions": PROMOTION, "stock": STOCK[:4], "shipments": SHIPMENT, "interactions": INTERACTION}
    shown = {bag: [f"{bag}_entry.{column}" for column in entry] for bag, entry in entries.items()}
    rest = [f"stock_entry.{column}" for column in STOCK[4:]]
    sale = shown.pop("sales")
    columns = ["day AS transaction_date", sale[0], "region", *sale[1:], *(c for part in shown.values() for c in part), *rest]
    copies = " * ".join(f"coalesce({bag}_entry.times, 1L)" for bag in entries)
    query = f"""SELECT {", ".join(columns)} FROM (
    SELECT v.region, v.day, sales, customers, shipments, interactions, campaigns, promotions, stock
    FROM {name}__visits v LEFT JOIN {name}__campaigns c ON v.region = c.region AND v.day = c.day
    LEFT JOIN {name}__promotions p ON v.day = p.day LEFT JOIN {name}__stock s ON v.region = s.region) f
    {" ".join(f"LATERAL VIEW OUTER explode({bag}) {bag}_view AS {bag}_entry" for bag in entries)}
    LATERAL VIEW explode(sequence(1L, {copies})) copies_view AS copy_number"""
    return create_view(lake.spark, name, query)


def write_export(lake: Lakehouse, name: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Write the view to the table ``name``, one partition a month, and return the table.

    The factors are written first (``name`` with a suffix), so no month repeats a join of the inputs. Each month replaces its
    own partition: a run that stopped halfway is run again, whole or from ``first`` on, and leaves no row twice. ``first`` and
    ``last`` choose months by any of their days; without them all months are written, sales without a date included.
    """
    spark = lake.spark
    factors = written_factors(lake, name)
    month = F.trunc("day", "month")
    months = [row[0] for row in factors.visits.select(month.alias("month")).distinct().collect()]  # bounded by the calendar
    low, high = first and first.replace(day=1), last and last.replace(day=1)
    for chosen in sorted(months, key=lambda m: (m is not None, m)):
        if (low or high) and (chosen is None or (low and chosen < low) or (high and chosen > high)):
            continue
        of_month = month.eqNullSafe(F.lit(chosen).cast("date"))
        part = ExportFactors(factors.visits.where(of_month), factors.campaigns.where(of_month), factors.promotions.where(of_month), factors.stock)
        rows = combinations(joined(part)).withColumn("month", F.lit(chosen).cast("date"))
        replace_partitions(rows, name, "month")
    return spark.table(name)


def sales_analysis_export_factors(lake: Lakehouse) -> DataFrame:
    """By month and region of the sales: distinct visits, the rows of the view their bags stand for, and rows a visit.

    Computed from the factors alone: bag counts are multiplied side by side, chunks add up.
    """
    factors = export_factors(lake)

    def total(name: str) -> Column:
        return F.expr(f"coalesce(aggregate({name}, 0L, (n, x) -> n + x.times), 0L)").cast(WIDE)

    def at_least_one(total: Column) -> Column:
        return F.greatest(F.lit(1).cast(WIDE), total)

    def counted(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum(total(name)).alias(name))

    repeats = total("sales")
    for name in ("customers", "shipments", "interactions"):
        repeats = (repeats * at_least_one(total(name))).cast(WIDE)
    cells = factors.visits.groupBy("region", "day").agg(F.count_distinct(F.struct("id")).alias("visits"), F.sum(repeats).alias("rows"))
    cells = cells.join(counted(factors.campaigns, ["region", "day"], "campaigns"), ["region", "day"], "left")
    cells = cells.join(counted(factors.promotions, ["day"], "promotions"), "day", "left").join(counted(factors.stock, ["region"], "stock"), "region", "left")
    rows = F.col("rows")
    for name in ("campaigns", "promotions", "stock"):
        rows = (rows * at_least_one(F.coalesce(name, F.lit(0)).cast(WIDE))).cast(WIDE)
    by_month = cells.groupBy(F.trunc("day", "month").alias("month"), "region").agg(F.sum("visits").alias("visits"), F.sum(rows).alias("export_rows"))
    return by_month.withColumn("rows_per_visit", ratio(F.col("export_rows"), F.col("visits")))
