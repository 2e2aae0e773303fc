"""Bronze tables over a folder of star-schema Parquet tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.star_schema_sql import BRONZE_SQL

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels")


_opened: dict[tuple[str, str, str], DataFrame] = {}


def open_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One source table; its schema is read once per application."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"), table)
    if key not in _opened:
        _opened[key] = spark.read.parquet(f"{key[1]}/{table}.parquet")
    return _opened[key]


def _run(spark: SparkSession, folder: str, block: str) -> DataFrame:
    """Run a block over the source tables it names."""
    text = BRONZE_SQL[block]
    for table in SOURCE_TABLES:
        if re.search(rf"\b{table}\b", text):
            open_source(spark, folder, table).createOrReplaceTempView(table)
    return spark.sql(text)


def _inventory_documents(part: DataFrame) -> DataFrame:
    """One JSON array of two elements per part, built row by row.

    Text and variant take far more time than the few bytes of a part suggest, and a part table of one file is read by a
    task or two. Its rows are therefore dealt over the session's shuffle partitions first.
    """
    dealt = part.select("p_partkey", "p_type", "p_size").repartition(int(part.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    element = """
      named_struct(
        'product_id', CASE WHEN p_partkey % 45 = 1 THEN NULL ELSE concat('PR', p_partkey, '-', e) END,
        'product_category', p_type,
        'region', element_at(array('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), CAST(p_partkey % 5 AS INT) + 1),
        'country', concat('NATION_', p_partkey % 25),
        'warehouse', concat('WH', e),
        'current_stock', (p_partkey * 17 + e) % 200,
        'reorder_point', CAST(p_size AS BIGINT),
        'lead_time', p_partkey % 20,
        'last_restock_date', DATE '2001-01-01' + CAST(p_partkey % 200 AS INT))
    """
    array = f"transform(array(0, 1), e -> {element})"
    return dealt.select(F.parse_json(F.expr(f"to_json({array})")).alias("raw_data"))


def _store_documents(items: DataFrame) -> DataFrame:
    return items.select(F.parse_json(F.to_json(F.array(F.struct(*items.columns)))).alias("raw_data"))


def read_bronze(spark: SparkSession, folder: str, table: str) -> DataFrame:
    if table == "inventory_staging":
        return _inventory_documents(open_source(spark, folder, "part"))
    if table == "store_locations_staging":
        return _store_documents(_run(spark, folder, "store_items"))
    return _run(spark, folder, table)
