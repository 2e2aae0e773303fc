"""Exact sets of visitors as bitmaps that can be merged: distinct counts over any union of cells.

A count of distinct visitors cannot be added up over days or regions; a set can. Every visitor gets a small code, and the
visitors of a cell are a bitmap over the codes. Merging bitmaps costs the same however many visits stand behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CODES = 30_000  # codes a part of the dictionary holds; a bitmap has room for 32,768

#: What places a piece of a set: the part of the dictionary and the bitmap within it.
PLACE = ["_part", "_bucket"]


def visitor_sets(visits: DataFrame, keys: Sequence[str], visitor: str) -> DataFrame:
    """(``keys``, part, bucket, bits): the distinct visitors of each key as bitmaps. NULL visitors belong to no set.

    The dictionary is cut by hash into parts of about ``CODES`` visitors that are numbered on their own, so no task numbers
    them all, and a set touches as few bitmaps as its size allows.
    """
    met = visits.where(F.col(visitor).isNotNull()).select(*keys, visitor).distinct()
    names = met.select(F.col(visitor).alias("_name")).distinct()
    parts = names.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / CODES)).cast("long")).scalar()
    place = F.pmod(F.xxhash64("_name"), parts)
    codes = names.withColumn("_part", place).withColumn("_code", F.row_number().over(Window.partitionBy("_part").orderBy("_name")))
    coded = met.join(codes, met[visitor] == codes["_name"])
    bucket = F.bitmap_bucket_number("_code").alias("_bucket")
    placed = coded.select(*keys, "_part", bucket, F.bitmap_bit_position("_code").alias("_bit"))
    return placed.groupBy(*keys, *PLACE).agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merged(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets of each key."""
    return sets.groupBy(*keys, *PLACE).agg(F.bitmap_or_agg("bits").alias("bits"))


def set_sizes(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(``keys``, ``name``): distinct visitors of the union of each key's sets."""
    return merged(sets, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
