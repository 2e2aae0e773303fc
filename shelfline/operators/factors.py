"""Factorised join results: matches kept as bags beside each other instead of as their product.

A join of one row with several independent sides repeats the row once for every combination of matches. A factorised
result keeps, per key, one array of matches a side, and makes the combinations only when they are read. What is shuffled
and stored grows with the matches, not with their product.

A bag is cut into chunks of bounded size, each a row of its own, so a hot key becomes more rows instead of one huge array.
Equal matches are one entry with a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1024  # entries a bag row holds on average, at most


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the prefixed columns of ``right``."""
    condition = F.lit(True)
    for key in keys:
        condition &= left[key].eqNullSafe(right[f"{prefix}{key}"])
    return condition


def bags(
    rows: DataFrame, keys: Sequence[str], entry: Sequence[str], name: str, chunk: int = CHUNK, copies: str | None = None
) -> DataFrame:
    """(keys, ``name``): the rows of each key as arrays of structs (``entry`` columns, ``times``), one row a chunk.

    Null keys are keys like any other. Keys with at most ``chunk`` different entries have one row; the entries of others are
    dealt by their hash. ``copies`` names a column that says how many rows a row stands for.
    """
    times = F.count(F.lit(1)) if copies is None else F.sum(copies)
    counted = rows.groupBy(*keys, *entry).agg(times.alias("times"))
    # Sizes read ``times`` as well: Spark would otherwise drop the column there and scan and group the rows a second time.
    different = F.count_if(F.col("times") > 0)
    sizes = counted.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.ceil(different / chunk).alias("_chunks"))
    large = sizes.where(F.col("_chunks") > 1)
    dealt = counted.join(large, same_keys(counted, large, keys, "_"), "left")
    slot = F.coalesce(F.pmod(F.xxhash64(*entry), F.col("_chunks")), F.lit(0))
    dealt = dealt.select(*[counted[k] for k in keys], slot.alias("_slot"), F.struct(*[counted[e] for e in entry], "times").alias("_entry"))
    return dealt.groupBy(*keys, "_slot").agg(F.collect_list("_entry").alias(name)).drop("_slot")


def expanded(factors: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every combination of one entry of each bag in ``names``, as often as their counts multiply to.

    A missing or empty bag gives one combination with a null entry, as a left join does. Bags become single structs. Nothing
    is shuffled here.
    """
    for name in names:
        factors = factors.withColumn(name, F.explode_outer(name))
    copies = F.lit(1).cast("long")
    for name in names:
        copies = copies * F.coalesce(F.col(f"{name}.times"), F.lit(1))
    return factors.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop("_copy")
