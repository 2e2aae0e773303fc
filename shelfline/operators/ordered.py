"""Order statistics over a whole table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets a doubling of the value is cut into. Doubles span 2,098 doublings either side of zero, so however many rows
# there are, the bucket totals are a table of fewer than 300,000 rows.
PER_DOUBLING = 64
LARGEST = 1 << 18


def _bucket(value: str) -> Column:
    """A number that does not fall as ``value`` rises: its logarithm cut into steps of about one percent, with its sign.

    It depends on nothing but the value, so every part of a plan puts a value into the same bucket. NaN, then NULL sort last.
    """
    at = F.col(value).cast("double")
    size = F.floor(F.least(F.log2(F.abs(at)) * PER_DOUBLING, F.lit(1025.0 * PER_DOUBLING))) + 1076 * PER_DOUBLING
    finite = F.when(at == 0, 0).when(at > 0, size).otherwise(-size)
    return F.when(at.isNull(), LARGEST + 1).when(F.isnan(at), LARGEST).otherwise(finite)


def running_counts(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with their row count, the rows sorting before them and all rows: (value, rows, below, total).

    NULL sorts last. Equal rows are merged first, so a common value is one row. Values fall into buckets of their own order;
    the bucket totals, a table of bounded size, give each bucket its start, and values are accumulated inside buckets.
    """
    counts = df.groupBy(value).agg(F.count("*").alias("rows")).withColumn("_bucket", _bucket(value))
    totals = counts.groupBy("_bucket").agg(F.sum("rows").alias("_rows"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_bucket",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_start") + F.coalesce(F.sum("rows").over(inside), F.lit(0))
    return counts.join(F.broadcast(starts), "_bucket").select(value, "rows", below.alias("below"), "total", "_start", "_rows")


def exact_median(df: DataFrame, value: str, name: str = "median") -> DataFrame:
    """Exact interpolated median of a column as a one-row table."""
    counts = running_counts(df.where(F.col(value).isNotNull()), value)
    # Zero-based positions of the one or two middle rows.
    lower, upper = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)

    def holds(position: Column) -> Column:
        return (F.col("below") <= position) & (position < F.col("below") + F.col("rows"))

    # Only the buckets that hold a middle row are sorted.
    near = (F.col("_start") <= upper) & (lower < F.col("_start") + F.col("_rows"))
    middle = counts.where(near).where(holds(lower) | holds(upper))
    at = F.col(value).cast("double")
    return middle.agg(((F.min(at) + F.max(at)) / 2).alias(name))


def rank_by(df: DataFrame, value: str, name: str) -> DataFrame:
    """RANK over the whole table by ``value`` descending, NULLs first.

    The rank is 1 plus the rows with greater values, so it is worked out per distinct value and joined back: rows of a
    value that a third of the table has would meet in one task of a window, while a join is split there.
    """
    place = F.col("total") - F.col("below") - F.col("rows") + 1
    ranks = running_counts(df, value).select(F.col(value).alias("_value"), place.alias(name))
    return df.join(ranks, df[value].eqNullSafe(ranks["_value"])).drop("_value")


def top_rows(df: DataFrame, order: Sequence[Column], count: int) -> DataFrame:
    """First ``count`` rows in a total order (end ``order`` with a key so the cut is repeatable)."""
    return df.orderBy(*order).limit(count)
