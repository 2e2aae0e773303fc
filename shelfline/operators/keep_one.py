"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order: Sequence[Column], ties: Sequence[str] | None = None) -> DataFrame:
    """First row of each key in the given order; ``ties`` and then a hash of all other columns break ties so reruns agree.

    Without ``ties``, all columns break ties one after the other. With them, only these and the hash have to reach the
    sort: columns that the rest of a query does not use stay out of the shuffle. Spark prunes to one row per key within each
    input partition before it shuffles, so a key repeated many times costs its task one row per partition.
    """
    others = [name for name in df.columns if name != key]
    if ties is None:
        hashed, last = df, others
    else:
        hashed, last = df.withColumn("_hash", F.xxhash64(*(name for name in others if name not in ties))), [*ties, "_hash"]
    window = Window.partitionBy(key).orderBy(*order, *(F.col(name).asc_nulls_last() for name in last))
    return hashed.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).select(*df.columns)
