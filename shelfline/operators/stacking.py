"""Stack one-row summaries and frames of different shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with the same columns."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def stack_ragged(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns differ; what a frame lacks is NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def summarise(df: DataFrame, labels: dict[str, str], **measures: Column) -> DataFrame:
    """One row: constant labels, then aggregates of the whole frame."""
    row = df.agg(*[column.alias(name) for name, column in measures.items()])
    return row.select(*[F.lit(text).alias(name) for name, text in labels.items()], *measures)


def unpivot_row(row: DataFrame, key: str, value: str, names: dict[str, str]) -> DataFrame:
    """Turn a one-row frame of measures into (key, value) rows; ``names`` maps column to key text."""
    pairs = [
        F.struct(F.lit(text).alias(key), F.col(column).cast("double").alias(value)) for column, text in names.items()
    ]
    return row.select(F.inline(F.array(*pairs)))
