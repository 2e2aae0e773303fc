"""Joins and aggregates between dated rows and closed date ranges.

A range of days is joined through the days it covers, so every join here is an equality join that Spark can hash and
shuffle by key; no operator compares each row with each range.

Spark's size estimate does not see that expanding a range multiplies its rows. An expanded side is therefore broadcast
only by its real bytes at run time (``measured_side``); adaptive execution may split a merge join at hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.sizing import measured_side


def days_covered(ranges: DataFrame, start: str = "start_date", end: str = "end_date", day: str = "day") -> DataFrame:
    """One row per range and day it covers, both ends included; empty and open ranges cover none."""
    valid = ranges.where(F.col(start) <= F.col(end))
    return valid.withColumn(day, F.explode(F.sequence(F.col(start), F.col(end))))


def _range_days(ranges: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Days of the distinct ranges."""
    return measured_side(days_covered(ranges.select(*keys).distinct(), start, end, "_day"))


def interval_join(
    points: DataFrame,
    ranges: DataFrame,
    *,
    point: str,
    start: str = "start_date",
    end: str = "end_date",
    on: Mapping[str, str] | None = None,
    how: str = "inner",
    by: str = "day",
) -> DataFrame:
    """Join each point to the ranges that contain its date.

    ``on`` maps equality columns of ``points`` to those of ``ranges``; ``how`` is inner, left or left_anti. With
    ``by="day"`` a range is matched on each day it covers; ``by="month"`` matches on each month it touches and then
    compares dates, for ranges that run over years. Other column names of the two sides must differ.
    """
    on = dict(on or {})
    keyed = ranges.where(F.col(start) <= F.col(end))
    if by == "month":
        months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
        keyed = keyed.withColumns({"_slot": F.explode(months), "_from": F.col(start), "_to": F.col(end)})
        condition = (F.trunc(point, "month") == F.col("_slot")) & F.col(point).between(F.col("_from"), F.col("_to"))
        helpers = ["_slot", "_from", "_to"]
    else:
        keyed = days_covered(keyed, start, end, "_slot")
        condition = F.col(point) == F.col("_slot")
        helpers = ["_slot"]
    for position, (left, right) in enumerate(on.items()):
        keyed = keyed.withColumn(f"_on{position}", F.col(right))
        condition &= points[left] == F.col(f"_on{position}")
        helpers.append(f"_on{position}")
    if how == "left_anti":
        return points.join(measured_side(keyed.select(*helpers).distinct()), condition, how)
    shared = [name for name in on.values() if name in points.columns]
    return points.join(measured_side(keyed.drop(*shared)), condition, how).drop(*helpers)


def islands(ranges: DataFrame, keys: Sequence[str], start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The days that the ranges of each key cover, as the fewest ranges: (``keys``, ``start``, ``end``).

    Ranges that overlap or follow each other day on day become one. Equal ranges are merged first, so a key's work is
    limited by the calendar, however many rows it has. Empty and open ranges cover nothing.
    """
    valid = ranges.where(F.col(start) <= F.col(end)).groupBy(*keys, start).agg(F.max(end).alias(end))
    order = Window.partitionBy(*keys).orderBy(start)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col(start) <= F.date_add(reached, 1), 0).otherwise(1)
    numbered = valid.withColumn("_fresh", fresh).withColumn("_island", F.sum("_fresh").over(order))
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def split_by_ranges(
    ranges: DataFrame, key: str, on: Sequence[str] = (), start: str = "start_date", end: str = "end_date"
) -> tuple[DataFrame, DataFrame]:
    """Islands (key, ``on``, range) of the keys whose ranges come to exactly one, and of the keys with several."""
    columns = [*on, start, end]
    placed = islands(ranges.where(F.col(key).isNotNull()), [key, *on], start, end).select(key, *columns)
    counted = placed.groupBy(key).agg(F.count("*").alias("_ranges"), *[F.min(c).alias(c) for c in columns])
    single = counted.where(F.col("_ranges") == 1).drop("_ranges")
    several = placed.join(counted.where(F.col("_ranges") > 1).select(key), key)
    return single, several


def running_keys(
    ranges: DataFrame,
    key: str,
    *,
    on: Sequence[str],
    start: str = "start_date",
    end: str = "end_date",
    day: str = "day",
    name: str = "keys",
) -> DataFrame:
    """Exact distinct keys whose range covers each (``on``, day).

    A key's overlapping ranges become islands first. No day of a region lies in two islands of one key, so islands are
    counted, whatever their keys, before they are expanded into days.
    """
    placed = islands(ranges.where(F.col(key).isNotNull()), [key, *on], start, end)
    per_range = placed.groupBy(*on, start, end).agg(F.count("*").alias(name))
    return days_covered(per_range, start, end, day).groupBy(*on, day).agg(F.sum(name).alias(name))


def range_stats(
    ranges: DataFrame,
    daily: DataFrame,
    stats: Sequence[Column],
    *,
    day: str,
    on: Sequence[str] = (),
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Aggregate a daily table over each distinct range: one row per (``on``, ``start``, ``end``).

    Ranges are reduced to their distinct (key, start, end) first. However many promotions or campaigns there are,
    those are limited by the calendar, and so is what is expanded into days.
    """
    keys = [*on, start, end]
    days = _range_days(ranges, keys, start, end)
    per_day = daily.withColumnRenamed(day, "_day")
    return days.join(per_day, [*on, "_day"], "inner").groupBy(*keys).agg(*stats)


def range_visitors(
    ranges: DataFrame,
    visits: DataFrame,
    *,
    visitor: str,
    day: str,
    on: Sequence[str] = (),
    start: str = "start_date",
    end: str = "end_date",
    name: str = "visitors",
) -> DataFrame:
    """Exact distinct visitors within each distinct range, without pairing visitors with ranges.

    Of the days a visitor came within a range, all but the first have the previous visit within the range too. So the
    visitors are the visits of the range's days (one a visitor and day) less the visits whose previous one also lies
    within. Those are counted by previous day: for each day of the range, the visits up to the range's end that
    followed a visit on that day, read from a running sum. Rows grow with the days of the ranges and with the
    distinct (key, day, previous day), not with their product.
    """
    keys = [*on, start, end]
    daily = visits.select(*on, F.col(day).alias("_day"), visitor).where(F.col(visitor).isNotNull()).distinct()
    history = Window.partitionBy(*on, visitor).orderBy("_day")
    arrivals = (
        daily.withColumn("_previous", F.lag("_day").over(history))
        .groupBy(*on, "_day", "_previous")
        .agg(F.count("*").alias("_arrivals"))
    )
    days = _range_days(ranges, keys, start, end)
    per_day = arrivals.groupBy(*on, "_day").agg(F.sum("_arrivals").alias("_arrivals"))
    came = days.join(per_day, [*on, "_day"], "inner").groupBy(*keys).agg(F.sum("_arrivals").alias("_came"))

    bounds = {start, end}
    followed = arrivals.where(F.col("_previous").isNotNull()).select(
        *on, F.col("_previous").alias("_on"), F.col("_day").alias("_at"), "_arrivals", *(F.lit(None).cast("date").alias(c) for c in sorted(bounds))
    )
    asked = days.select(*on, F.col("_day").alias("_on"), F.col(end).alias("_at"), F.lit(0).cast("bigint").alias("_arrivals"), *sorted(bounds))
    # Visits on the last day count, as equal days share a frame.
    so_far = Window.partitionBy(*on, "_on").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    again = followed.unionByName(asked).withColumn("_again", F.sum("_arrivals").over(so_far)).where(F.col(start).isNotNull())
    again = again.groupBy(*keys).agg(F.sum("_again").alias("_again"))
    # Inner: every range of ``came`` asked for each of its days.
    return came.join(again, keys, "inner").select(*keys, (F.col("_came") - F.col("_again")).alias(name))
