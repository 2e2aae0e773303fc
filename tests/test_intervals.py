import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators.intervals import interval_join, range_stats, range_visitors, running_keys

FIRST = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(7)
    points = [
        (i, rng.choice(["N", "S", None]), FIRST + dt.timedelta(rng.randrange(120)), f"v{rng.randrange(25)}")
        for i in range(400)
    ] + [(1000 + i, "N", FIRST + dt.timedelta(40), "v1") for i in range(200)]
    ranges = []
    for i in range(60):
        start = FIRST + dt.timedelta(rng.randrange(-20, 130))
        ranges.append((f"k{i % 40}", rng.choice(["N", "S", None]), start, start + dt.timedelta(rng.randrange(-2, 45))))
    ranges.append(("open", "N", FIRST, None))
    p = spark.createDataFrame(points, "id int, region string, day date, visitor string")
    r = spark.createDataFrame(ranges, "key string, zone string, start_date date, end_date date")
    return p.cache(), r.cache()


def naive(points, ranges, how, keyed):
    condition = points.day.between(ranges.start_date, ranges.end_date)
    if keyed:
        condition &= points.region == ranges.zone
    return points.join(ranges, condition, how)


def same(left, right):
    columns = sorted(right.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("by", ["day", "month"])
@pytest.mark.parametrize("keyed", [True, False])
def test_interval_join_equals_between(frames, how, by, keyed):
    points, ranges = frames
    on = {"region": "zone"} if keyed else None
    assert same(interval_join(points, ranges, point="day", on=on, how=how, by=by), naive(points, ranges, how, keyed))


def test_both_ends_match(spark):
    points = spark.createDataFrame([(FIRST,), (FIRST + dt.timedelta(2),), (FIRST + dt.timedelta(3),)], "day date")
    ranges = spark.createDataFrame([(FIRST, FIRST + dt.timedelta(2))], "start_date date, end_date date")
    assert interval_join(points, ranges, point="day").count() == 2


def test_no_nested_loops(frames):
    points, ranges = frames
    for how in ("inner", "left", "left_anti"):
        joined = interval_join(points, ranges, point="day", how=how)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_stats_and_visitors(frames):
    points, ranges = frames
    zoned = ranges.withColumnRenamed("zone", "region")
    daily = points.groupBy("region", "day").agg(F.count("*").alias("n"))
    key = ["region", "start_date", "end_date"]
    stats = range_stats(zoned, daily, [F.sum("n").alias("n")], day="day", on=["region"])
    visitors = range_visitors(zoned, points, visitor="visitor", day="day", on=["region"])
    distinct = ranges.select("zone", "start_date", "end_date").distinct()
    want = (
        naive(points, distinct, "inner", True)
        .groupBy(F.col("zone").alias("region"), "start_date", "end_date")
        .agg(F.count("*").alias("n"), F.count_distinct("visitor").alias("visitors"))
    )
    assert same(stats, want.select(*key, "n"))
    assert same(visitors, want.select(*key, "visitors"))


def test_running_keys_counts_overlapping_ranges_once(frames, spark):
    _, ranges = frames
    zoned = ranges.withColumnRenamed("zone", "region")
    days = spark.range(200).select(F.date_add(F.lit(FIRST), (F.col("id") - 30).cast("int")).alias("day"))
    want = (
        days.join(zoned, days.day.between(zoned.start_date, zoned.end_date))
        .groupBy("region", "day")
        .agg(F.count_distinct("key").alias("keys"))
    )
    got = running_keys(zoned, "key", on=["region"])
    assert same(got, want)
