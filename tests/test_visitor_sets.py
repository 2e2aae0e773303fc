"""Islands of ranges, and distinct visitors of unions of cells, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import visitor_sets
from shelfline.operators.intervals import days_covered, islands, running_keys, split_by_ranges

FIRST = dt.date(2024, 1, 1)


def ranges_of(pick, n, ids):
    out = []
    for _ in range(n):
        start = FIRST + dt.timedelta(pick.randrange(60))
        out.append((pick.choice(ids), pick.choice(["N", "S", None]), start, start + dt.timedelta(pick.randrange(-1, 9))))
    return out + out[:5] + [("open", "N", None, FIRST), ("open", "N", FIRST, None)]


SCHEMA = "id string, region string, start_date date, end_date date"


def days(start, end):
    return {start + dt.timedelta(i) for i in range((end - start).days + 1)} if start and end else set()


@pytest.mark.parametrize("seed", [1, 2])
def test_islands_cover_the_same_days_in_the_fewest_ranges(spark, seed):
    rows = ranges_of(random.Random(seed), 80, ["a", "b", "c", None])
    want = {}
    for k, region, start, end in rows:
        want.setdefault((k, region), set()).update(days(start, end))
    got, starts = {}, {}
    for r in islands(spark.createDataFrame(rows, SCHEMA), ["id", "region"]).collect():
        covered = got.setdefault((r.id, r.region), set())
        assert not covered & days(r.start_date, r.end_date)
        covered |= days(r.start_date, r.end_date)
        starts.setdefault((r.id, r.region), []).append(r.start_date)
    assert got == {k: v for k, v in want.items() if v}
    for k, found in starts.items():
        assert all(s - dt.timedelta(1) not in got[k] for s in found)


def test_touching_ranges_of_one_key_are_one(spark):
    rows = [("a", "N", FIRST, FIRST + dt.timedelta(2)), ("a", "N", FIRST + dt.timedelta(3), FIRST + dt.timedelta(4)), ("b", "N", FIRST, FIRST), ("b", "S", FIRST, FIRST)]
    single, several = split_by_ranges(spark.createDataFrame(rows, SCHEMA), "id", ["region"])
    assert [(r.id, r.end_date) for r in single.collect()] == [("a", FIRST + dt.timedelta(4))]
    assert {r.id for r in several.collect()} == {"b"}


def test_running_keys_count_a_key_once_a_day(spark):
    rows = ranges_of(random.Random(4), 60, ["a", "b", "c", None])
    table = spark.createDataFrame(rows, SCHEMA)
    want = days_covered(table).where("id is not null").groupBy("region", "day").agg(F.count_distinct("id").alias("keys"))
    got = running_keys(table, "id", on=["region"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("codes", [3, 30_000])
def test_sets_count_distinct_visitors_of_any_union(spark, monkeypatch, codes):
    """A dictionary in one part and in many, NULL visitors and keys, repeated visits."""
    monkeypatch.setattr(visitor_sets, "CODES", codes)
    pick = random.Random(9)
    rows = [(pick.choice(["N", "S", None]), FIRST + dt.timedelta(pick.randrange(40)), pick.choice([f"v{pick.randrange(60)}", None])) for _ in range(900)]
    visits = spark.createDataFrame(rows, "region string, day date, visitor string")
    sets = visitor_sets.visitor_sets(visits, ["region", "day"], "visitor")
    month = F.trunc("day", "month")
    for keys, columns in ((["region", "day"], ["region", "day"]), (["region"], ["region"]), (["month"], [month.alias("month")])):
        kept = sets.withColumn("month", month)
        got = {tuple(r) for r in visitor_sets.set_sizes(kept, keys, "n").collect()}
        want = {tuple(r) for r in visits.groupBy(*columns).agg(F.count_distinct("visitor").alias("n")).where("n > 0").collect()}
        assert got == want
