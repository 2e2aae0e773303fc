"""Column helpers for warehouse semantics that differ from Spark's defaults."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,0)"


def date_lit(day: dt.date) -> Column:
    return F.lit(day).cast("date")


def without_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def lenient_number(text: Column) -> Column:
    """Parse text as a whole number, rounding half up; NULL where it is not a number."""
    return text.try_cast(MONEY)


def lenient_id(text: Column) -> Column:
    """Parse free text as an identifier; NULL where it is not one."""
    return text.try_cast("decimal(38,0)").try_cast("bigint")


def lenient_date(text: Column) -> Column:
    """Parse a full ISO date; NULL for partial or impossible dates."""
    return F.try_to_date(text, "yyyy-MM-dd")


def years_between(start: Column, end: Column) -> Column:
    """Calendar-year boundaries crossed, not full years elapsed."""
    return F.year(end) - F.year(start)


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero as decimal arithmetic would, so binary noise cannot tip a tie."""
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")


def half_up_double(value: Column, digits: int) -> Column:
    """``half_up`` of a double column, with the same results; only values near a tie or very large go through decimals.

    Those take a microsecond each, as Spark prints a double to make a decimal of it. Elsewhere scaling, which is off by less
    than 0.002 below 10^13, cannot reach the other side of a tie 0.01 away.
    """
    scale = float(10**digits)
    scaled = value * scale
    near = F.rint(scaled)
    clear = (F.abs(scaled) < 1e13) & (F.abs(scaled - near) < 0.49)
    # Through bigint, as decimals have no negative zero.
    return F.when(clear, near.cast("bigint") / scale).otherwise(half_up(value, digits))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` in double; NULL when ``bottom`` is 0 or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column, digits: int = 2) -> Column:
    return half_up(ratio(top.cast("double") * 100, bottom), digits)


def mean(column: Column) -> Column:
    return F.avg(column.cast("double"))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def leading_word(text: Column) -> Column:
    """First run of ASCII letters; NULL when there is none."""
    return F.regexp_substr(text, F.lit("([A-Za-z]+)"))
