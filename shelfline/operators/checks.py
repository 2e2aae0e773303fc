"""Data tests: how many records break a rule, and the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdict texts.
PASS = "✅ PASS"
FAIL = "❌ FAIL - "


def verdicts(counts: DataFrame, tests: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per test from a one-row frame of failure counts.

    ``tests`` maps the count column to (test name, what is reported after the count).
    """
    rows = []
    for column, (name, complaint) in tests.items():
        failed = F.coalesce(F.col(column), F.lit(0)).cast("bigint")
        rows.append(
            F.struct(
                F.lit(name).alias("test_name"),
                failed.alias("failed_records"),
                verdict(failed, complaint).alias("test_result"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def verdict(failed: Column, complaint: str) -> Column:
    return F.when(failed == 0, PASS).otherwise(F.concat(F.lit(FAIL), failed.cast("string"), F.lit(f" {complaint}")))
