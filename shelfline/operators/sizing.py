"""Let the real size of a join side decide, not an estimate."""

from __future__ import annotations

from pyspark.sql import DataFrame

STATIC = "spark.sql.autoBroadcastJoinThreshold"


def measured_side(side: DataFrame) -> DataFrame:
    """A join side whose size Spark cannot estimate, such as expanded ranges (each counts as one row in the estimate).

    The side carries a merge hint, as an estimate that is too low could broadcast far too much; adaptive execution splits the
    join at hot keys. In a session that plans no broadcast from estimates (a negative static threshold, a positive adaptive
    one) nothing is marked: the side's real bytes then decide at run time. No job runs while the plan is built.
    """
    threshold = side.sparkSession.conf.get(STATIC).lower().removesuffix("b")
    return side if threshold.startswith("-") else side.hint("merge")
