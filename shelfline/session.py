"""Spark session settings the pipeline relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app_name: str = "shelfline", master: str | None = None, **settings: str) -> SparkSession:
    """Return a session with the settings below; on a cluster, leave ``master`` unset and let spark-submit decide.

    Shuffle partitions start high and adaptive execution merges the small ones, so one setting serves small and
    large inputs. Skewed joins are split at run time. PySpark's record of the line that
    made each expression is off: it costs calls into the JVM for every one while a plan is built.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def local_session(cores: int | str | None = None, app_name: str = "shelfline-local") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return build_session(
        app_name,
        master=f"local[{cores}]",
        spark__sql__shuffle__partitions=str(cores),
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
