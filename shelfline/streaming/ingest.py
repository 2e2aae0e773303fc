"""Incremental loading of landing files: each file is loaded once, however often the load is run.

This is the file-tracking half of a bulk load command. Spark keeps the list of loaded files in the checkpoint folder,
so a rerun, or a retry after a failure, picks up only what is new.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.sources import files, schemas


def checkpoint_folder(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """Folder shared by the cluster for load progress; ``fallback`` serves sessions that name none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not base:
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return f"{base.rstrip('/')}/{name}"


def _load_name(table: str, landing: str, target: str) -> str:
    """One progress record per landing folder and target."""
    pair = hashlib.sha256(f"{landing}\n{target}".encode()).hexdigest()[:16]
    return f"load_{table}_{pair}"


def load_new_files(
    spark: SparkSession, table: str, landing: str, target: str, checkpoints: str | None = None
) -> StreamingQuery:
    """Append the not yet loaded files of ``landing`` to the Parquet folder ``target`` and stop.

    Records that do not fit keep their text in ``_bad``; ``files.accepted`` and ``files.rejects`` tell them apart. A folder
    of such targets, one named after each table, opens with ``Lakehouse.from_loaded``.
    """
    if table in schemas.CSV_SCHEMAS:
        reader = spark.readStream.schema(files.text_schema(schemas.CSV_SCHEMAS[table]))
        rows = files.parsed(reader.options(**files.csv_options(table)).csv(landing), table)
    elif table in schemas.RAW_LINE_TABLES:
        rows = spark.readStream.schema("raw_line string").options(**files.RAW_LINE_OPTIONS).csv(landing)
        rows = rows.withColumn(files.BAD, F.lit(None).cast("string"))
    else:
        whole = schemas.JSON_LAYOUT[table] != "lines"
        rows = files.json_documents(spark.readStream.text(landing, wholetext=whole))
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint_folder(spark, _load_name(table, landing, target), checkpoints))
        .trigger(availableNow=True)
        .start()
    )
