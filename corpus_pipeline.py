"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again for the next one.

Stages with a table besides documents read it from the same folder. Filters keep the columns of documents; the last stage
returns the segmentation of each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import decontamination, line_runs, resampling, simhash, subword
from shelfline.llm.common import ship, stored, table
from shelfline.llm.queries import vocabulary

#: Rows sent to a Python worker at once. Texts are a few kilobytes, some far longer; workers keep what their largest batch took.
BATCH_ROWS = 1000


def _ready(spark: SparkSession) -> None:
    """Send the package to the executors and bound what a Python worker holds."""
    ship(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    _ready(spark)
    return resampling.selected(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated lines and line runs; those of which no word is left go, unless they had none."""
    _ready(spark)
    left = line_runs.without_copies(docs)
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return left.select(*((n_chars if c == "n_chars" else F.col(f"`{c}`")).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    _ready(spark)
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _ready(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document, and whether they decode to it."""
    _ready(spark)
    return subword.segmentations(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("segmentation", segmentation),
]

#: SQL can't express the seeded draw, SimHash or merge dropout; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
