"""Helpers the operators share: tables in the shared folder, column checks, connected components."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session, else one set here (local runs only)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shelfline-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def _place(spark: SparkSession, path: str):
    """The file system of ``path``, and the path, as the JVM has them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors.

    A table that nobody discards is deleted when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, place = _place(spark, path)
    files.deleteOnExit(place)
    # Shuffle files go when the driver's JVM collects what refers to them; a small idle driver may not do so for long.
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing reads any more."""
    for df in tables:
        files, place = _place(df.sparkSession, df.stored_at)
        files.delete(place, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        if os.path.isdir(package):
            archive = os.path.join(tempfile.mkdtemp(prefix="shelfline-"), "shelfline_package")
            context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, text): the columns operators work on. ``rid``, a hash of the text, tells repeated ids apart."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("rid"), text.alias("text"))


def rows_of(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (``left_semi``) or without (``left_anti``) their (doc_id, rid) in ``keys``; nulls match nulls."""
    text = docs["text"].cast("string")
    return docs.join(keys, docs["doc_id"].cast("long").eqNullSafe(keys["doc_id"]) & (F.xxhash64(text) == keys["rid"]), how)


def sample_of(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    """The ``k`` rows with the smallest hashes of ``keys``, or all if there are fewer.

    Rows are counted first, so that only about k of them, from all partitions together, are put in order. Where many rows
    share keys, there may be fewer than k.
    """
    share = min(1.0, (1.2 * k + 100) / max(1, rows.count()))
    h = F.shiftrightunsigned(F.xxhash64(*keys), 1)
    return rows.where(h <= min(2**63 - 1, int(share * 2**63))).orderBy(h, *keys).limit(k)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (node, component) for each node with an edge.

    ``component`` is the smallest node that can be reached. Large-star and small-star rounds: each is two joins on a
    node with its smallest neighbour, so a node with very many neighbours is one aggregated row against rows that
    adaptive execution can split. Stops when a round changes nothing.
    """
    ordered = edges.where("a is not null and b is not null and a <> b")
    e = stored(ordered.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    seen = None
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stored(large)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        small = least.select("hi", F.col("m").alias("lo")).union(
            joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        after = stored(small.distinct())
        sums = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        discard(e, large)
        e = after
        if tuple(sums) == seen:
            break
        seen = tuple(sums)
    roots = e.select(F.col("lo").alias("node")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
