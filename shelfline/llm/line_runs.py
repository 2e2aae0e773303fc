"""Removal of repeated runs of lines by a suffix array over line numbers.

Every distinct line gets a number, and each document is the sequence of its line numbers. Suffixes (a document from one of
its lines on) are ranked by prefix doubling: the rank by the first h lines and the rank of the suffix h lines further give
the rank by the first 2h lines. Each round groups suffixes with equal pairs into an interval of the suffix array; its place
is the number of suffixes before it, from a range-partitioned sort of the distinct pairs with running sums. Suffixes that
stand alone in their interval repeat nothing and drop out, so rounds shrink to the repeated part.

At depth m the intervals are exactly the intervals of the suffix array whose longest common prefix is m lines or more: the
suffixes of one share at least m lines, and those of different ones do not. Deeper intervals are nested in them and delete
no other lines, so doubling stops there. In an interval the suffix of the first position (doc_id, line) is the original;
the first m lines of the others are later copies. Overlapping copies join into maximal repeated runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import discard, stored

MIN_LINES = 2
WORD = r"[^\x20\x09-\x0D]"


def _identified(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_rid", F.xxhash64(text)).withColumn("_text", text)


def _placed(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``place``: the number of suffixes in all groups before, in the order of ``keys``. ``groups`` has a count ``n``.

    Range partitions sort their own groups and sum their counts; only one sum a partition is put in order, so no task
    sees all groups.
    """
    sliced = groups.repartitionByRange(*keys).withColumn("slice", F.spark_partition_id())
    sliced = stored(sliced.sortWithinPartitions(*keys))
    inside = Window.partitionBy("slice").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy("slice").agg(F.sum("n").alias("n"))  # one row a partition
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = sliced.withColumn("local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return ranked.join(F.broadcast(before.select("slice", "before")), "slice").withColumn("place", F.col("before") + F.col("local"))


def _intervals(suffixes: DataFrame, keys: list[str], *carried: str) -> DataFrame:
    """Suffixes that share their ``keys`` with others: (doc, rid, line, rank, first), first being their first position."""
    groups = suffixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "rid", "line")).alias("first"))
    repeated = _placed(groups.where("n > 1"), keys)
    found = suffixes.join(repeated.select(*keys, "place", "first"), keys)
    return stored(found.select("doc", "rid", "line", F.col("place").alias("rank"), "first", *carried))


def _ahead(suffixes: DataFrame, step: int) -> DataFrame:
    """Add ``next``: the rank of the suffix ``step`` lines further in the same document; without one, the suffix drops out.

    A suffix without a ranked one there does not repeat that far (or ends before).
    """
    further = suffixes.select("doc", "rid", (F.col("line") - step).alias("line"), F.col("rank").alias("next"))
    return suffixes.select("doc", "rid", "line", "rank").join(further, ["doc", "rid", "line"])


def repeated_windows(docs: DataFrame, depth: int = MIN_LINES) -> DataFrame:
    """(doc, rid, line, rank, first): all suffixes that share their first ``depth`` lines with another one.

    Copies of a row (equal doc_id and text) count once. ``rank`` orders the intervals of the suffix array.
    """
    return _windows(docs, depth)[1]


def _windows(docs: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """The repeated windows of one line, with ``word`` (whether the line holds one), and those of ``depth`` lines."""
    rows = _identified(docs).where("_id is not null and _text is not null")
    lines = rows.select(F.col("_id").alias("doc"), F.col("_rid").alias("rid"), F.posexplode(F.split("_text", "\n")).alias("line", "s"))
    # 128 bits name a line; texts are not shuffled.
    names = (F.xxhash64("s").alias("a"), F.xxhash64(F.lit(7), "s", F.length("s")).alias("b"))
    suffixes = lines.select("doc", "rid", "line", *names, F.col("s").rlike(WORD).alias("word"))
    suffixes = stored(suffixes.dropDuplicates(["doc", "rid", "line"]))
    single = _intervals(suffixes, ["a", "b"], "word")
    found, have = single, 1
    discard(suffixes)
    while have < depth:
        step = min(have, depth - have)
        found, have = _intervals(_ahead(found, step), ["rank", "next"]), have + step
    return single, found


def repeated_runs(docs: DataFrame, depth: int = MIN_LINES, singles: bool = False) -> DataFrame:
    """(doc, rid, start, length): the maximal runs of lines that are later copies of runs of at least ``depth`` lines.

    ``singles``: later copies of one line that holds a word, too.
    """
    single, found = _windows(docs, depth)
    later = "first <> struct(doc, rid, line)"
    copies = found.where(later).select("doc", "rid", "line", (F.col("line") + depth).alias("end"))
    if singles:
        more = single.where(later).where("word").select("doc", "rid", "line", (F.col("line") + 1).alias("end"))
        copies = copies.unionAll(more).groupBy("doc", "rid", "line").agg(F.max("end").alias("end"))
    # Windows of one document; the next one joins if it starts before the end of all before, or there.
    order = Window.partitionBy("doc", "rid").orderBy("line")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("line") <= before, 0).otherwise(1)
    runs = copies.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    runs = runs.groupBy("doc", "rid", "run").agg(F.min("line").alias("start"), (F.max("end") - F.min("line")).alias("length"))
    return runs.select("doc", "rid", "start", "length")


def marked(docs: DataFrame, depth: int = MIN_LINES, singles: bool = False) -> DataFrame:
    """(row, left, n_lines, n_removed): each row of ``docs`` as a struct, the text left of it, its lines and those deleted.

    Lines end at line feeds and are compared exactly. Documents are ordered by doc_id; of rows with the same doc_id and
    different texts the order is that of a hash of the text. Null text: no lines, stays null. Empty text: one empty line,
    which alone is no run. Null doc_id: the row is kept whole and is no source. Repeated rows are treated alike. Fewer
    than ``depth`` lines: kept whole, but for ``singles``: later copies of one line that holds a word go, too.
    """
    rows = _identified(docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), "doc_id", "text"))
    runs = repeated_runs(docs.select("doc_id", "text"), depth, singles)
    spans = runs.groupBy("doc", "rid").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"))
    joined = rows.join(spans, (F.col("_id") == F.col("doc")) & (F.col("_rid") == F.col("rid")), "left")
    lines = joined.withColumn("lines", F.split("_text", "\n"))
    gone = F.expr("aggregate(spans, 0, (n, s) -> n + s.length)")
    # Lines between the runs: from the end of one to the start of the next.
    left = F.expr(
        """flatten(zip_with(
             concat(array(0), transform(spans, s -> s.start + s.length)),
             concat(transform(spans, s -> s.start), array(size(lines))),
             (a, b) -> slice(lines, a + 1, b - a)))"""
    )
    text = F.when(F.col("spans").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long")
    return lines.select("row", text.alias("left"), n_lines.alias("n_lines"), F.coalesce(gone, F.lit(0)).cast("long").alias("n_removed"))


def without_copies(docs: DataFrame, depth: int = MIN_LINES) -> DataFrame:
    """``docs`` with later copies of repeated lines deleted from ``text``, all its columns kept.

    Single lines that hold a word, and runs of at least ``depth`` lines, blank ones included. Rows of which a line was
    deleted and no word is left go.
    """
    out = marked(docs, depth, singles=True).where((F.col("n_removed") == 0) | F.col("left").rlike(WORD))
    return out.select(*(F.col("left").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def line_dedup(docs: DataFrame) -> DataFrame:
    """Result of the query: doc_id, n_lines, n_removed, kept_sha256 of the text that is left (null text: as empty).

    Later copies of single lines that hold a word go, and of runs of two lines or more, blank ones included.
    """
    out = marked(docs.select("doc_id", "text"), singles=True)
    return out.select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.coalesce("left", F.lit("")), 256).alias("kept_sha256")
    )
