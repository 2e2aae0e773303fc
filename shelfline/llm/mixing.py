"""Mixing sources to target weights: fixed-length blocks, drawn per output shard, found through index permutations.

The words of each source, its documents one after the other, are packed into blocks of ``BLOCK`` words; a source's last
block may be shorter. A source with target W takes its words in laps: each lap is a pseudorandom permutation of the indices
of its full blocks and ends with the short one, and the last slot of all takes only what is left of W. The slots of a source
are dealt over the output shards by a multinomial draw, first over groups of shards, then over the shards of a group. So
the counts of a shard, given its size, are a multinomial draw (without replacement) with the targets as weights, while every
source's total is its target exactly. Slot j of a source is block permutation(j) of lap j / blocks; slots and the pieces of
documents meet by (source, block).

Documents get their places by sums over range partitions, slots by sums inside the draw: no task sees a whole source.
All draws are keyed by seed, source and place, so reruns and repeated tasks agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import discard, stored
from shelfline.llm.words import mix

BLOCK = 256  # words
SHARD_SLOTS = 4096  # blocks an output shard holds on average
GROUP_SHARDS = 4096  # shards drawn at once
OUT_ROWS = 1 << 15  # slots sent to Spark at once
TASK_SLOTS = 1 << 17  # slots a task finds
MAX_TASKS = 100_000
WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
LIMIT = 2  # laps
SEED = 20_240_711
WORD = r"[^\x20\x09-\x0D]+"


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n - 1 chosen by ``key``, at each ``index``.

    A four-round Feistel network on the smallest even number of bits that holds n; values outside go round again.
    """
    half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (2**64 - 1)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    outside = np.flatnonzero(out >= np.uint64(n))
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def _key(seed: int, *parts: int) -> int:
    """64 bits from the seed and some numbers."""
    h = np.array([seed], dtype=np.int64).view(np.uint64)
    for p in parts:
        h = mix(h + np.array([p], dtype=np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return int(h[0])


def placed(docs: DataFrame) -> DataFrame:
    """Rows of ``docs(doc_id, source, size, rid, ...)`` with ``start``: the words of the source in the documents before it.

    Documents are ordered by doc_id and text hash; repeated rows are interchangeable, a running number spreads them. Range
    partitions sort their own rows; only one sum a partition and source is put in order, so no task holds a source. Stored.
    """
    order = ["source", "doc_id", "rid", "salt"]
    rows = docs.withColumn("salt", F.monotonically_increasing_id())
    sliced = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id()))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).select(F.col("source").alias("_source"), F.col("slice").alias("_slice"), "before")
    inside = Window.partitionBy("slice", "source").orderBy("doc_id", "rid", "salt").rowsBetween(Window.unboundedPreceding, -1)
    own = sliced.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = own.join(before, own["source"].eqNullSafe(before["_source"]) & (own["slice"] == before["_slice"]))
    out = stored(joined.select(*docs.columns, (F.col("before") + F.col("local")).alias("start")))
    discard(sliced)
    return out


def targets(docs: DataFrame) -> DataFrame:
    """(source, source_size, rank, target) of every source of ``docs(source, size)``.

    Sources by code point, null last, weigh ``WEIGHTS`` in turn and share ``SHARE`` of all words; a target stops at ``LIMIT``
    times its source's size, and what is over is shared again by weight until none is above. Stored.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = [F.col("source").asc_nulls_last()]
    sliced = stored(sizes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("slice", F.spark_partition_id()))
    counts = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = counts.select("slice", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("slice").orderBy(*by)) - 1
    ranked = sliced.withColumn("local", local).join(before, "slice").withColumn("rank", F.col("before") + F.col("local"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", "rank", weight.cast("double").alias("weight")))
    discard(sliced)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # What a unit of weight gets. A source that reaches its limit stays there, as the unit only grows.
    unit, capped = 0.0, -1
    over = lambda unit: F.col("weight") * F.lit(unit) > LIMIT * F.col("source_size")
    while True:
        limited = over(unit) if capped >= 0 else F.lit(False)
        n, used, weights = ranked.agg(F.count_if(limited), F.sum(F.when(limited, LIMIT * F.col("source_size")).otherwise(0)), F.sum(F.when(limited, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not weights:
            break
        capped, unit = n, (SHARE * total - used) / weights
    target = F.least(F.col("weight") * F.lit(unit), (LIMIT * F.col("source_size")).cast("double"))
    out = stored(ranked.select("source", "source_size", "rank", target.alias("target")))
    discard(ranked)
    return out


def _dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The multinomial draw of each row's ``slots`` over ``parts`` places, with the slot each place begins at; empty places are left out."""
    for batch in batches:
        for r in batch.itertuples(index=False):
            rng = np.random.Generator(np.random.Philox(key=_key(SEED, r.rank, r.low, r.parts)))
            if r.slots < r.parts:  # the same draw, slot by slot
                place, n = np.unique(rng.integers(0, r.parts, r.slots), return_counts=True)
            else:
                n = rng.multinomial(r.slots, np.full(r.parts, 1.0 / r.parts))
                place = np.flatnonzero(n)
                n = n[place]
            start = r.begin + np.concatenate([[0], np.cumsum(n)[:-1]])
            columns = {"rank": r.rank, "place": r.low + place, "begin": start, "n": n}
            yield pd.DataFrame(columns).astype("int64")


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The block and the words taken of each slot of rows (rank, source_size, words, shard, begin, n)."""
    for batch in batches:
        out, held = [], 0
        for r in batch.itertuples(index=False):
            full, short = divmod(r.source_size, BLOCK)
            lap_slots = full + (short > 0)
            for at in range(r.begin, r.begin + r.n, OUT_ROWS):
                slot = np.arange(at, min(at + OUT_ROWS, r.begin + r.n))
                lap, i = slot // lap_slots, slot % lap_slots
                block = np.full(len(slot), full)
                for k in np.unique(lap).tolist():
                    some = (lap == k) & (i < full)
                    block[some] = permuted(i[some], full, _key(SEED, r.rank, -1, k))
                before = lap * r.source_size + i * BLOCK
                take = np.minimum(np.where(i < full, BLOCK, short), r.words - before)
                out.append(np.stack([np.full_like(slot, r.rank), np.full_like(slot, r.shard), slot, block, take]))
                held += len(slot)
                if held >= OUT_ROWS:
                    yield pd.DataFrame(np.concatenate(out, axis=1).T, columns=["rank", "shard", "slot", "block", "take"])
                    out, held = [], 0
        if out:
            yield pd.DataFrame(np.concatenate(out, axis=1).T, columns=["rank", "shard", "slot", "block", "take"])


def slots(sources: DataFrame) -> DataFrame:
    """(rank, shard, slot, block, take): every slot of the mix, its source's block and how many of its first words it takes."""
    words = F.round("target").cast("long")
    laps, rest = F.expr("words div source_size"), F.expr("words % source_size")
    counted = sources.where("source_size > 0").withColumn("words", words)
    n = laps * F.ceil(F.col("source_size") / BLOCK) + F.ceil(rest / BLOCK)
    counted = counted.withColumn("slots", n).where("slots > 0").select("rank", "source_size", "words", "slots")
    total = counted.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // SHARD_SLOTS))
    groups = -(-shards // GROUP_SHARDS)
    out = "rank long, place long, begin long, n long"
    drawn = counted.select("rank", "slots", F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("low"), F.lit(groups).cast("long").alias("parts"))
    drawn = drawn.repartition("rank").mapInPandas(_dealt, out)
    each = -(-shards // groups)  # groups are equal, so there may be a few shards more
    inner = drawn.select("rank", F.col("n").alias("slots"), "begin", (F.col("place") * each).alias("low"), F.lit(each).cast("long").alias("parts"))
    cells = inner.repartition("rank", "low").mapInPandas(_dealt, out).withColumnRenamed("place", "shard")
    named = cells.join(counted.select("rank", "source_size", "words"), "rank").select("rank", "source_size", "words", "shard", "begin", "n")
    # A number given is kept at run time: cells are few rows, but make many slots.
    tasks = min(MAX_TASKS, max(1, -(-total // TASK_SLOTS)))
    return named.repartition(tasks, "rank", "shard").mapInPandas(_found, "rank long, shard long, slot long, block long, take long")


def _pieces(rows: DataFrame, *more: str) -> DataFrame:
    """Each document with words once a block it lies in: ``block``, and the words [low, high) of the block that are its own.

    ``more``: expressions on those three (as ``b``, ``low``, ``high``), computed a block, so that no text is copied a block.
    """
    blocks = f"sequence(start div {BLOCK}, (start + size - 1) div {BLOCK})"
    spans = f"transform({blocks}, b -> struct(b, greatest(0, start - b * {BLOCK}) as low, least({BLOCK}, start + size - b * {BLOCK}) as high))"
    inner = "".join(f", {x}" for x in more)
    spans = f"transform({spans}, x -> struct(x.b as block, x.low as low, x.high as high{inner}))"
    return rows.where("size > 0").withColumn("x", F.explode(F.expr(spans))).select(*(c for c in rows.columns if c != "words"), "x.*")


def _sized(docs: DataFrame, *keep: str) -> DataFrame:
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), F.xxhash64(text).alias("rid"), *keep)


def mixture(docs: DataFrame) -> DataFrame:
    """(shard, source, slot, text): the mix itself, a row a block taken, its words joined by one space.

    Words of several documents of a source meet in a block. ``slot`` numbers the blocks of a source. Documents without words
    are in no block; null is a source of its own; an empty table gives no rows.
    """
    rows = placed(_sized(docs, "text"))
    sources = targets(rows)
    named = sources.select(F.col("source").alias("_source"), "rank")
    rows = rows.join(named, rows["source"].eqNullSafe(named["_source"]))
    words = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"({WORD})"))
    own = f"slice(words, int(x.b * {BLOCK} + x.low - start + 1), int(x.high - x.low)) as own"
    pieces = _pieces(rows.select("rank", "source", "start", "size", words.alias("words")), own)
    blocks = pieces.groupBy("rank", "block").agg(F.first("source").alias("source"), F.sort_array(F.collect_list(F.struct("low", "own"))).alias("p"))
    text = F.array_join(F.expr("slice(flatten(transform(p, x -> x.own)), 1, int(take))"), " ")
    return slots(sources).hint("merge").join(blocks, ["rank", "block"]).select("shard", "source", "slot", text.alias("text"))


def taken(docs: DataFrame) -> DataFrame:
    """Result of the query, from the slots of the mix: doc_id, size, source_size, target, taken of every row of ``docs``.

    ``size``: words of the text (null: 0). ``taken``: words of the document in the mix, at most twice each. The words taken of
    a source are its target rounded to a whole word. Null is a source of its own, after all others. Rows with null doc_id
    take part; repeated rows are documents of their own. Sources without words have target 0. An empty table gives no rows.
    """
    rows = placed(stored(_sized(docs)))  # sizes are counted once, not again to find the ranges
    sources = targets(rows)
    named = sources.select(F.col("source").alias("_source"), "rank", "source_size", "target")
    rows = rows.join(named, rows["source"].eqNullSafe(named["_source"]))
    pieces = _pieces(rows.select("doc_id", "size", "source_size", "target", "rank", "start"))
    joined = pieces.join(slots(sources).select("rank", "block", "take").hint("merge"), ["rank", "block"], "left")
    words = F.greatest(F.lit(0), F.least("high", F.coalesce("take", F.lit(0))) - F.col("low"))
    # (rank, start) names a document that has words.
    with_words = joined.groupBy("rank", "start", "doc_id", "size", "source_size", "target").agg(F.sum(words).alias("taken"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return with_words.select(columns).unionAll(rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(columns))
