"""Quality classifier by importance resampling.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets. Three bags of buckets are counted: the raw text
(every document), the target (labelled good and not toxic) and the labelled toxic text. A document's log importance weight
is its mean log ratio per n-gram of the target model to the raw model; a second ratio, target to toxic, counts only n-grams
that speak clearly for the toxic model. Both are set to zero at the quantile ``LOST`` of target documents held out from
the fit, and the lower one counts. ``k`` documents are drawn without replacement in proportion to
exp(weight / temperature), by Gumbel top-k: the k largest sums of weight / temperature and Gumbel noise, the noise keyed
by seed, doc_id and text. Unless given, k is the number of documents with a weight of zero or more. A text without a
letter or digit has no weight and is never drawn.

The models of the target and of toxic text are fitted on at most ``LABELLED`` labelled rows, those with the smallest hashes
of their ids. Raw counts, weights, the number kept and the k-th largest key cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import identified, rows_of, sample_of, stored
from shelfline.llm.words import Words, chunks, grams

BUCKETS = 1 << 20
SLICE = 1 << 14
LABELLED = 16_384
HELD_OUT = 0.25
LOST = 0.005
CLEAR = -2.0
TEMPERATURE = 0.05
SEED = 20
WORD = r"[\p{L}\p{N}]"
_REPEAT = np.uint64(12345)  # bucket key of a word that follows itself


def features(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word and every pair of neighbouring words."""
    words = Words(part)
    h = words.hashes()
    pair = np.where(h[1:] == h[:-1], _REPEAT, grams(h, 2, seed=5)) if len(h) > 1 else h[:0]
    inside = words.doc[1:] == words.doc[:-1]
    bucket = np.concatenate([h, pair[inside]]) % np.uint64(BUCKETS)
    return np.concatenate([words.doc, words.doc[1:][inside]]), bucket.astype(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of an input partition by slices of buckets, for raw, target (1) and toxic (2) text."""
    raw = np.zeros(BUCKETS, dtype=np.int64)
    sample: dict[int, list[np.ndarray]] = {1: [], 2: []}
    for batch in batches:
        kinds = batch["kind"].to_numpy()
        for at, part in chunks(list(batch["text"])):
            doc, bucket = features(part)
            raw += np.bincount(bucket, minlength=BUCKETS)
            for k, found in sample.items():
                own = bucket[kinds[at + doc] == k]
                if len(own):
                    found.append(own)
    bags = {0: raw} | {k: np.bincount(np.concatenate(v), minlength=BUCKETS) for k, v in sample.items() if v}
    for kind, counts in bags.items():
        parts = counts.reshape(-1, SLICE)
        full = np.flatnonzero(parts.any(axis=1))
        if len(full):
            yield pd.DataFrame({"kind": kind, "slice": full, "counts": [parts[i].astype("<i8").tobytes() for i in full]})


def _add(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(SLICE, dtype=np.int64)
    for batch in batches:
        for counts in batch["counts"]:
            total += np.frombuffer(counts, dtype="<i8")
    yield pd.DataFrame({"kind": [key[0]], "slice": [key[1]], "counts": [total.tobytes()]})


def labelled_kinds(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """(doc_id, kind, held): at most ``limit`` labelled documents. kind 1: good and not toxic, 2: toxic, 0: else.

    A document with several labels is good if all say so and toxic if one does. Rows without doc_id or quality are left out.
    """
    one = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    one = one.agg(F.min("quality").alias("quality"), F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic"))
    kind = F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 1).otherwise(0)
    held = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1000)) < int(1000 * HELD_OUT)
    return sample_of(one.select("doc_id", kind.alias("kind"), held.alias("held")), limit, "doc_id")


def ratios(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio of each bucket: target to raw, and target to toxic. ``docs(text, kind)``: kind null if not in the sample."""
    counted = docs.select("text", F.coalesce("kind", F.lit(0)).alias("kind")).mapInPandas(_count, "kind int, slice int, counts binary")
    rows = counted.groupBy("kind", "slice").applyInPandas(_add, "kind int, slice int, counts binary").toLocalIterator()
    bags = np.zeros((3, BUCKETS), dtype=np.float64)  # 24 MB, whatever the input
    for r in rows:
        bags[r["kind"], r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], dtype="<i8")
    raw, target, toxic = bags
    return _ratio(target, raw), -_ratio(toxic, target)


def _ratio(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """log((own + 1) / (other + 1)), the other model at the size of the own one. Zero if one is empty."""
    if not own.sum() or not other.sum():
        return np.zeros(len(own), dtype=np.float32)
    return np.log((own + 1) / (other * (own.sum() / other.sum()) + 1)).astype(np.float32)


def weighted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, rid, kind, held, worded, good, clean): both mean log ratios of every document, and whether it holds a letter or digit."""
    spark = docs.sparkSession
    sample = F.broadcast(stored(labelled_kinds(labels)))  # LABELLED rows of 17 bytes at most
    rows = identified(docs)
    fit = rows.select("doc_id", "text").join(sample.where("not held"), "doc_id", "left")
    first, second = ratios(fit)
    shared = spark.sparkContext.broadcast((first, np.where(second < CLEAR, second, 0).astype(np.float32)))

    @F.pandas_udf("good double, clean double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = np.zeros((2, len(texts)))
            for at, part in chunks(list(texts)):
                doc, bucket = features(part)
                n = np.maximum(np.bincount(doc, minlength=len(part)), 1)
                for row, weights in zip(out, shared.value, strict=True):
                    row[at : at + len(part)] = np.bincount(doc, weights=weights[bucket], minlength=len(part)) / n
            yield pd.DataFrame({"good": out[0], "clean": out[1]})

    return rows.withColumn("s", score("text")).join(sample, "doc_id", "left").select(
        "doc_id", "rid", "kind", "held", F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("worded"), F.col("s.good").alias("good"), F.col("s.clean").alias("clean")
    )


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, by counting ever finer ranges; None if there are fewer than k or k < 1.

    Four passes over ``rows``, each counting 65,536 ranges at most: no sort, and only counts reach the driver.
    """
    if k < 1:
        return None
    left, prefix, rest = k, None, rows.select(F.col(column).cast("long").bitwiseXOR(F.lit(-(1 << 63))).alias("x"))
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned("x", shift).bitwiseAND(F.lit(0xFFFF))
        level = rest if prefix is None else rest.where(F.shiftrightunsigned("x", shift + 16) == prefix)
        counts = level.groupBy(digit.alias("digit")).count().collect()
        for r in sorted(counts, key=lambda r: -r["digit"]):
            if left <= r["count"]:
                prefix = ((prefix or 0) << 16) | r["digit"]
                break
            left -= r["count"]
        else:
            return None
    value = prefix ^ (1 << 63)
    return value - (1 << 64) if value >= 1 << 63 else value


def gumbel(seed: Column, *keys: str) -> Column:
    """Standard Gumbel noise, -log(-log u), with u uniform in (0, 1) from 52 bits of a hash of seed and keys."""
    uniform = (F.shiftrightunsigned(F.xxhash64(seed, *keys), 12).cast("double") + 0.5) / F.lit(2.0**52)
    return -F.log(-F.log(uniform))


def draw(rows: DataFrame, k: int | float | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Add ``kept`` to ``rows(doc_id, rid, weight)``: a Gumbel top-k draw in proportion to exp(weight / temperature).

    ``k``: a number of rows, a share of them (a float up to 1), or None for as many as weigh zero or more. Rows without
    weight are never drawn and don't count. Rows equal in weight, doc_id and rid share a key, and ties at the k-th key
    all stay. More than there are: all stay. None to draw: none stay.
    """
    key = F.floor((F.col("weight") / temperature + gumbel(F.lit(seed), "doc_id", "rid")) * F.lit(2.0**40)).cast("long")
    keyed = stored(rows.withColumn("key", key))
    n, heavy = keyed.agg(F.count("key"), F.count_if(F.col("weight") >= 0)).first()
    size = heavy if k is None else min(n, round(k * n) if isinstance(k, float) else k)
    least = kth_largest(keyed.where("key is not null"), "key", size)
    kept = F.coalesce(F.col("key") >= least, F.lit(False)) if least is not None else F.lit(False)
    return keyed.withColumn("kept", kept).drop("key")


def resample(
    docs: DataFrame, labels: DataFrame, k: int | float | None = None, temperature: float = TEMPERATURE, seed: int = SEED
) -> DataFrame:
    """(doc_id, rid, weight, kept) of every row of ``docs(doc_id, text)``; ``labels(doc_id, quality, toxic)``.

    Null or empty text, or one without a letter or digit: weight null, not kept. Null doc_id: weighed like any other. Rows
    that repeat doc_id and text get equal keys and are kept or rejected together. No usable labels: there is nothing to
    tell rows apart, all weights are zero. ``rid`` is a hash of the text. Other columns are ignored. ``k``,
    ``temperature``, ``seed``: see ``draw``.
    """
    rows = stored(weighted(docs, labels))
    cut = rows.where("held and kind = 1").agg(
        F.percentile("good", F.lit(LOST)), F.percentile("clean", F.lit(LOST)), F.stddev_pop("good"), F.stddev_pop("clean")
    ).first()
    parts = []
    for name, low, spread in (("good", cut[0], cut[2]), ("clean", cut[1], cut[3])):
        parts.append((F.col(name) - F.lit(float(low or 0))) / F.lit(float(spread or 0) or 1.0))
    weight = F.when(F.col("worded"), F.least(*parts)) if cut[0] is not None else F.lit(0.0)
    return draw(rows.select("doc_id", "rid", weight.alias("weight")), k, temperature, seed)


def selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Null ids match null ids; repeated rows stay together; see ``resample``."""
    kept = stored(resample(docs, labels).where("kept").select("doc_id", "rid").distinct())
    return rows_of(docs, kept, "left_semi")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Result of the query: doc_id, weight (six digits; null without a letter or digit), kept."""
    return resample(docs, labels).select("doc_id", F.round("weight", 6).alias("weight"), "kept")
