"""Exact top-k inner products by vector-approximation files.

Every vector is kept as one small cell number a dimension. Scanning the cells gives a lower and an upper bound of each
score; whatever cannot reach a query's k-th best lower bound is dropped. The exact vectors of the rest are read in order
of their bounds: first the most promising ones, then, once the k-th exact score is known, only those whose upper bound
still reaches it. Nothing that could be in the answer is left out.

Equal vectors are scanned once and carry the k + 1 smallest ids, which is all that can ever be returned of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored

K = 10
CELLS = 64  # cells a dimension
BLOCK = 4096  # vectors a block
QUERIES = 256  # queries a block
FIRST_READ = 32  # exact vectors read a query before the k-th score is known
SCALE = 1024
LARGEST = 2.0**60
EXACT = 2.0**53  # integers up to here are exact as doubles


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): integer components floor(1024 x); rows with null vectors, null or non-finite components or null id go.

    So do rows whose integer components have a sum of squares above ``LARGEST``: within it no inner product of two vectors,
    and no sum on the way to one, leaves the range of a long.
    """
    x = F.col(column)
    good = x.isNotNull() & F.col("vec_id").isNotNull() & (F.size(x) > 0)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    squares = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.pow(F.rint(c.cast("double") * SCALE), F.lit(2.0)))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return vectors.where(good).where(~bad).where(squares <= LARGEST).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of vectors of one length: the numbers and the ids as bytes."""
    waiting: dict[int, list] = {}

    def pack(dims: int) -> pd.DataFrame:
        ids, rows = zip(*waiting.pop(dims), strict=True)
        data = np.array(rows, dtype="<i8")
        return pd.DataFrame({"dims": [dims], "ids": [np.array(ids, dtype="<i8").tobytes()], "data": [data.tobytes()]})

    for batch in batches:
        size = int(batch["block"].iloc[0]) if len(batch) else 0
        for i, v in zip(batch["id"], batch["v"], strict=True):
            part = waiting.setdefault(len(v), [])
            part.append((i, v))
            if len(part) == size:
                yield pack(len(v))
    for dims in list(waiting):
        yield pack(dims)


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    rows = rows.select("id", "v", F.lit(block).alias("block"))
    return rows.mapInPandas(_packed, "dims int, ids binary, data binary")


def _approximate(lows: dict[int, np.ndarray], steps: dict[int, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for dims, ids, data in zip(batch["dims"], batch["ids"], batch["data"], strict=True):
                v = np.frombuffer(data, dtype="<i8").reshape(-1, dims)
                cells = ((v - lows[dims]) // steps[dims]).clip(0, CELLS - 1).astype(np.uint8)
                out.append((dims, ids, cells.tobytes()))
            yield pd.DataFrame(out, columns=["dims", "ids", "cells"])

    return run


def _scan(lows: dict[int, np.ndarray], steps: dict[int, np.ndarray], k: int):
    """Candidates of each pair of a query block and a cell block: (query, id, low, high)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[bytes, np.ndarray] = {}  # k + 1 best lower bounds so far of each query of a block
        for batch in batches:
            for dims, q_ids, q_data, ids, raw in zip(*(batch[c] for c in ("dims", "q_ids", "q_data", "ids", "cells")), strict=True):
                query = np.frombuffer(q_data, dtype="<i8").reshape(-1, dims).astype(np.float64)
                cells = np.frombuffer(raw, dtype=np.uint8).reshape(-1, dims).astype(np.int64)
                floor = (lows[dims] + cells * steps[dims]).astype(np.float64)
                width = steps[dims].astype(np.float64) - 1
                plus, minus = np.maximum(query, 0), np.minimum(query, 0)
                base = query @ floor.T
                low, high = base + (minus @ width)[:, None], base + (plus @ width)[:, None]
                most = np.abs(floor) + width
                if np.abs(query).sum(axis=1).max() * most.max() >= EXACT:  # sums are rounded: give the bounds that much more room
                    slack = (np.abs(query) @ most.T) * ((2 * dims + 8) / EXACT) + 1
                    low, high = np.floor(low - slack), np.ceil(high + slack)
                top = min(k + 1, low.shape[1])
                new = np.partition(low, low.shape[1] - top, axis=1)[:, -top:]
                if len(best) > 64:
                    best.clear()
                if q_ids in best:
                    new = np.concatenate([best[q_ids], new], axis=1)
                    new = np.partition(new, max(0, new.shape[1] - k - 1), axis=1)[:, -(k + 1) :]
                best[q_ids] = new
                least = new.min(axis=1) if new.shape[1] == k + 1 else np.full(len(query), -np.inf)
                at, to = np.nonzero(high >= least[:, None])
                yield pd.DataFrame(
                    {
                        "query": np.frombuffer(q_ids, dtype="<i8")[at],
                        "id": np.frombuffer(ids, dtype="<i8")[to],
                        "low": low[at, to].astype(np.int64),
                        "high": high[at, to].astype(np.int64),
                    }
                )

    return run


def top_k(vectors: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query with the other rows.

    Queries: usable rows whose vec_id is divisible by ``every``. Ties go to the smaller vec_id; fewer candidates give
    fewer rows; vectors of another length are no candidates. Every row counts: repeated rows give repeated results, an id with
    several vectors is scored by each and, as a query, asks with each; its results are one list. No usable vector: no rows.
    """
    rows = usable(vectors).groupBy("vec_id", "v").agg(F.least(F.lit(k), F.count(F.lit(1))).cast("int").alias("times"))
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    distinct = stored(ranked.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "times"))).alias("ids"), F.min("vec_id").alias("id")))
    # An id can have several vectors: number the distinct vectors by themselves.
    distinct = stored(distinct.select(F.monotonically_increasing_id().alias("id"), "v", "ids"))
    spread = {
        r["dims"]: (r["low"], r["high"])
        for r in distinct.select(F.size("v").alias("dims"), F.posexplode("v").alias("d", "x"))
        .groupBy("dims", "d")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"))
        .groupBy("dims")
        .agg(F.sort_array(F.collect_list(F.struct("d", "low"))).alias("low"), F.sort_array(F.collect_list(F.struct("d", "high"))).alias("high"))
        .collect()
    }
    lows = {n: np.array([x["low"] for x in low], dtype=np.int64) for n, (low, _) in spread.items()}
    highs = {n: np.array([x["high"] for x in high], dtype=np.int64) for n, (_, high) in spread.items()}
    steps = {n: (highs[n] - lows[n]) // CELLS + 1 for n in lows}

    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", F.col("times").alias("asks"))
    asked = stored(asked.select(F.monotonically_increasing_id().alias("query"), "query_id", "v", "asks"))
    files = _blocks(distinct, BLOCK).mapInPandas(_approximate(lows, steps), "dims int, ids binary, cells binary")
    files = stored(files)
    blocks = _blocks(asked.withColumnRenamed("query", "id"), QUERIES).select("dims", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    blocks = stored(blocks)
    # The stated queries against all rows, block by block; both sides are read from files, nothing is shuffled.
    pairs = blocks.withColumnRenamed("dims", "q_dims").crossJoin(files).where("q_dims = dims").drop("q_dims")
    found = stored(pairs.mapInPandas(_scan(lows, steps, k), "query long, id long, low long, high long"))

    best = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("low")))).where(F.col("n") == k + 1)
    certain = found.join(best.select("query", F.col("low").alias("least")), "query", "left")
    certain = certain.where("least is null or high >= least").select("query", "id", "high")
    certain = stored(certain.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("high"), "id"))))

    def exact(wanted: DataFrame) -> DataFrame:
        """(query, query_id, vec_id, score, times), at most k + 1 ids of a vector, without the query's own rows."""
        both = wanted.join(distinct.select("id", F.col("v").alias("x"), "ids"), "id").join(asked, "query")
        score = F.aggregate(F.zip_with("v", "x", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        out = both.select("query", "query_id", score.alias("score"), "asks", F.explode("ids").alias("c"))
        return out.where("c.vec_id <> query_id").select("query", "query_id", "c.vec_id", "score", (F.col("c.times") * F.col("asks")).alias("times"))

    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    first = stored(exact(certain.where(F.col("n") <= FIRST_READ)))
    reached = first.withColumn("n", F.row_number().over(by_score)).where(F.col("n") == k).select("query", F.col("score").alias("least"))
    later = certain.where(F.col("n") > FIRST_READ).join(reached, "query", "left").where("least is null or high >= least")
    scored = first.union(exact(later.select("query", "id")))
    # An id that asks several times gets one list; only its k best pairs can matter, however often they count.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    few = scored.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    each = few.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(k), "times"))))
    out = each.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
