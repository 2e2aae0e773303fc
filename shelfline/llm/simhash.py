"""Near-duplicate groups by SimHash and anchor-point covering.

Two fingerprints that differ in at most 3 of 64 bits differ in at most one bit of one 32-bit half. In a half the anchors
are the words of a perfect code: bits 1-31 hold a Hamming code (covering radius 1), bit 0 is free. Each fingerprint has
one home anchor within the radius and visits every anchor within radius + 1, so a pair that close in the half meets at
the home anchor of each of the two. Per anchor, homes are compared with visitors on all 64 bits.

Distinct fingerprints take part once, whatever the number of their copies. Anchors with many rows are dealt into tiles
of bounded size (home chunk x visitor chunk); each tile returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import components, discard, identified, rows_of, stored

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, as a signed integer: bit b is set if over half of the shingle hashes have it. No words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    runs = zip(*(words[k:] for k in range(shingle)), strict=False) if len(words) >= shingle else [words]
    join, digest = b" ".join, xxhash.xxh64_intdigest
    ones, count, part = np.zeros(64, dtype=np.int64), 0, []

    def add(part: list[int]) -> None:
        ones[:] += np.unpackbits(np.array(part, dtype=np.uint64).view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)

    for run in runs:
        part.append(digest(join(run), SEED))
        if len(part) == 50_000:
            add(part)
            count, part = count + len(part), []
    if part:
        add(part)
        count += len(part)
    return int(np.packbits(ones * 2 > count).view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, rid, fp) of every row; text null or without words: fp 0."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return identified(docs).select("doc_id", "rid", of("text").alias("fp"))


def _anchor_rows(fps: DataFrame) -> DataFrame:
    """(anchor, fp, home): 2 homes and at most 34 visits a fingerprint. Needs ``fp`` to be distinct."""
    half = fps.select(
        "fp",
        F.explode(F.expr("array(struct(0L as h, fp & 4294967295L as x), struct(1L as h, shiftrightunsigned(fp, 32) as x))")).alias("s"),
    ).select("fp", "s.h", "s.x")
    # Syndrome: the exclusive or of the numbers of the set bits among bits 1-31.
    masks = [sum(1 << i for i in range(1, 32) if i >> j & 1) for j in range(5)]
    syndrome = " + ".join(f"{1 << j} * (bit_count(x & {m}L) % 2)" for j, m in enumerate(masks))
    half = half.withColumn("s", F.expr(f"cast({syndrome} as int)"))
    half = half.withColumn("near", F.expr("if(s = 0, x, x ^ shiftleft(1L, s))"))
    far = """if(s = 0, array(x), concat(array(near),
        transform(filter(sequence(1, 31), a -> a < (a ^ s)), a -> x ^ shiftleft(1L, a) ^ shiftleft(1L, a ^ s))))"""
    half = half.withColumn("visits", F.expr(f"concat({far}, array(near ^ 1L))"))
    key = "shiftleft(h, 40) | v"
    return half.select("fp", "h", "near", F.explode("visits").alias("v")).select(
        F.expr(key).alias("anchor"), "fp", (F.col("v") == F.col("near")).alias("home")
    )


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning links of each tile. Rows come sorted by anchor and tile; a tile holds at most a few thousand rows."""
    held: pd.DataFrame | None = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        last = (rows["anchor"] == rows["anchor"].iloc[-1]) & (rows["tile"] == rows["tile"].iloc[-1])
        held = rows[last]
        yield _spanning(rows[~last])
    if held is not None and len(held):
        yield _spanning(held)


def _spanning(rows: pd.DataFrame) -> pd.DataFrame:
    fp = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
    home = rows["home"].to_numpy().astype(bool)
    anchor, tile = rows["anchor"].to_numpy(), rows["tile"].to_numpy()
    n = len(fp)
    new = np.ones(n, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (tile[1:] != tile[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, n))
    left = np.repeat(begin + size, size)  # first row after the run
    at = np.flatnonzero(left - np.arange(n) > 1)
    found, lag = [], 1
    while len(at):
        other = at + lag
        near = np.bitwise_count(fp[at] ^ fp[other]) <= RADIUS
        near &= home[at] | home[other]
        if near.any():
            found.append(np.stack([at[near], other[near]]))
        lag += 1
        at = at[left[at] - at > lag]
    if not found:
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    pair = np.concatenate(found, axis=1)
    label = np.arange(n)
    while True:  # smallest row of each component
        low = np.minimum(label[pair[0]], label[pair[1]])
        before = label.copy()
        np.minimum.at(label, pair[0], low)
        np.minimum.at(label, pair[1], low)
        label = label[label]
        if (label == before).all():
            break
    far = np.flatnonzero(label != np.arange(n))
    signed = fp.view(np.int64)
    return pd.DataFrame({"a": signed[far], "b": signed[label[far]]})


def links(fps: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``fp`` at most 3 bits apart."""
    rows = _anchor_rows(fps.repartition("fp"))  # few small files make many rows
    sizes = rows.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("visitors"))
    large = stored(sizes.where(F.col("visitors") > tile))
    rows = rows.join(large, "anchor", "left")
    chunk = "pmod(xxhash64(fp, {salt}), {n})"
    homes, visits = f"ceil(homes / {tile})", f"ceil(visitors / {tile})"
    plain = "array(0L)"
    many_home = f"transform(sequence(0L, {visits} - 1), j -> {chunk.format(salt=1, n=homes)} * {visits} + j)"
    many_visit = f"transform(sequence(0L, {homes} - 1), i -> i * {visits} + {chunk.format(salt=2, n=visits)})"
    tiles = F.expr(f"if(visitors is null, {plain}, if(home, array_distinct(concat({many_home}, {many_visit})), {many_visit}))")
    dealt = rows.select("anchor", "fp", "home", F.explode(tiles).alias("tile"))
    dealt = dealt.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile")
    return dealt.mapInPandas(_links, "a long, b long").distinct()


def near_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, rid, fp, part, component_id) of every row of ``docs(doc_id, text)``.

    component_id: smallest doc_id reachable over links of at most 3 bits. ``part`` names the group, ids or not. Null or empty
    text: fingerprint 0, linked like any other. Null doc_id: takes part through its fingerprint, but is never a component_id
    unless no document of the group has an id (then null). Repeated rows give repeated rows. ``rid`` is a hash of the text.
    Other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = links(nodes.select("fp"))
    # Components over the fingerprints, then the smallest id of each component.
    parts = stored(components(joined))
    linked = nodes.join(parts, nodes["fp"] == parts["node"]).select("fp", "first", "component")
    lowest = linked.groupBy("component").agg(F.min("first").alias("low"))
    named = linked.join(lowest, "component").select("fp", "component", "low")
    part, low = F.coalesce("component", "fp").alias("part"), F.coalesce("low", "first").alias("component_id")
    names = stored(nodes.join(named, "fp", "left").select("fp", part, low))
    discard(nodes, parts)
    return prints.join(names, "fp").select("doc_id", "rid", "fp", "part", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Result of the query: doc_id, fingerprint (16 hex digits), component_id."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_groups(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all columns: the one with the smallest doc_id.

    Groups are those of the query. Rows without an id come after all others, by a hash of their text; of rows that repeat an
    id in one group the one with the smallest hash stays, once. An empty table gives none.
    """
    groups = stored(near_groups(docs).select("doc_id", "rid", "part"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid")
    kept = groups.groupBy("part").agg(F.min(place).alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.rid").alias("_rid"))
    rows = groups.groupBy("doc_id", "rid").agg(F.count(F.lit(1)).alias("n"))
    same = rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["rid"] == kept["_rid"])
    gone = stored(rows.join(kept, same, "left_anti").select("doc_id", "rid"))
    again = stored(rows.where("n > 1").join(kept, same, "left_semi").select("doc_id", "rid"))
    left = rows_of(docs, gone, "left_anti")
    if again.isEmpty():
        return left
    repeated = rows_of(left, again, "left_semi")
    key, rid = "_one_of_each_id", "_one_of_each_rid"
    repeated = repeated.withColumns({key: repeated["doc_id"].cast("long"), rid: F.xxhash64(repeated["text"].cast("string"))})
    return rows_of(left, again, "left_anti").unionAll(repeated.dropDuplicates([key, rid]).drop(key, rid))
