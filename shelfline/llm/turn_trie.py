"""Prefix trie of conversations by union-find over sorted-neighbour common prefixes.

A conversation is its sequence of turns, each turn named by 128 bits of hash. Equal sequences are one leaf with a count, so
that copies of a conversation are summed before anything is sorted. Leaves are range-partitioned and sorted by sequence. In
a partition, each pair of neighbours is an edge whose depth is their longest common prefix. Edges are taken in descending
depth: the two components an edge joins share that many turns and no more with each other, so the merge makes a branching
node there, or adds to one of that depth. Turns between two such nodes are unary nodes and need no union.

Only nodes on the paths of a partition's first and last leaf can have members in other partitions. Each such path node
carries its totals, and apart from them what hangs off the paths, contracted to three numbers. Merged by their prefix, path
nodes that no second partition has are final; of the others (at most the shared prefix of two neighbours a boundary) the
contracted numbers are added up in descending depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import discard, stored

EMPTY = hashlib.sha256(b"").hexdigest()
SHARED_TURNS = 9  # the query takes fewer turns than this from another conversation
SHARED_GROUP = 5

_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_PATH = ["key", "parent_key", "c_children", "c_leaves", "c_saved", "size"]
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_ROWS = f"{_NODE}, key string, parent_key string, c_children long, c_leaves long, c_saved long, size long"


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, t) of every conversation, ``t`` its turns as structs (a, b, n): two hashes and the UTF-8 bytes of the text.

    Turns are ordered by ``turn``, null first; of equal ``turn`` by their hashes (copies of a row are interchangeable). Null
    role or text is empty. Rows without conv_id belong to no conversation. Other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(7), text, role).alias("b"), F.octet_length(text).cast("long").alias("n"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("x")).where("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x")).selectExpr("conv_id", "transform(x, x -> struct(x.a, x.b, x.n)) as t")


def rebuilt(found: DataFrame) -> DataFrame:
    """The conversations of the query: the first h turns of conversation c - c % 5, then c's own after its first h."""
    found = found.selectExpr("conv_id", "t", f"int(crc32(cast(cast(conv_id as string) as binary)) % {SHARED_TURNS}) as h", f"conv_id - conv_id % {SHARED_GROUP} as base")
    heads = found.where("conv_id = base").selectExpr("conv_id as base", f"slice(t, 1, {SHARED_TURNS - 1}) as head")
    joined = found.join(heads, "base", "left")
    return joined.selectExpr("conv_id", "concat(slice(coalesce(head, slice(t, 1, 0)), 1, h), slice(t, h + 1, greatest(size(t) - h, 0))) as t")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The ids of consecutive rows of one sequence as one string."""
    for batch in batches:
        grouped = batch.groupby(["k1", "k2"], sort=False)["conv_id"]
        yield grouped.agg(low="min", ids=lambda x: ",".join(map(str, x.tolist()))).reset_index()[["k1", "k2", "low", "ids"]]


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the ids of each sequence; a sequence's pieces come one after the other and are never held together."""
    now, h = None, None
    for batch in batches:
        out = []
        for k1, k2, ids in zip(batch["k1"].tolist(), batch["k2"].tolist(), batch["ids"], strict=True):
            if (k1, k2) != now:
                if now is not None:
                    out.append((*now, h.hexdigest()))
                now, h = (k1, k2), hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids.encode())
        yield pd.DataFrame(out, columns=["k1", "k2", "ends"])
    if now is not None:
        yield pd.DataFrame([(*now, h.hexdigest())], columns=["k1", "k2", "ends"])


def _leaves(found: DataFrame) -> DataFrame:
    """(seq, sizes, n, low, ends) of every distinct sequence: its hashes, text sizes, conversations, smallest id and digest of ids."""
    groups = found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.first("t").alias("t"))
    ids = found.select("k1", "k2", "conv_id").repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    pieces = ids.mapInPandas(_pieces, "k1 long, k2 long, low long, ids string")
    pieces = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "low")
    ends = pieces.mapInPandas(_digests, "k1 long, k2 long, ends string")
    joined = groups.join(ends, ["k1", "k2"])
    return joined.selectExpr("flatten(transform(t, x -> array(x.a, x.b))) as seq", "transform(t, x -> x.n) as sizes", "n", "low", "ends")


class _Forest:
    """Branching nodes of one partition's sorted leaves. Node i < m is the leaf i; later ones come from merges."""

    def __init__(self, seqs: list[np.ndarray], n: list[int], low: list[int]):
        m = len(seqs)
        self.depth = [len(s) // 2 for s in seqs]
        self.first, self.last = list(range(m)), list(range(m))
        self.n, self.low = list(n), list(low)
        self.children: list[list[int]] = [[] for _ in range(m)]
        common = np.zeros(m, dtype=np.int64)
        for i in range(1, m):
            x, y = seqs[i - 1], seqs[i]
            k = min(len(x), len(y))
            differ = np.flatnonzero(x[:k] != y[:k])
            common[i] = (int(differ[0]) if len(differ) else k) // 2
        up, top = list(range(m)), list(range(m))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for i in (np.argsort(-common[1:], kind="stable") + 1).tolist():
            left, right = find(i - 1), find(i)
            node = self._merged(top[left], top[right], int(common[i]))
            up[right] = left
            top[left] = node
        self.top = top[find(0)]

    def _merged(self, x: int, y: int, depth: int) -> int:
        if self.depth[x] > depth:  # the merge of two components makes a branching node
            self.depth.append(depth)
            self.first.append(self.first[x])
            self.last.append(self.last[x])
            self.n.append(self.n[x])
            self.low.append(self.low[x])
            self.children.append([x])
            x = len(self.depth) - 1
        self.children[x].append(y)
        self.last[x] = self.last[y]
        self.n[x] += self.n[y]
        self.low[x] = min(self.low[x], self.low[y])
        return x


def _prefix_keys(seq: np.ndarray) -> list[str]:
    """A name for each prefix, the empty one first."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.hexdigest()]
    for i in range(0, len(seq), 2):
        h.update(seq[i : i + 2].tobytes())
        out.append(h.hexdigest())
    return out


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All nodes of one partition; those on the paths of its first and last leaf have a ``key``."""
    rows = list(batches)
    if not rows:
        return
    rows = pd.concat(rows, ignore_index=True)
    m = len(rows)
    seqs, ends = [np.asarray(x, dtype=np.int64) for x in rows["seq"]], rows["ends"].tolist()
    sizes = [np.concatenate([[0], np.asarray(x, dtype=np.int64)]).astype(np.int64) for x in rows["sizes"]]
    f = _Forest(seqs, rows["n"].tolist(), rows["low"].tolist())
    paths = (_prefix_keys(seqs[0]), _prefix_keys(seqs[-1]))

    def path(v: int) -> list[str] | None:
        """The names along the path that node ``v`` lies on, if any."""
        return paths[0] if f.first[v] == 0 else paths[1] if f.last[v] == m - 1 else None

    parent = [-1] * len(f.depth)
    for v, children in enumerate(f.children):
        for c in children:
            parent[c] = v
    leaves, saved = [0] * len(f.depth), [0] * len(f.depth)  # saved: at the top of the edge above the node
    out: list[tuple] = []
    for v in sorted(range(len(f.depth)), key=lambda v: -f.depth[v]):
        children, u, names = f.children[v], parent[v], path(v)
        leaves[v] = sum(leaves[c] for c in children) or 1
        below = sum(saved[c] for c in children)
        high = f.depth[u] if u >= 0 else -1
        own = (f.n[v] - 1) * sizes[f.first[v]][high + 1 : f.depth[v] + 1]
        totals = below + np.cumsum(own[::-1])[::-1]  # of each node from the top of the edge to v
        saved[v] = int(totals[0])
        off = [c for c in children if path(c) is None]
        for d in range(high + 1, f.depth[v] + 1):
            last = d == f.depth[v]
            over = f.low[u] if d == high + 1 and u >= 0 else f.low[v]
            row = (f.low[v], d, over if d else None, f.n[v], len(children) if last else 1, leaves[v], int(totals[d - high - 1]))
            end = ends[v] if last and v < m else EMPTY
            if names is None:
                above = path(u)
                out.append((*row, end, None, above[d - 1] if d == high + 1 and above is not None else None, None, None, None, None))
            else:
                hung = (len(off), sum(leaves[c] for c in off), sum(saved[c] for c in off)) if last else (0, 0, 0)
                out.append((*row, end, names[d], names[d - 1] if d else None, *hung, int(sizes[f.first[v]][d])))
    columns = _COLUMNS + _PATH
    for at in range(0, len(out), 20_000):
        frame = pd.DataFrame(out[at : at + 20_000], columns=columns)
        numbers = [c for c in columns if c not in ("ends_sha256", "key", "parent_key")]
        yield frame.astype({c: "Int64" for c in numbers})


def _accumulated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Totals of the path nodes that several partitions have, from what hangs off them, in descending depth."""
    rows = list(batches)
    if not rows:
        return
    nodes = pd.concat(rows, ignore_index=True).sort_values("depth", ascending=False)
    extra: dict[str, list[int]] = {}
    low = dict(zip(nodes["key"], nodes["conv_id"], strict=True))
    out = []
    for r in nodes.itertuples(index=False):
        children, leaves, saved = extra.get(r.key, [0, 0, 0])
        children += r.c_children
        leaves = leaves + r.c_leaves or 1
        saved += r.c_saved + (r.n_convs - 1) * r.size
        over = extra.setdefault(r.parent_key, [0, 0, 0])
        for i, x in enumerate((1, leaves, saved)):
            over[i] += x
        out.append((r.conv_id, r.depth, low.get(r.parent_key), r.n_convs, children, leaves, saved, r.ends_sha256, r.key))
    frame = pd.DataFrame(out, columns=[*_COLUMNS, "key"])
    yield frame.astype({c: "Int64" for c in _COLUMNS if c != "ends_sha256"})


def prefix_trie(found: DataFrame) -> DataFrame:
    """Every node of the trie of ``found(conv_id, t)`` (see ``sequences``), the textless root included.

    Per node: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves
    (childless nodes in its subtree), saved_tokens (over its subtree, (n_convs - 1) times the bytes of the node's last text),
    ends_sha256 (of the ascending comma-joined ids of the conversations that end there). No conversations: no rows.
    A conversation's turns travel as one row of 24 bytes a turn; the ids of one sequence, however many, pass through one task
    as joined strings and are not held there, since SHA-256 is sequential.
    """
    named = stored(found.select("conv_id", "t", F.xxhash64("t").alias("k1"), F.xxhash64(F.lit(7), "t").alias("k2")))
    nodes = stored(_leaves(named).repartitionByRange("seq").sortWithinPartitions("seq").mapInPandas(_forest, _ROWS))
    discard(named)
    paths = nodes.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.min("ends_sha256").alias("low_end"),
        F.max("ends_sha256").alias("high_end"),
        *(F.max(c).alias(c) for c in ("depth", "parent_key", "parent_conv_id", "n_children", "n_leaves", "saved_tokens", "size")),
        *(F.sum(c).alias(c) for c in ("c_children", "c_leaves", "c_saved")),
    )
    # Only one partition has the leaf itself; the others say that nothing ends there.
    paths = stored(paths.withColumn("ends_sha256", F.when(F.col("low_end") == EMPTY, F.col("high_end")).otherwise(F.col("low_end"))))
    single = paths.where("partitions = 1")
    hung = single.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("s"), F.sum("n_leaves").alias("s_leaves"), F.sum("saved_tokens").alias("s_saved"))
    several = paths.where("partitions > 1").join(hung, "key", "left")
    several = several.selectExpr(
        "conv_id", "depth", "n_convs", "ends_sha256", "key", "parent_key", "size", "c_children + coalesce(s, 0) as c_children", "c_leaves + coalesce(s_leaves, 0) as c_leaves", "c_saved + coalesce(s_saved, 0) as c_saved"
    )
    shared = stored(several.coalesce(1).mapInPandas(_accumulated, f"{_NODE}, key string"))
    low = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("lowest"))
    rest = nodes.where("key is null").select(*_COLUMNS, "parent_key").unionAll(single.select(*_COLUMNS, "parent_key"))
    rest = rest.join(low, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("lowest", "parent_conv_id"))
    return rest.select(*_COLUMNS).unionAll(shared.select(*_COLUMNS))
