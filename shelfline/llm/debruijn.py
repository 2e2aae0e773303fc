"""Removal of repeated word passages by de Bruijn compaction.

The k-mers (k consecutive words) of all documents are the edges of a graph whose nodes are runs of k - 1 words. Of each
k-mer the smallest hash among its ``MINIMIZER``-word runs is its minimizer; equal k-mers have equal minimizers. The
neighbouring edges of a document with one minimizer form a path piece. Pieces whose minimizer only one document has cannot
repeat and are dropped before any edge is made.

Pieces that are equal as a whole compact: one join gives every copy the source coordinate (document, position) of the
first. A path that branches inside a piece makes unequal pieces with one minimizer; these fall apart into their edges,
which are joined in the same way, each with its own first source coordinate. Pieces and edges of a document then
compact into spans where their positions and their source positions advance together, which verifies long repeats. The
words under spans whose source document has a smaller id are removed.

Pieces and edges are named by their minimizer's 64 bits of hash and 64 or 48 more of their own; a document is its doc_id and a hash of its text, so repeated ids with
different texts stay apart. A document's own rows are never gathered beyond the document's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import discard, stored
from shelfline.llm.words import Words, chunks, grams, stretches

K = 13
MINIMIZER = 4
_EDGE = 6  # bytes of an edge's own hash


def _minimizers(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, minimizer position, hash of the run at each position) of all windows inside one text."""
    h = words.hashes()
    n = len(h)
    runs = grams(h, MINIMIZER)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), runs
    span = k - MINIMIZER + 1
    best, at = runs[: n - k + 1].copy(), np.arange(n - k + 1)
    for j in range(1, span):
        other = runs[j : j + n - k + 1]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    window = np.flatnonzero(words.doc[: n - k + 1] == words.doc[k - 1 :])
    return window, at[window], runs


def _selected(k: int):
    """(h, doc_id, rid, pos) of the minimizers of each document; pos counts words from the document's first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, rids = batch["doc_id"].to_numpy(), batch["rid"].to_numpy()
            for at, part in chunks(list(batch["text"])):
                words = Words(part)
                _, places, runs = _minimizers(words, k)
                places = np.unique(places)
                doc = words.doc[places]
                yield pd.DataFrame(
                    {"h": runs[places].view(np.int64), "doc_id": ids[at + doc], "rid": rids[at + doc], "pos": (places - words.first[doc]).astype(np.int32)}
                )

    return run


def _pieces(k: int):
    """Path pieces whose minimizer position is listed in ``places``, with the hashes of their edges."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, rids, listed = batch["doc_id"].to_numpy(), batch["rid"].to_numpy(), list(batch["places"])
            for at, part in chunks(list(batch["text"])):
                words = Words(part)
                window, places, runs = _minimizers(words, k)
                if not len(window):
                    continue
                wanted = np.zeros(len(words.start) + 1, dtype=bool)
                for i in range(len(part)):
                    wanted[words.first[i] + np.asarray(listed[at + i], dtype=np.int64)] = True
                begin = np.flatnonzero(np.append(True, (places[1:] != places[:-1]) | (window[1:] != window[:-1] + 1)))
                count = np.diff(np.append(begin, len(window)))
                use = wanted[places[begin]]
                begin, count = begin[use], count[use]
                first, h = window[begin], words.hashes()
                doc = words.doc[first]
                raw = grams(h, k).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_EDGE].tobytes()
                yield pd.DataFrame(
                    {
                        "h": runs[places[begin]].view(np.int64),
                        "p": stretches(h, first, first + count + k - 1).view(np.int64),
                        "doc_id": ids[at + doc],
                        "rid": rids[at + doc],
                        "pos": (first - words.first[doc]).astype(np.int32),
                        "n": count.astype(np.int32),
                        "edges": [raw[_EDGE * i : _EDGE * (i + c)] for i, c in zip(first.tolist(), count.tolist(), strict=True)],
                    }
                )

    return run


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of path pieces, one row each."""
    for batch in batches:
        count = batch["n"].to_numpy()
        raw = np.frombuffer(b"".join(batch["edges"]), dtype=np.uint8).reshape(-1, _EDGE)
        edge = np.zeros((len(raw), 8), dtype=np.uint8)
        edge[:, :_EDGE] = raw
        edge = edge.reshape(-1).view("<i8")
        offset = np.arange(len(edge)) - np.repeat(np.cumsum(count) - count, count)
        yield pd.DataFrame(
            {
                "h": np.repeat(batch["h"].to_numpy(), count),
                "e": edge,
                "doc_id": np.repeat(batch["doc_id"].to_numpy(), count),
                "rid": np.repeat(batch["rid"].to_numpy(), count),
                "pos": (np.repeat(batch["pos"].to_numpy(), count) + offset).astype(np.int32),
            }
        )


def _identified(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    rid = F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), rid.alias("rid"), text.alias("text"))


def _firsts(rows: DataFrame, name: str) -> DataFrame:
    """One row for each piece or edge: its first source coordinate."""
    return rows.groupBy("h", name).agg(F.min(F.struct("doc_id", "rid", "pos")).alias("first"))


def repeated_spans(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, rid, start, length, source): stretches of windows that also start in the smaller document ``source``.

    ``start`` and ``length`` count windows, so a span covers ``length + k - 1`` words.
    """
    rows = _identified(docs).where("doc_id is not null and text is not null")
    chosen = rows.mapInPandas(_selected(k), "h long, doc_id long, rid int, pos int")
    shared = chosen.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    shared = stored(shared.select("h"))
    places = chosen.join(shared, "h").groupBy("doc_id", "rid").agg(F.collect_set("pos").alias("places"))
    candidates = rows.dropDuplicates(["doc_id", "rid"]).join(places, ["doc_id", "rid"])
    kinds = "h long, p long, doc_id long, rid int, pos int, n int, edges binary"
    pieces = stored(candidates.mapInPandas(_pieces(k), kinds))
    discard(shared)

    firsts = stored(_firsts(pieces, "p"))
    whole = pieces.drop("edges").join(firsts, ["h", "p"]).where("first.doc_id < doc_id")
    whole = stored(whole.select("doc_id", "rid", "pos", "n", "first"))
    # Unequal pieces with one minimizer: what is no copy of a smaller document's piece is compared edge by edge.
    branching = firsts.groupBy("h").agg(F.min("first.doc_id").alias("low"), F.max("first.doc_id").alias("high")).where("low < high")
    branching = firsts.join(branching.select("h"), "h").select("h", "p", F.col("first.doc_id").alias("source"))
    apart = pieces.join(branching, ["h", "p"]).where("source = doc_id").select("h", "doc_id", "rid", "pos", "n", "edges")
    edges = stored(apart.mapInPandas(_edges, "h long, e long, doc_id long, rid int, pos int"))
    discard(pieces, firsts)
    single = edges.join(_firsts(edges, "e"), ["h", "e"]).where("first.doc_id < doc_id")
    single = stored(single.select("doc_id", "rid", "pos", F.lit(1).alias("n"), "first"))
    discard(edges)

    # Compaction to spans: pieces and edges with one source whose positions advance together.
    copies = whole.union(single).select(
        "doc_id", "rid", "pos", "n", F.col("first.doc_id").alias("source"), F.col("first.rid").alias("source_rid"), (F.col("pos") - F.col("first.pos")).alias("shift")
    )
    path = Window.partitionBy("doc_id", "rid", "source", "source_rid", "shift").orderBy("pos")
    fresh = F.when(F.col("pos") <= F.lag(F.col("pos") + F.col("n")).over(path), 0).otherwise(1)
    spans = copies.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(path))
    spans = spans.groupBy("doc_id", "rid", "source", "source_rid", "shift", "span")
    spans = spans.agg(F.min("pos").alias("start"), (F.max(F.col("pos") + F.col("n")) - F.min("pos")).alias("length"))
    spans = stored(spans.select("doc_id", "rid", "source", "start", "length"))
    discard(whole, single)
    return spans


def _kept(k: int):
    """What is left of each document without the words under its spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, total, gone = [], [], []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                total.append(len(words))
                if spans is None or not len(spans):
                    gone.append(0)
                    texts.append(b" ".join(words))
                    continue
                steps = np.zeros(len(words) + 1, dtype=np.int64)
                for s in spans:
                    steps[s["start"]] += 1
                    steps[s["start"] + s["length"] + k - 1] -= 1
                keep = np.cumsum(steps)[:-1] == 0
                gone.append(int((~keep).sum()))
                texts.append(b" ".join([w for w, yes in zip(words, keep, strict=True) if yes]))
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_words": total, "n_removed": gone, "kept": [t.decode("utf-8", "surrogatepass") for t in texts]}
            )

    return run


def without_repeats(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: ``kept`` are the words left, joined by one space.

    Words are runs of anything but space, tab and line ends. Null or empty text: no words, kept is empty. Null doc_id: no
    id is smaller or larger, so the row is returned whole and is no source for others. Rows that repeat an id are returned
    each; windows they share do not count as repeats, as no id is smaller. Fewer than ``k`` words: kept whole.
    """
    rows = _identified(docs)
    spans = repeated_spans(docs, k).groupBy("doc_id", "rid").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    joined = rows.join(spans, ["doc_id", "rid"], "left")
    return joined.mapInPandas(_kept(k), "doc_id long, n_words long, n_removed long, kept string")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Result of the query: doc_id, n_words, n_removed, kept_sha256."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
