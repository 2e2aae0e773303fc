"""Benchmark decontamination by SimHash of item-sized windows.

Texts and items are lower-cased and split into words at white space, control characters and ASCII punctuation; shingles are
runs of 5 words. For an item of n words, the windows of a document are its runs of n words. A window whose weighted shingles
are at least ``SIMILARITY`` like the item's holds that share of shingles that some item has; windows that do not are
passed over, which loses nothing. The others get a SimHash of 64 bits. Item fingerprints stand in an index of 10 blocks of 6 or
7 bits; looking up each block and its one-bit neighbours finds every fingerprint within ``RADIUS`` = 19 bits, as at most
19 differing bits leave one block with at most one. Candidates are then verified by the exact weighted similarity: the sum
over shingles of the smaller number of occurrences by that of the larger.

A document shorter than an item is itself the one window. It is compared with all items of that size that share a shingle,
found by an exact index of their shingles, without fingerprints.

Only the items travel: they are taken in blocks of at most ``ITEMS`` items and ``ITEM_WORDS`` words, one pass over the
documents for each block, so what is broadcast is bounded whatever the size of the benchmark.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import identified, rows_of, stored
from shelfline.llm.words import Words, chunks, grams

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
ITEMS = 20_000
ITEM_WORDS = 1_000_000

#: Bytes between words: white space, control characters and ASCII punctuation.
GAPS = np.zeros(256, dtype=bool)
GAPS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

#: (first bit, width) of each block of a fingerprint.
PARTS = [(7 * b, 7) for b in range(4)] + [(28 + 6 * b, 6) for b in range(6)]
_BITS = np.arange(64, dtype=np.uint64)


def folded(texts: list[str | None]) -> list[str]:
    return [(t or "").lower() for t in texts]


def _signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    return ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    x, y = Counter(a.tolist()), Counter(b.tolist())
    both = sum(min(n, y[s]) for s, n in x.items())
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


class Items:
    """A block of items by their number of words, with the index of their fingerprints."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        words = Words([t.encode("utf-8", "surrogatepass") for t in folded(texts)], GAPS)
        h = words.hashes()
        self.groups: dict[int, tuple[list[int], list[np.ndarray], np.ndarray, list[dict[int, np.ndarray]]]] = {}
        self.holders: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sized = defaultdict(list)
        for i, item in enumerate(ids):
            own = h[words.first[i] : words.first[i + 1]]
            if len(own):
                sized[len(own)].append((item, grams(own, min(SHINGLE, len(own)))))
        known = defaultdict(list)
        for n, members in sorted(sized.items()):
            bags = [b for _, b in members]
            prints = np.concatenate([_pack(_signs(b).sum(axis=0, keepdims=True)) for b in bags])
            self.groups[n] = ([i for i, _ in members], bags, prints, self._index(prints))
            self.holders[n] = self._holders(bags)
            known[min(SHINGLE, n)] += bags
        self.known = {size: np.unique(np.concatenate(bags)) for size, bags in known.items()}
        self.marks = {}
        for size, found in self.known.items():
            mark = np.zeros(1 << 22, dtype=bool)
            mark[(found & np.uint64(0x3FFFFF)).astype(np.int64)] = True
            self.marks[size] = mark

    @staticmethod
    def _index(prints: np.ndarray) -> list[dict[int, np.ndarray]]:
        blocks = []
        for low, width in PARTS:
            table = defaultdict(list)
            for i, value in enumerate(((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).tolist()):
                for near in (value, *(value ^ (1 << j) for j in range(width))):
                    table[near].append(i)
            blocks.append({k: np.array(v) for k, v in table.items()})
        return blocks

    @staticmethod
    def _holders(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All shingles of the items in order, and the item of each."""
        every, owner = np.concatenate(bags), np.repeat(np.arange(len(bags), dtype=np.int32), [len(b) for b in bags])
        order = np.argsort(every, kind="stable")
        return every[order], owner[order]

    def _sharing(self, n: int, shingles: np.ndarray) -> list[int]:
        """The items of ``n`` words that have one of the shingles."""
        every, owner = self.holders[n]
        own = np.unique(shingles)
        low, high = np.searchsorted(every, own), np.searchsorted(every, own, side="right")
        return sorted({i for a, b in zip(low.tolist(), high.tolist(), strict=True) for i in owner[a:b].tolist()})

    def hits(self, shingles: np.ndarray, size: int) -> np.ndarray:
        """Which shingles some item has."""
        found = self.marks[size][(shingles & np.uint64(0x3FFFFF)).astype(np.int64)]
        at = np.flatnonzero(found)
        known = self.known[size]
        place = np.minimum(np.searchsorted(known, shingles[at]), len(known) - 1)
        found[at] = known[place] == shingles[at]
        return found

    def matches(self, part: list[bytes]) -> Iterator[tuple[int, int, int, int, float]]:
        """(text number, item, first word, words, similarity): the best window of each text and item."""
        words = Words(part, GAPS)
        h = words.hashes()
        for size in self.known:
            shingles = grams(h, size)
            if not len(shingles):
                continue
            hit = self.hits(shingles, size) & (words.doc[: len(shingles)] == words.doc[size - 1 :])
            for text in np.unique(words.doc[np.flatnonzero(hit)]).tolist():
                a, b = int(words.first[text]), int(words.first[text + 1])
                yield from self._in_text(text, shingles[a : b - size + 1], hit[a : b - size + 1], size)

    def _in_text(self, text: int, shingles: np.ndarray, hit: np.ndarray, size: int):
        total = np.concatenate([[0], np.cumsum(hit)])
        best: dict[int, tuple[float, int, int]] = {}
        for n, (ids, bags, prints, index) in self.groups.items():
            count = n - size + 1  # shingles a window
            if min(SHINGLE, n) != size:
                continue
            if count > len(shingles):
                least = (len(shingles) + count) * SIMILARITY / (1 + SIMILARITY)
                if min(len(shingles), total[-1]) >= least - 1e-9:
                    for i in self._sharing(n, shingles):
                        alike = similarity(shingles, bags[i])
                        if alike >= SIMILARITY and alike > best.get(ids[i], (0.0,))[0]:
                            best[ids[i]] = (alike, 0, len(shingles) + size - 1)
                continue
            # 2 x common / (2 x count) at least what the similarity needs.
            needed = int(np.ceil(count * 2 * SIMILARITY / (1 + SIMILARITY) - 1e-9))
            starts = np.flatnonzero(total[count:] - total[:-count] >= needed)
            for at in range(0, len(starts), 4096):
                some = starts[at : at + 4096]
                for s, fp in zip(some.tolist(), self._fingerprints(shingles, some, count).tolist(), strict=True):
                    near = set()
                    for block, (low, width) in zip(index, PARTS, strict=True):
                        near.update(block.get((fp >> low) & ((1 << width) - 1), ()))
                    for i in near:
                        if (fp ^ int(prints[i])).bit_count() > RADIUS:
                            continue
                        alike = similarity(shingles[s : s + count], bags[i])
                        if alike >= SIMILARITY and alike > best.get(ids[i], (0.0,))[0]:
                            best[ids[i]] = (alike, s, n)
        for item, (alike, s, n) in sorted(best.items()):
            yield text, item, s, n, alike

    @staticmethod
    def _fingerprints(shingles: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
        """SimHash of each window, from running sums over the stretches the windows lie in."""
        out = np.empty(len(starts), dtype=np.uint64)
        cut = np.flatnonzero((np.diff(starts) > count) | (np.diff(starts // 32_768) > 0)) + 1  # bounds the sums
        for group in np.split(np.arange(len(starts)), cut):
            low, high = int(starts[group[0]]), int(starts[group[-1]]) + count
            sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_signs(shingles[low:high]), axis=0, dtype=np.int32)])
            own = starts[group] - low
            out[group] = _pack(sums[own + count] - sums[own])
        return out


def _item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """Items in blocks of bounded size, in the order they are read. Items without id or text are passed over."""
    ids, texts, words = [], [], 0
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for item, text in rows.distinct().toLocalIterator():
        ids.append(item)
        texts.append(text)
        words += len(text) // 2 + 1
        if len(ids) == ITEMS or words > ITEM_WORDS:
            yield ids, texts
            ids, texts, words = [], [], 0
    if ids:
        yield ids, texts


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, rid, item_id, first_word, n_words, similarity): the best window of each document and item it holds.

    Words are counted from 0 after folding. Null or empty texts and items without words hold nothing and match nothing.
    A text of fewer words than the item is compared whole.
    A null doc_id stays null; repeated rows give repeated rows; ties go to the window of fewer words, then the first. An
    item_id with several texts is matched by each. ``rid`` is a hash of the text. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = identified(docs)
    kinds = "doc_id long, rid long, item_id long, first_word int, n_words int, similarity double"
    found = []
    for ids, texts in _item_blocks(benchmark):
        block = spark.sparkContext.broadcast(Items(ids, texts))

        def scan(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            for batch in batches:
                doc, rid = batch["doc_id"], batch["rid"]
                out = []
                for at, part in chunks(folded(list(batch["text"]))):
                    for i, item, start, n, alike in block.value.matches(part):
                        out.append((doc.iloc[at + i], rid.iloc[at + i], item, start, n, alike))
                made = pd.DataFrame(out, columns=["doc_id", "rid", "item_id", "first_word", "n_words", "similarity"])
                yield made.astype({"doc_id": "Int64", "rid": "Int64"})

        found.append(rows.mapInPandas(scan, kinds))
    if not found:
        return spark.createDataFrame([], kinds)
    return reduce(DataFrame.unionAll, found)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    held = stored(matches(docs, benchmark).select("doc_id", "rid").distinct())
    return rows_of(docs, held, "left_anti")


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Result of the query: doc_id, item_id, first_word, n_words, similarity (six digits)."""
    return matches(docs, benchmark).select("doc_id", "item_id", "first_word", "n_words", F.round("similarity", 6).alias("similarity"))
