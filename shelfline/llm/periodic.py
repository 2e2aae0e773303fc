"""Runs of periodic words in every text, by string synchronising sets.

A run is a maximal stretch of words with smallest period q (words q apart are equal) and length of at least 3 q. All texts
of a chunk stand in one array of word hashes, each followed by a separator that occurs once, so that a few array
operations a scale serve many texts.

* Periods up to ``DIRECT`` are found by comparing each word with the one q further: these are the highly periodic regions.
* At scale t = 8, 16, 32, ... positions are selected by a hash of their next t words: position i is taken if the smallest
  hash among i to i + t is that of i or of i + t. Positions whose next t words have a period of t / 3 or less, known from
  smaller scales, are left out; the rest of the set is thin there, and their runs are known already. Whether a position is
  taken depends on its next 2 t words only, so equal contexts are taken alike.
* Neighbouring taken positions of one text with equal contexts of 2 t words propose periods from 1.5 t to 2 t, those with
  equal contexts of 3 t words periods from there to 3 t. In a run with such a period some position of the first lap is
  taken, its twin one lap later is taken too, and no equal context lies between them, since two periods that short would
  imply a smaller one. So every run is proposed; proposals of one run merge, are compared word by word and extended.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.words import Words, chunks, mix

DIRECT = 11  # periods found by direct comparison; the scales begin at 12 = 1.5 * 8
FIRST_SCALE = 8
LAPS = 3
MIN_WORDS = 24
_DOC = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(2**64 - 1)
_SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_ANALYSED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("left", T.StringType())])


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _ODD + (right ^ (right >> np.uint64(29))))


def _ahead(a: np.ndarray, step: int) -> np.ndarray:
    """Each position's value ``step`` further; past the end it wraps round, across a separator."""
    return np.concatenate([a[step:], a[:step]]) if step < len(a) else a


def _stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    at = np.flatnonzero(true)
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + 1


def _primitive(lap: np.ndarray) -> bool:
    """Whether the words of one lap are no repetition of fewer words."""
    q = len(lap)
    return not any(q % d == 0 and (lap[d:] == lap[:-d]).all() for d in range(1, q // 2 + 1))


def _selected(h: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set at scale ``t``; ``h`` hashes the next t words, ``periodic`` are left out."""
    ids = np.where(periodic, _TOP, h)
    low, size = ids, 1
    while size < t:  # smallest of the next ``size`` values
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    last = ids[t:]
    low = np.minimum(low[: len(last)], last)
    return np.flatnonzero(((ids[: len(last)] == low) | (last == low)) & (low != _TOP))


def _proposals(at: np.ndarray, context: np.ndarray, doc: np.ndarray, low: int, high: int, size: int) -> list[tuple[int, int, int]]:
    """(start, end, period): merged stretches where words equal those a period further, for periods in low..high."""
    key = mix(context + doc.astype(np.uint64) * _DOC)
    order = np.argsort(key, kind="stable")
    here, there = at[order[:-1]], at[order[1:]]
    gap = there - here
    near = (key[order[:-1]] == key[order[1:]]) & (gap >= low) & (gap <= high)
    here, gap = here[near], gap[near]
    if not len(here):
        return []
    order = np.lexsort((here, gap))
    here, gap = here[order], gap[order]
    fresh = np.concatenate([[True], (gap[1:] != gap[:-1]) | (here[1:] > here[:-1] + size)])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(here)]]) - 1
    return list(zip(here[first].tolist(), (here[last] + size).tolist(), gap[first].tolist(), strict=True))


def _extended(w: np.ndarray, a: int, b: int, q: int, low: int, high: int) -> tuple[int, int] | None:
    """The longest stretch around [a, b) inside [low, high) whose words equal those q further; None if [a, b) is none."""
    if b + q > high or not (w[a:b] == w[a + q : b + q]).all():
        return None
    step = 32
    while a > low:
        at = max(low, a - step)
        differ = np.flatnonzero(w[at:a] != w[at + q : a + q])
        if len(differ):
            a = at + int(differ[-1]) + 1
            break
        a, step = at, 2 * step
    step = 32
    while b + q < high:
        to = min(high - q, b + step)
        differ = np.flatnonzero(w[b:to] != w[b + q : to + q])
        if len(differ):
            b += int(differ[0])
            break
        b, step = to, 2 * step
    return a, b


def runs_of(h: np.ndarray, first: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """All runs (start, length, period) of each text, shorter ones than ``MIN_WORDS`` too, sorted.

    ``h`` are the word hashes of all texts, text k holding those from ``first[k]`` to before ``first[k + 1]``.
    """
    n = np.diff(first)
    found: list[set[tuple[int, int, int]]] = [set() for _ in n]
    docs = np.arange(len(n))
    start = first[:-1] + docs  # of each text in the array with separators
    w = np.empty(len(h) + len(n), dtype=np.uint64)
    owner = np.repeat(docs, n + 1)
    stop = start + n
    w[stop] = mix(np.arange(1, len(n) + 1, dtype=np.uint64) * _DOC)
    inside = np.ones(len(w), dtype=bool)
    inside[stop] = False
    w[inside] = h

    def keep(a: int, b: int, q: int) -> None:
        """The words of [a, b) equal those q further."""
        if b - a >= (LAPS - 1) * q and _primitive(w[a : a + q]):
            k = int(owner[a])
            found[k].add((a - int(start[k]), b + q - a, q))

    for q in range(1, min(DIRECT, len(w) - 1) + 1):
        a, b = _stretches(w[:-q] == w[q:])
        long = b - a >= (LAPS - 1) * q
        for x, y in zip(a[long].tolist(), b[long].tolist(), strict=True):
            keep(x, y, q)

    t, hashed, size = FIRST_SCALE, w, 1
    while True:
        left = n[docs] * 2 >= 9 * t  # a run of this scale has 3 * 1.5 t words at least
        if not left.any():
            break
        if not left.all():  # shorter texts are done
            mask = np.zeros(len(n), dtype=bool)
            mask[docs[left]] = True
            stays = mask[owner]
            w, hashed, owner, docs = w[stays], hashed[stays], owner[stays], docs[left]
            start[docs] = np.concatenate([[0], np.cumsum(n[docs] + 1)[:-1]])
            stop[docs] = start[docs] + n[docs]
        while size < t:
            hashed, size = _joined(hashed, _ahead(hashed, size)), 2 * size
        marks = np.zeros(len(w) + 1, dtype=np.int64)
        for k in docs.tolist():
            for s, length, q in found[k]:
                if 3 * q <= t <= length:
                    marks[start[k] + s] += 1
                    marks[start[k] + s + length - t + 1] -= 1
        at = _selected(hashed, t, np.cumsum(marks[:-1]) > 0)
        for context, low, high in ((2 * t, (3 * t + 1) // 2, 2 * t), (3 * t, 2 * t + 1, 3 * t - 1)):
            here = at[at + context <= stop[owner[at]]]
            if len(here) < 2:
                continue
            seen = _joined(hashed[here], hashed[here + t])
            if context > 2 * t:
                seen = _joined(seen, hashed[here + 2 * t])
            for a, b, q in _proposals(here, seen, owner[here], low, high, context):
                k = int(owner[a])
                stretch = _extended(w, a, b, q, int(start[k]), int(stop[k]))
                if stretch is not None:
                    keep(*stretch, q)
        t *= 2
    return [sorted(x) for x in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are left when each run keeps its first lap, joined by one space."""
    if not runs:
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        marks[start + q] += 1
        marks[start + length] -= 1
    gone = np.cumsum(marks[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


@F.pandas_udf(_ANALYSED)
def _analysed(texts: pd.Series) -> pd.DataFrame:
    out = []
    for _, part in chunks(list(texts)):
        words = Words(part)
        for raw, runs in zip(part, runs_of(words.hashes(), words.first), strict=True):
            own = raw.split()
            runs = [r for r in runs if r[1] >= MIN_WORDS]
            spans = [{"start": s, "length": m, "period": q} for s, m, q in runs]
            out.append((len(own), spans, collapsed(own, runs).decode("utf-8", "replace")))
    return pd.DataFrame(out, columns=["n_words", "spans", "left"])


def periodic(docs: DataFrame, text: str | Column = "text") -> DataFrame:
    """(doc_id, n_words, spans, left) of every row of ``docs``: its words, its runs and the text with one lap of each run.

    Words are `[^\\x20\\x09-\\x0D]+`. ``spans``: all runs (start word from 0, length, smallest period) of at least three
    laps and 24 words, by start, then period. ``left``: words in no run after that run's first lap, joined by one space.
    Null or empty text: no words, no spans, left empty. Repeated rows give repeated rows; a null doc_id stays null; other
    columns are ignored. An empty table gives none. A text is never cut: its cost grows as n log n.
    """
    text = F.col(text) if isinstance(text, str) else text
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _analysed(text.cast("string")).alias("p")).select("doc_id", "p.*")


@F.pandas_udf(T.StringType())
def _planted(ids: pd.Series, texts: pd.Series) -> pd.Series:
    out = []
    for doc, text in zip(ids, texts, strict=True):
        h = 1 if doc is None else zlib.crc32(doc.encode())
        if h % 10 == 0 and text is not None:
            words = text.encode("utf-8", "surrogatepass").split()
            n, g = len(words), h // 10
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                lap = words[a : a + p]
                tail = (lap * (-(-(n - a) // p)))[: n - a]
                text = b" ".join(words[:a] + tail).decode("utf-8", "replace")
        out.append(text)
    return pd.Series(out, dtype=object)


def planted(docs: DataFrame) -> Column:
    """The text of ``docs`` as the query takes it: one document in ten, by the crc32 of its id, ends in repeated laps.

    A null doc_id or text stays as it is.
    """
    return _planted(docs["doc_id"].cast("long").cast("string"), docs["text"].cast("string"))


def digests(found: DataFrame) -> DataFrame:
    """Result of the query from ``periodic``: doc_id, n_runs, the run with the greatest length / period, and two digests.

    Quotients are compared by cross multiplication; ties go to the smaller start, then the smaller period.
    """
    more = "x.length * y.period > y.length * x.period"
    less = "x.length * y.period < y.length * x.period"
    later = "x.start > y.start or (x.start = y.start and x.period > y.period)"
    best = F.expr(f"try_element_at(array_sort(spans, (x, y) -> case when {more} then -1 when {less} then 1 when {later} then 1 else -1 end), 1)")
    lines = F.expr("array_join(transform(spans, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = found.select("doc_id", "left", F.size("spans").cast("long").alias("n_runs"), best.alias("b"), lines.alias("lines"))
    return found.select(
        "doc_id",
        "n_runs",
        F.col("b.start").alias("start"),
        F.col("b.length").alias("length"),
        F.col("b.period").alias("period"),
        F.expr("1000 * b.length div b.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("left", 256).alias("collapsed_sha256"),
    )
