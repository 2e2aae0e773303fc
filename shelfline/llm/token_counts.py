"""Token counts by a map-side two-tier lookup.

Tier one: a broadcast table of the token counts of frequent pre-tokens. Tier two: a bounded cache in each Python worker,
filled by encoding what tier one misses. Texts stay where they were read; no pre-token is ever shuffled. The frequent
pre-tokens come from summaries over all documents: each input partition keeps counters for a bounded number of
pre-tokens (frequent-items sketch) and returns at most ``SUMMARY`` of them. The table only saves time; counts are exact
whatever it holds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FREQUENT = 16_384  # entries of the broadcast table, of at most ENTRY_CHARS characters each: some 2 MB
SUMMARY = 2_048  # pre-tokens an input partition reports
COUNTERS = 65_536  # counters it keeps meanwhile
CACHE = 200_000  # entries of a worker's cache
ENTRY_CHARS = 48
LIMIT = 512

# Fixed value: the pre-token pattern of byte-level BPE vocabularies of this kind.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Texts of these characters alone, on whose classes all regular expression engines agree, are split by an equal pattern
# of the faster standard engine. A text with others is encoded whole by the library.
_PLAIN = r"[\t\n\r\x20-\x7e¡-¬®-±´-¸»À-ͷΑ-ΡΣ-ҁ‐-‧ぁ-ゖ一-龥]*"
_PLAIN_PRE_TOKEN = r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"

# Byte-level vocabularies write each byte as one visible character: printable Latin-1 as itself, the rest from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARACTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}

_state: dict[str, tuple] = {}


def _tools(path: str) -> tuple:
    """(tokenizer, split, plain, specials, cache) of a vocabulary file, once a worker process."""
    if path not in _state:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        _state[path] = (tokenizer, re.compile(_PLAIN_PRE_TOKEN), re.compile(_PLAIN), specials, {})
    return _state[path]


def counter(path: str, frequent: dict[str, int]) -> Callable[[str | None], int]:
    """Function from a text to its number of tokens."""
    tokenizer, pattern, plain, specials, cache = _tools(path)
    merge = tokenizer.model.tokenize

    def encoded(text: str) -> int:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    def count(text: str | None) -> int:
        if not text:
            return 0
        if not plain.fullmatch(text) or any(s in text for s in specials):
            return encoded(text)
        total = 0
        for piece in pattern.findall(text):
            n = frequent.get(piece)
            if n is None:
                n = cache.get(piece)
                if n is None:
                    n = len(merge(piece.encode().decode("latin-1").translate(_BYTE_CHARACTERS)))
                    if len(piece) <= ENTRY_CHARS:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[piece] = n
            total += n
        return total

    return count


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    exact, plain, fast = regex.compile(PRE_TOKEN), re.compile(_PLAIN), re.compile(_PLAIN_PRE_TOKEN)
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch["text"]:
            text = text or ""
            counts.update((fast if plain.fullmatch(text) else exact).findall(text))
            if len(counts) > 2 * COUNTERS:
                floor = sorted(counts.values())[-COUNTERS]
                counts = Counter({k: v - floor for k, v in counts.items() if v > floor})
    top = sorted((k for k in counts if len(k) <= ENTRY_CHARS), key=lambda k: (-counts[k], k))[:SUMMARY]
    yield pd.DataFrame({"piece": top, "n": [counts[k] for k in top]}).astype({"piece": object, "n": "int64"})


def frequent_table(docs: DataFrame, path: str, size: int = FREQUENT) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of all documents; at most ``size`` entries."""
    seen = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(_summaries, "piece string, n long")
    top = seen.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    tokenizer = _tools(path)[0]
    pieces = [r[0] for r in top.select("piece").collect()]
    return {p: len(e.ids) for p, e in zip(pieces, tokenizer.encode_batch(pieces, add_special_tokens=False), strict=True)}


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; null or empty text: 0 bytes, 0 tokens. Other columns ignored.

    ``path``: vocabulary file, at the same place on every machine. Rows with a null or repeated doc_id are counted too.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path))

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(path, table.value)
        for batch in texts:
            yield pd.Series([count(t) for t in batch], dtype="int64")

    text = F.col("text").cast("string")
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        tokens(text).alias("n_tokens"),
    )
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
