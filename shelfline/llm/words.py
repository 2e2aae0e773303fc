"""Words of many texts at once, as NumPy arrays: byte ranges, 64-bit hashes and hashes of word n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ALL = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}

#: Bytes between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 65536), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser of a common hash family)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed(x: int) -> int:
    """``mix`` of one unsigned value."""
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _ALL
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _ALL
    return x ^ (x >> 31)


class Words:
    """All words of a chunk: ``data`` bytes, ``start``/``end`` of each word, ``doc`` it belongs to, ``first`` word of each text."""

    def __init__(self, texts: list[bytes], gap: np.ndarray = SPACES):
        self.data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.data, dtype=np.uint8)
        space = gap[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(raw) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        limits = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.start, np.concatenate([[0], limits]))
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self._raw = raw

    def hashes(self) -> np.ndarray:
        """One 64-bit hash a word."""
        raw = self._raw
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power(_BASE, "up", len(raw)), out=sums[1:])
        down = _power(_BACK, "down", len(raw))
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def grams(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words, across text boundaries too (callers mask those)."""
    count = max(0, len(h) - n + 1)
    out = np.full(count, seed + n, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[k : k + count]
        out ^= out >> np.uint64(32)
    return mix(out)


def stretches(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words of each stretch from ``start`` to before ``end``."""
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(mix(h + _BASE) * _power(_BASE, "up", len(h)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power(_BACK, "down", len(h))[start] + (end - start).astype(np.uint64))


def chunks(texts: list[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, UTF-8 texts) of consecutive texts of about ``limit`` bytes; a longer text stands alone."""
    at, size, part = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if part and size + len(raw) > limit:
            yield at, part
            at, size, part = i, 0, []
        part.append(raw)
        size += len(raw)
    if part:
        yield at, part
