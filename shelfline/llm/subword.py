"""SentencePiece encoding with seeded merge dropout, and lossless decoding.

Encoding follows the merge-type algorithm: a text becomes characters, and an agenda of neighbouring pairs that form a piece
is worked off by score, ties from the left, each merge adding new pairs. Every candidate merge is skipped for good if a keyed
hash of (seed, document key, place of its first character, both pieces) falls under the dropout rate. So each document and
place gets its own segmentation, the same one on every run and on every executor; other seeds give others. Rate 0 gives the
vocabulary's own segmentation.

No piece holds a space sign after another character, so the stretches from one run of spaces to the next are independent.
They are worked off together: NumPy arrays hold the symbols of all stretches of a chunk, and each step does the best
merge of every stretch that has one left. A stretch of over ``LONG`` characters (text without spaces) has a heap as its agenda
instead, so its time grows with its length and the heap's depth, not with its square. Characters without a piece become byte pieces, so do space signs that stand in the
text itself: decoding gives back every text exactly.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.words import mix, mixed

RATE = 0.1
SEED = 7
CHUNK_CHARACTERS = 1 << 17
LONG = 512  # characters of a stretch from which on a heap holds its agenda
SPACE_SIGN = 0x2581
_NONE = np.int32(2**31 - 1)

_loaded: dict[str, Pieces] = {}


class Pieces:
    """A vocabulary: pieces, their merges as a hash table from (left, right) to the piece, characters, byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = {
            n: i for i, n in enumerate(names) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        sign = chr(SPACE_SIGN)
        if any(sign in n.lstrip(sign) for n in plain):
            raise ValueError("a piece goes across a space")
        self.bytes = np.full(256, -1, dtype=np.int32)
        for i in range(size):
            if model.is_byte(i):
                self.bytes[int(names[i][1:-1], 16)] = i
        if (self.bytes < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        self.text = [b"" if model.is_control(i) or model.is_unknown(i) else n.replace(sign, " ").encode() for i, n in enumerate(names)]
        for byte, i in enumerate(self.bytes.tolist()):
            self.text[i] = bytes([byte])
        # Order of merges: higher score first, then the smaller number; rank[i] is piece i's place.
        scores = np.array([model.get_score(i) for i in range(size)])
        self.rank = np.empty(size, dtype=np.int32)
        self.rank[np.lexsort((np.arange(size), -scores))] = np.arange(size)
        self.ranked = np.argsort(self.rank).tolist()  # piece of each rank
        self.characters = np.full(0x110000, -1, dtype=np.int32)
        for n, i in plain.items():
            if len(n) == 1:
                self.characters[ord(n)] = i
        self.sign = int(self.characters[SPACE_SIGN])
        self.characters[SPACE_SIGN] = -1  # one in the text itself is no space
        self.characters[0x20] = self.sign
        pairs = [
            (plain[n[:at]], plain[n[at:]], i) for n, i in plain.items() for at in range(1, len(n)) if n[:at] in plain and n[at:] in plain
        ]
        left, right, whole = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        key = (left << 32) | right
        self._ranks: dict[int, int] | None = None
        self.slots = max(1 << 10, 1 << int(np.ceil(np.log2(max(1, len(key)) * 8))))
        self.keys, self.values = np.full(self.slots, -1, dtype=np.int64), np.full(self.slots, -1, dtype=np.int32)
        slot, todo = self._slot(key), np.arange(len(key))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] < 0
            self.keys[slot[todo[free]]] = key[todo[free]]  # one of several wins its slot
            won = self.keys[slot[todo]] == key[todo]
            self.values[slot[todo[won]]] = whole[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & (self.slots - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.view(np.uint64)) & np.uint64(self.slots - 1)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 for none."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.values[slot], -1)
        todo = np.flatnonzero((seen != key) & (seen >= 0) & (key >= 0))
        for step in range(1, self.probes):
            if not len(todo):
                break
            at = (slot[todo] + step) & (self.slots - 1)
            seen = self.keys[at]
            hit = seen == key[todo]
            out[todo[hit]] = self.values[at[hit]]
            todo = todo[~hit & (seen >= 0)]
        return out.astype(np.int32)


    def ranks(self) -> dict[int, int]:
        """Rank of the piece that each pair (left << 32 | right) makes; built when a long stretch first needs it."""
        if self._ranks is None:
            full = self.keys >= 0
            self._ranks = dict(zip(self.keys[full].tolist(), self.rank[self.values[full]].tolist(), strict=True))
        return self._ranks


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _long_stretch(symbol: np.ndarray, order: np.ndarray, salt: np.ndarray, vocabulary: Pieces, under: int) -> np.ndarray:
    """Work off one stretch by a heap of (rank, place): ``symbol`` is changed in place, which symbols are left is returned.

    A place has one valid entry, that of its current ``rank``; entries of pairs that are gone are passed over.
    """
    n = len(symbol)
    rank, symbols = array("q", order.astype(np.int64).tobytes()), array("q", symbol.astype(np.int64).tobytes())
    following, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    alive = np.ones(n, dtype=bool)
    ranks, ranked, none = vocabulary.ranks(), vocabulary.ranked, int(_NONE)
    agenda = ((order.astype(np.int64) << 32) | np.arange(n))[order < _NONE].tolist()
    heapify(agenda)
    while agenda:
        entry = heappop(agenda)
        at = entry & 0xFFFFFFFF
        if rank[at] != entry >> 32:
            continue
        gone = following[at]
        symbols[at] = ranked[rank[at]]
        alive[gone] = False
        rank[at] = rank[gone] = none
        after = following[at] = following[gone]
        if after < n:
            before[after] = at
        for left in (at, before[at]):
            if left < 0 or following[left] >= n:
                continue
            first, second = symbols[left], symbols[following[left]]
            found = none
            if first >= 0 and second >= 0:
                pair = (first << 32) | second
                found = ranks.get(pair, none)
                if found < none and under and mixed(int(salt[left]) ^ mixed(pair)) < under:
                    found = none
            rank[left] = found
            if found < none:
                heappush(agenda, (found << 32) | left)
    symbol[:] = np.frombuffer(symbols, dtype=np.int64)
    return alive


def encode(texts: list[str], keys: np.ndarray, vocabulary: Pieces, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, number of ids of each). ``keys``: 64-bit document keys. Empty text: no ids."""
    wide = "".join(" " + t for t in texts if t)  # the vocabulary puts a space before each text
    points = np.frombuffer(wide.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    begin = np.cumsum(sizes) - sizes
    n = len(points)
    symbol = vocabulary.characters[points]
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = (np.arange(n) - begin[owner]).astype(np.uint64)
    salt = mix(keys.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))[owner] + place * np.uint64(0xD1342543DE82EF95)
    # Stretches: a new one at each space after something else, and at each text.
    space = points == 0x20
    head = space & ~np.append(False, space[:-1])
    head[begin[sizes > 0]] = True
    stretch = np.cumsum(head) - 1

    under = np.uint64(min(int(rate * 2**64), 2**64 - 1))
    following = np.arange(1, n + 1)
    following[np.append(head[1:], True)] = -1  # last of its stretch
    before = np.arange(-1, n - 1)
    before[head] = -1
    alive = np.ones(n, dtype=bool)
    made = np.full(n, -1, dtype=np.int32)  # piece of each symbol with the next one
    order = np.full(n, _NONE, dtype=np.int32)  # its rank

    def consider(at: np.ndarray) -> None:
        """Look up the pairs that begin at ``at``, which have a next symbol."""
        left, right = symbol[at], symbol[following[at]]
        piece = vocabulary.merge(left, right)
        if under:
            pair = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
            piece[mix(salt[at] ^ mix(pair)) < under] = -1
        made[at] = piece
        order[at] = np.where(piece >= 0, vocabulary.rank[piece], _NONE)

    consider(np.flatnonzero(following >= 0))
    heads = np.flatnonzero(head)
    lengths = np.diff(np.append(heads, n))
    long = lengths > LONG
    for first, length in zip(heads[long].tolist(), lengths[long].tolist(), strict=True):
        part = slice(first, first + length)
        alive[part] = _long_stretch(symbol[part], order[part], salt[part], vocabulary, int(under))
    # ``live``: symbols of the other stretches with merges left, in order.
    live = np.flatnonzero(np.repeat(~long & (np.minimum.reduceat(order, heads) < _NONE), lengths))
    while len(live):
        own = stretch[live]
        edge = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        # Lowest rank, then leftmost, of each stretch.
        value = (order[live].astype(np.int64) << 32) | np.arange(len(live))
        best = np.minimum.reduceat(value, edge)
        go = (best >> 32) < _NONE
        at = live[(best & 0xFFFFFFFF)[go]]
        gone = following[at]
        symbol[at] = made[at]
        alive[gone] = False
        after = following[gone]
        following[at] = after
        linked = after >= 0
        before[after[linked]] = at[linked]
        made[at], order[at] = -1, _NONE
        order[gone] = _NONE
        previous = before[at]
        consider(np.concatenate([at[linked], previous[previous >= 0]]))
        live = live[np.repeat(go, np.diff(np.append(edge, len(live)))) & alive[live]]

    left = np.flatnonzero(alive)
    ids, owned = symbol[left], owner[left]
    odd = np.flatnonzero(ids < 0)
    if len(odd):  # characters without a piece, as bytes
        raws = [chr(c).encode("utf-8", "surrogatepass") for c in points[left[odd]].tolist()]
        width = np.ones(len(ids), dtype=np.int64)
        width[odd] = [len(r) for r in raws]
        out = np.repeat(ids, width)
        flat = np.frombuffer(b"".join(raws), dtype=np.uint8)
        out[out < 0] = vocabulary.bytes[flat]
        ids, owned = out, np.repeat(owned, width)
    return ids, np.bincount(owned, minlength=len(texts))


def decode(ids: np.ndarray, vocabulary: Pieces) -> str:
    """The text that ``ids`` encode."""
    text = vocabulary.text
    raw = b"".join([text[i] for i in ids.tolist()])
    return raw[1:].decode("utf-8", "surrogatepass")


def document_key(doc_id: int | None) -> int:
    """Key of a document: its id, null as one value of its own."""
    return -(1 << 63) if doc_id is None else int(doc_id)


def encoded(docs: DataFrame, path: str, rate: float = RATE, seed: int = SEED, back: bool = False) -> DataFrame:
    """(doc_id, text, ids) of every row. Null or empty text: no ids. Null doc_id: a key of its own. Other columns are ignored.

    Rows that repeat a doc_id are encoded each; equal ids and texts get equal segmentations. ``back`` adds the text that the
    ids decode to, found in the same worker, so that they needn't travel to a second one.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32()))] + [("back", pa.string())] * back)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= CHUNK_CHARACTERS):
                    size += len(texts[end] or "")
                    end += 1
                keys = np.array([document_key(i) for i in ids[at:end]], dtype=np.int64)
                flat, counts = encode([t or "" for t in texts[at:end]], keys, vocabulary, rate, seed)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))
                part = batch.slice(at, end - at)
                columns = [part.column("doc_id"), part.column("text"), column]
                if back:
                    columns.append(pa.array([decode(flat[a:b], vocabulary) for a, b in itertools.pairwise(offsets.tolist())], type=pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                at = end

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, ids array<int>" + ", back string" * back)


def decoded(column, path: str):
    """Column of the texts that a column of ids encodes; null ids give null."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        vocabulary = pieces(path)
        return pd.Series([None if i is None else decode(np.asarray(i), vocabulary) for i in ids], dtype=object)

    return run(column)


def segmentations(docs: DataFrame, path: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """Result of the query: doc_id, n_pieces, ids_sha256 (ids joined by spaces), decoded_sha256, lossless.

    lossless: the decoded text is the text. A null text counts as empty.
    """
    out = encoded(docs, path, rate, seed, back=True)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), " "), 256).alias("ids_sha256"),
        F.sha2("back", 256).alias("decoded_sha256"),
        (F.col("back") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )
