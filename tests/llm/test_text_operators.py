"""Token counts, merge dropout, substring and line removal against plain Python."""

import hashlib
import time
from collections import Counter

import numpy as np
import pytest

from shelfline.llm import debruijn, line_runs, subword, token_counts
from shelfline.llm.queries import vocabulary

from .conftest import prose


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# Token counts

ODD = ["<|endoftext|> x<|endoftext|>", "a\u0085b  c", "½²³ ª", "I'll 'S", "  a\n\n b ", "中文 ひら 😀", "\x1c\x1d a", "Ⅷ ͵ ʰ", "a_b__c", "١٢٣"]


def test_token_counts_equal_the_library(spark, docs, doc_rows):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)

    def row(i, t):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        return (i, len((t or "").encode()), n, n > 512)

    assert bag(token_counts.token_counts(docs, path)) == Counter(row(i, t) for i, t in doc_rows)
    count = token_counts.counter(path, {})
    for text in ODD:
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_nothing(no_docs):
    assert token_counts.token_counts(no_docs, vocabulary("byte_bpe_50k.json")).collect() == []


# Merge dropout


def agenda(text, key, pieces, rate, seed):
    """One candidate after the other, by score and place."""
    symbols = [(i, int(pieces.characters[ord(c)]), c) for i, c in enumerate(" " + text)] if text else []
    mask = (1 << 64) - 1

    def skip(place, left, right):
        salt = int(subword.mix(np.array([(key + seed * 0x9E3779B97F4A7C15) & mask], dtype=np.uint64))[0])
        salt = (salt + place * 0xD1342543DE82EF95) & mask
        pair = int(subword.mix(np.array([(left << 32) | (right & 0xFFFFFFFF)], dtype=np.uint64))[0])
        return int(subword.mix(np.array([salt ^ pair], dtype=np.uint64))[0]) < int(rate * 2**64)

    while True:
        found = []
        for j in range(len(symbols) - 1):
            (place, left, a), (_, right, _) = symbols[j], symbols[j + 1]
            if left >= 0 and right >= 0 and not (symbols[j + 1][2].startswith(" ") and not a.endswith(" ")):
                piece = int(pieces.merge(np.array([left]), np.array([right]))[0])
                if piece >= 0 and not skip(place, left, right):
                    found.append((int(pieces.rank[piece]), j, piece))
        if not found:
            break
        _, j, piece = min(found)
        symbols[j : j + 2] = [(symbols[j][0], piece, symbols[j][2] + symbols[j + 1][2])]
    out = []
    for _, piece, c in symbols:
        out += [piece] if piece >= 0 else [int(pieces.bytes[b]) for b in c.encode()]
    return out


TEXTS = ["", "a", " a  b ", "the merging of the pieces", "été ▁ \U0001f600 中\x00", "aaaaaaaaaaaaaaaa", "<0x0A> </s>", "\n\n\t"]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_segmentation_is_the_agenda_one(rate):
    pieces = subword.pieces(vocabulary("piece_bpe_32k.model"))
    keys = np.arange(len(TEXTS)) + 5
    ids, counts = subword.encode(TEXTS, keys, pieces, rate, 7)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for text, key, part in zip(TEXTS, keys.tolist(), parts, strict=True):
        assert part.tolist() == agenda(text, key, pieces, rate, 7)
        assert subword.decode(part, pieces) == text


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5])
def test_long_stretches_are_the_agenda_ones(rate, monkeypatch):
    pieces = subword.pieces(vocabulary("piece_bpe_32k.model"))
    monkeypatch.setattr(subword, "LONG", 8)
    texts = ["a " + prose(3, 12).replace(" ", "") + " b c", "中文字符" * 5 + "x" * 20, "short words", "=" * 20 + " " * 18, "", *TEXTS]
    keys = np.arange(len(texts)) + 9
    ids, counts = subword.encode(texts, keys, pieces, rate, 7)
    for text, key, part in zip(texts, keys.tolist(), np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert part.tolist() == agenda(text, key, pieces, rate, 7)
        assert subword.decode(part, pieces) == text


def test_time_of_a_long_stretch_grows_with_its_length():
    pieces = subword.pieces(vocabulary("piece_bpe_32k.model"))
    letters = "".join(chr(97 + int(x)) for x in np.random.default_rng(5).integers(0, 26, 1 << 18))
    seconds = {}
    for size in (1 << 14, 1 << 15, 1 << 18):
        begin = time.process_time()
        ids, _ = subword.encode([letters[:size]], np.array([1]), pieces)
        seconds[size] = time.process_time() - begin
        assert subword.decode(ids, pieces) == letters[:size]
    assert seconds[1 << 18] < 40 * seconds[1 << 15]  # eight times the text; the square would be 64


def test_no_dropout_gives_the_library_segmentation(doc_rows):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for _, t in doc_rows if t and "▁" not in t]
    ids, counts = subword.encode(texts, np.zeros(len(texts), np.int64), subword.pieces(path), 0.0, 1)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == model.encode(texts)


def test_segmentations_decode_and_vary(spark, docs, doc_rows, no_docs):
    path = vocabulary("piece_bpe_32k.model")
    rows = subword.segmentations(docs, path).collect()
    assert len(rows) == len(doc_rows) and all(r.lossless for r in rows)
    assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in doc_rows)
    assert {r.n_pieces for r in rows if r.doc_id in (6, 7)} == {0}
    same = {r.doc_id: r.ids_sha256 for r in rows}
    assert same[1] != same[2]  # one text, two documents
    again = {r.doc_id: r.ids_sha256 for r in subword.segmentations(docs.repartition(5), path).collect()}
    assert again[1] == same[1] and again[11] == same[11]
    other = {r.doc_id: r.ids_sha256 for r in subword.segmentations(docs, path, seed=8).collect()}
    assert other[1] != same[1]
    assert subword.segmentations(no_docs, path).collect() == []


# Substring removal


def without_repeats(rows, k=13):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        if i is not None:
            for j in range(len(w) - k + 1):
                g = tuple(w[j : j + k])
                first[g] = min(first.get(g, i), i)
    for i, t in rows:
        w = (t or "").encode().split()
        keep = [True] * len(w)
        for j in range(len(w) - k + 1):
            if i is not None and first[tuple(w[j : j + k])] < i:
                keep[j : j + k] = [False] * k
        left = [x for x, yes in zip(w, keep, strict=True) if yes]
        yield (i, len(w), len(w) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())


def test_substring_removal_is_brute_force(docs, doc_rows):
    assert bag(debruijn.substring_dedup(docs)) == Counter(without_repeats(doc_rows))


def test_substring_removal_on_branching_passages(spark):
    # Windows that share a minimizer but not their whole piece, repeats inside a document, sources that change midway.
    w = prose(9, 60).split()
    rows = [(5, " ".join(w)), (3, " ".join(w[10:40])), (4, " ".join(w[20:55])), (9, " ".join(w[5:30] + ["new"] + w[5:30] + w[25:45]))]
    rows += [(7, " ".join(w[12:26])), (8, "a " * 40), (2, "a " * 30), (6, " ".join(w[30:60] + w[0:30]))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert bag(debruijn.substring_dedup(table)) == Counter(without_repeats(rows))


def test_substring_removal_of_nothing(no_docs):
    assert debruijn.substring_dedup(no_docs).collect() == []


# Line removal


def line_rows(rows, depth, singles=False):
    """Later copies of line windows deleted, ``singles``: of lines with a word too; documents in the order of their ids."""
    seen, out = set(), []
    order = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    gone = {}
    for i, t in order:
        lines = t.split("\n")
        out_lines = set()
        for j in range(len(lines) - depth + 1):
            window = tuple(lines[j : j + depth])
            if window in seen:
                out_lines |= set(range(j, j + depth))
            seen.add(window)
        for j, line in enumerate(lines if singles else []):
            if line.encode().split():
                if line in seen:
                    out_lines.add(j)
                seen.add(line)
        gone[i, t] = out_lines
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        left = "\n".join(x for j, x in enumerate(lines) if j not in gone.get((i, t), ()))
        out.append((i, len(lines), len(gone.get((i, t), ())), hashlib.sha256(left.encode()).hexdigest()))
    return Counter(out)


def test_line_removal_is_brute_force(docs, doc_rows):
    assert bag(line_runs.line_dedup(docs)) == line_rows(doc_rows, 2, singles=True)


@pytest.mark.parametrize("depth", [1, 3, 4, 7])
def test_deeper_suffix_ranks(spark, depth):
    import random

    pick = random.Random(depth)
    rows = [(i, "\n".join(pick.choice("abc") for _ in range(12))) for i in range(15)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_runs.marked(table, depth).selectExpr("row.doc_id", "n_lines", "n_removed", "sha2(coalesce(left, ''), 256)")
    assert bag(out) == line_rows(rows, depth)


def test_ranks_follow_the_suffix_order(spark):
    rows = [(1, "b\na\nc\nb\na"), (2, "a\nc\nz"), (3, "b\na\nq")]
    found = line_runs.repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    lines = dict(rows)
    shared = {}
    for r in found:
        shared.setdefault(r["rank"], set()).add(tuple(lines[r["doc"]].split("\n")[r["line"] : r["line"] + 2]))
    assert sorted(map(sorted, shared.values())) == [[("a", "c")], [("b", "a")]]


def test_stage_removes_copies_of_single_lines(spark):
    """Also without a repeated neighbour; blank lines only inside longer runs."""
    rows = [(1, "one\n\ntwo\n\nthree"), (2, "other\ntwo\nmore"), (3, "two"), (4, "three\n\nfour"), (5, "new\n\n \none\n\ntwo\nlast\nlast")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in line_runs.without_copies(table).collect()}
    assert left == {1: rows[0][1], 2: "other\nmore", 4: "\nfour", 5: "new\n\n \nlast"}


def test_line_removal_keeps_columns(docs, no_docs):
    out = line_runs.without_copies(docs)
    assert out.columns == docs.columns
    assert out.where("doc_id = 2").count() == 0  # nothing left
    assert out.where("doc_id in (6, 7, 8, 9)").count() == 5
    assert line_runs.without_copies(no_docs).collect() == []
