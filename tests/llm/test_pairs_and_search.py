"""Near duplicates, decontamination and top-k search against plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from shelfline.llm import decontamination, simhash, topk
from shelfline.llm.common import components

from .conftest import prose


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Component of each distinct fingerprint."""
    name = {p: p for p in prints}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                name[root(a)] = root(b)
    return {p: root(p) for p in prints}


def test_near_duplicates_are_brute_force(docs, doc_rows):
    prints = [(i, fingerprint(t)) for i, t in doc_rows]
    root = groups({p for _, p in prints})
    low = {}
    for i, p in prints:
        if i is not None:
            low[root[p]] = min(low.get(root[p], i), i)
    expected = Counter((i, f"{p:016x}", low.get(root[p])) for i, p in prints)
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == expected


@pytest.mark.parametrize("tile", [4, 1024])
def test_links_of_close_fingerprints(spark, tile):
    """Chains and clusters of fingerprints, with tiles smaller than the clusters too."""
    pick = np.random.default_rng(3)
    prints = set(pick.integers(0, 2**63, 40).tolist()) | {0, 2**64 - 1}
    for p in list(prints):
        for _ in range(4):
            for _ in range(int(pick.integers(1, 5))):
                p ^= 1 << int(pick.integers(0, 64))
            prints.add(p)
    centre = int(pick.integers(0, 2**63))
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 5) if a != b}
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    found = components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), tile)).collect()
    part = {r["node"] & (1 << 64) - 1: r["component"] for r in found}
    root = groups(prints)
    sizes = Counter(root.values())
    assert set(part) == {p for p in prints if sizes[root[p]] > 1}
    assert len(set(part.values())) == sum(n > 1 for n in sizes.values())
    assert len({(part[p], root[p]) for p in part}) == len(set(part.values()))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3), (200, 100)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}


def test_one_of_each(docs, no_docs):
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    ids = Counter(r[0] for r in left.select("doc_id").collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[15] == 0 and ids[12] == 0 and ids[9] == 1 and ids[7] == 0 and ids[6] == 1
    assert simhash.one_of_each(no_docs).collect() == []
    assert simhash.near_duplicates(no_docs).collect() == []


# Decontamination

ITEM = " ".join(prose(50, 40).split())


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, ITEM), (2, None), (None, "x y"), (3, "Just three words"), (4, ""), (5, prose(51, 18)), (5, prose(51, 18)), (6, "...")]
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rid int")


def test_decontamination_is_brute_force(spark, benchmark):
    w = ITEM.split()
    changed = " ".join([*w[:20], "other", *w[21:]])  # 5 of 36 shingles differ
    cut = " ".join(w[:30])
    rows = [(1, prose(60, 90) + "\n" + ITEM.upper().replace(" ", ", ") + " " + prose(61, 30)), (2, "x " + changed), (3, cut + " " + prose(62, 50)), (4, None)]
    rows += [(5, ""), (None, ITEM), (6, "so: just THREE words."), (7, ITEM + " " + ITEM), (7, ITEM + " " + ITEM), (8, prose(63, 5000)), (9, prose(51, 18))]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, item_id string")

    def fold(t):
        return "".join(c if not (ord(c) < 128 and decontamination.GAPS[ord(c)]) else " " for c in (t or "").lower()).split()

    def bag(words):
        k = min(5, len(words))
        return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))

    expected = Counter()
    for i, t in rows:
        words = fold(t)
        for item, text in {(r.item_id, r.text) for r in benchmark.collect() if r.item_id is not None}:
            x = fold(text)
            if not x:
                continue
            best = max(
                ((sum((bag(words[s : s + len(x)]) & bag(x)).values()) / sum((bag(words[s : s + len(x)]) | bag(x)).values()), -s) for s in range(len(words) - len(x) + 1)),
                default=(0, 0),
            )
            if best[0] >= 0.8:
                expected[i, item, -best[1], len(x), round(best[0], 6)] += 1
    found = Counter(tuple(r) for r in decontamination.decontamination(docs, benchmark).collect())
    # The radius may miss a window just over the threshold; none of these is.
    assert found == expected and {k[0] for k in found} == {1, None, 6, 7, 9}
    left = decontamination.clean(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 5, 8]


def test_similar_windows_are_found(spark, benchmark):
    """One changed word near an end leaves 34 of 36 shingles."""
    w = ITEM.split()
    docs = spark.createDataFrame([(i, " ".join([*prose(70 + i, 30).split(), *w[:i], "other", *w[i + 1 :]])) for i in (0, 1, 38, 39)], "doc_id long, text string")
    assert {r.doc_id for r in decontamination.matches(docs, benchmark).collect()} == {0, 1, 38, 39}


def test_texts_shorter_than_the_item_are_compared_whole(spark, benchmark):
    """prose(51, 18) is item 5 of 18 words, thus 14 shingles: without 1 or 2 words 13 or 12 of 14 are left, without 3 only 11."""
    w, long = prose(51, 18).split(), ITEM.split()
    rows = [(1, w[1:]), (2, w[:-1]), (3, w[1:-1]), (4, w[2:]), (5, w[3:]), (6, w[1:-2]), (7, long[:33]), (8, long[:32]), (9, [*long[:34], "other"]), (10, w[:3])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.first_word, r.n_words, round(r.similarity, 6)) for r in decontamination.matches(docs, benchmark).collect()}
    expected = {(1, 5, 0, 17, 0.928571), (2, 5, 0, 17, 0.928571), (3, 5, 0, 16, 0.857143), (4, 5, 0, 16, 0.857143)}
    assert found == expected | {(7, 1, 0, 33, round(29 / 36, 6)), (9, 1, 0, 35, round(30 / 37, 6))}
    assert sorted(r.doc_id for r in decontamination.clean(docs, benchmark).collect()) == [5, 6, 8, 10]


def test_decontamination_of_nothing(docs, no_docs, benchmark):
    assert decontamination.matches(no_docs, benchmark).collect() == []
    assert decontamination.clean(docs, benchmark.where("false")).count() == docs.count()


def test_index_finds_all_within_radius():
    pick = np.random.default_rng(1)
    prints = pick.integers(0, 2**63, 50).astype(np.uint64)
    index = decontamination.Items._index(prints)
    for i, p in enumerate(prints.tolist()):
        for _ in range(30):
            q = p
            for b in pick.choice(64, decontamination.RADIUS, replace=False).tolist():
                q ^= 1 << b
            assert any(i in block.get((q >> low) & ((1 << width) - 1), ()) for block, (low, width) in zip(index, decontamination.PARTS, strict=True))


# Top-k search


def brute_top(rows, every, k):
    """Every row is a candidate of every other id's row, as in the query's SQL."""
    good = []
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(1024 * x) for x in v):
            whole = tuple(math.floor(1024 * x) for x in v)
            if sum(x * x for x in whole) <= topk.LARGEST:
                good.append((i, whole))
    out = Counter()
    for q in {i for i, _ in good if i % every == 0}:
        pairs = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for i, v in good for j, w in good if i == q and j != q and len(v) == len(w)]
        for rank, (s, j) in enumerate(sorted(pairs)[:k], 1):
            out[q, rank, j, -s] += 1
    return out


def test_large_finite_components_and_repeated_rows(spark):
    """Scores beyond what a double holds exactly, vectors beyond the range, and rows that count more than once."""
    pick = np.random.default_rng(5)
    rows = [(i, [float(x) for x in pick.integers(-400_000, 400_000, 4)]) for i in range(60)]
    rows += [(60 + i, [rows[3][1][0], rows[3][1][1], rows[3][1][2], rows[3][1][3] + i / 1024]) for i in range(20)]
    rows += [(100, [1e12, 1.0, 2.0, 3.0]), (101, [1e30] * 4), (102, [1e308, -1e308, 0.0, 0.0]), (0, rows[0][1]), (7, rows[7][1]), (7, rows[7][1]), (7, rows[8][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in topk.top_k(table, every=10).collect()) == brute_top(rows, 10, 10)


def test_top_k_is_brute_force(spark):
    pick = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in pick.normal(size=8)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # one vector in many rows
    rows += [(400, None), (500, [1.0, None, *[0.0] * 6]), (600, [math.nan] * 8), (700, [math.inf] + [0.0] * 7), (800, []), (900, [0.5, 0.5]), (None, [1.0] * 8)]
    rows += [(1200, rows[7][1]), (1200, rows[7][1]), (1300, [0.25, 0.25])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, query string")
    assert Counter(tuple(r) for r in topk.top_k(table, every=50).collect()) == brute_top(rows, 50, 10)
    assert topk.top_k(table.where("false")).collect() == []


# The pipeline's near duplicates


def test_stage_groups_are_brute_force(spark, doc_rows):
    """The pipeline's stage keeps the smallest id of each group of the query; rows without an id come last."""
    import random

    pick = random.Random(4)
    rows = [r for r in doc_rows if len(r[1] or "") < 50_000] + [(None, prose(777, 50)), (None, prose(777, 50)), (None, prose(778, 50))]
    for base in range(12):
        words = prose(300 + base, pick.choice([6, 9, 30, 60, 110, 240])).split()
        for k in range(10):
            new = list(words)
            for _ in range(pick.randrange(0, 3)):
                new[pick.randrange(len(new))] = f"changed{pick.randrange(10**6)}"
            rows.append((1000 + 100 * base + k, " ".join(new)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    root = groups({fingerprint(t) for _, t in rows})
    members = {}
    for i, t in rows:
        members.setdefault(root[fingerprint(t)], []).append(i)
    left = Counter(r.doc_id for r in simhash.one_of_each(table).collect())
    assert left == Counter(min((i for i in m if i is not None), default=None) for m in members.values())
    assert left[None] == 2 and len(left) < len(rows) - 40
