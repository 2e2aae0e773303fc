"""Mixing, the prefix trie and periodic runs against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import mixing, periodic, turn_trie

EMPTY = hashlib.sha256(b"").hexdigest()


# --- mixing


def expected_targets(sizes):
    """Target of each source, in rising order of rounds."""
    names = sorted(k for k in sizes if k is not None) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return {s: float(2 * sizes[s]) for s in names}
        unit = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in rest)
        more = {s for s in rest if weight[s] * unit > 2 * sizes[s]}
        if not more:
            return {s: float(2 * sizes[s] if s in full else weight[s] * unit) for s in names}
        full |= more


@pytest.fixture(scope="module")
def sourced(docs):
    """Sources with a hot one, an empty one, one without words and null."""
    k = F.coalesce(F.col("doc_id"), F.lit(0))
    source = F.when(k % 3 == 0, "hot").when(k == 7, "wordless").when(k == 11, "long").when(k % 7 == 1, "").when(k % 7 == 2, None).otherwise(F.concat(F.lit("s"), k % 5))
    return docs.withColumn("source", source)


def test_every_source_takes_its_target_and_no_document_more_than_twice(sourced):
    rows = sourced.select("doc_id", "text", "source").collect()
    size = [len((r.text or "").encode().split()) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, size, strict=True):
        sizes[r.source] += n
    want = expected_targets(sizes)
    got = mixing.taken(sourced).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == Counter(
        (r.doc_id, n, sizes[r.source], round(want[r.source], 6)) for r, n in zip(rows, size, strict=True)
    )
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    taken, goal = Counter(), Counter()
    for r in got:
        taken[r.source_size, r.target] += r.taken
    for s, n in sizes.items():
        goal[n, want[s]] += round(want[s])
    assert {(n, round(t, 6)): k for (n, t), k in taken.items()} == {(n, round(t, 6)): k for (n, t), k in goal.items()}
    again = mixing.taken(sourced.repartition(7)).collect()
    assert Counter(again) == Counter(got)


def test_the_mix_itself_holds_the_words_that_are_counted(sourced):
    counted = Counter()
    for r in mixing.mixture(sourced).collect():
        counted.update(r.text.split(" "))
        assert len(r.text.split(" ")) <= mixing.BLOCK
    size = sum(r.taken for r in mixing.taken(sourced).collect())
    assert sum(counted.values()) == size
    own = Counter()
    for r in sourced.select("text").collect():
        own.update((r.text or "").replace("\n", " ").split())
    assert all(n <= 2 * own[w] for w, n in counted.items())


def test_shard_counts_follow_the_targets(spark):
    """Means of the draws over shards, and no source's slots lost."""
    sources = spark.createDataFrame([("a", 400_000, 0, 600_000.0), ("b", 1_000_000, 1, 300_000.0), ("c", 300, 2, 500.4)], "source string, source_size long, rank long, target double")
    old = mixing.SHARD_SLOTS, mixing.GROUP_SHARDS
    mixing.SHARD_SLOTS, mixing.GROUP_SHARDS = 64, 16
    try:
        rows = mixing.slots(sources).collect()
    finally:
        mixing.SHARD_SLOTS, mixing.GROUP_SHARDS = old
    words, seen, shards = Counter(), defaultdict(list), defaultdict(Counter)
    for r in rows:
        words[r.rank] += r.take
        seen[r.rank].append(r.slot)
        shards[r.shard][r.rank] += 1
    assert words == {0: 600_000, 1: 300_000, 2: 500}
    assert all(sorted(x) == list(range(len(x))) for x in seen.values())
    lap = Counter(r.block for r in rows if r.rank == 0 and r.slot < 1563)
    assert set(lap.values()) == {1} and len(lap) == 1563  # the first lap has every block once
    assert max(Counter(r.block for r in rows if r.rank == 0).values()) == 2
    a = np.array([c[0] for c in shards.values()])
    assert len(shards) >= 55 and abs(a.mean() - 2344 / len(shards)) < 1 and 0.5 < a.var() / a.mean() < 1.7  # a multinomial's spread


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutations_hit_every_index(n):
    for key in (0, 1, 2**63):
        assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))
    if n > 60:
        assert (mixing.permuted(np.arange(n), n, 1) != mixing.permuted(np.arange(n), n, 2)).any()


def test_mixing_nothing(no_docs, spark):
    assert mixing.taken(no_docs).collect() == [] and mixing.mixture(no_docs).collect() == []
    wordless = spark.createDataFrame([(1, None, "a"), (2, "", None), (2, " ", None)], "doc_id long, text string, source string")
    assert Counter(tuple(r) for r in mixing.taken(wordless).collect()) == Counter([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])


# --- prefix trie


def expected_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = convs.get(base, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, m in nodes.items():
        own = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += own
            leaves[k[:d]] += kids[k] == 0
    out = Counter()
    for k, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        out[min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def conversations(seed, n, texts, longest=12):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(-n // 4, 2 * n), n):
        for turn in range(pick.randrange(0, longest)):
            rows.append((c, turn * 2 if turn else pick.choice([None, 0]), pick.choice(["user", "user", None]), pick.choice(texts)))
    return rows


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_trie_is_brute_force(spark, parts):
    """Partition borders inside deep shared prefixes too: few texts make neighbours share most turns."""
    rows = conversations(parts, 150, ["a", "é", "", None]) + conversations(50 + parts, 40, ["x"], 30)
    rows += [(5000 + 5 * i, t, "user", "copy") for i in range(30) for t in range(4)]  # copies of one conversation
    rows += [(None, 0, "user", "lost"), (9001, 0, "user", "a"), (9001, 0, "user", "a")]
    seen, unique = set(), []
    for r in rows:  # one turn number, one text, but for copies
        if r[0] == 9001 or (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            unique.append(r)
    table = spark.createDataFrame([(*r, 0, "x") for r in unique], "conv_id long, turn long, role string, text string, key int, seq string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = turn_trie.prefix_trie(turn_trie.rebuilt(turn_trie.sequences(table))).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert Counter(tuple(r) for r in got) == expected_trie(unique)


def test_trie_of_one_turnless_conversation_and_of_nothing(spark):
    one = spark.createDataFrame([(1, [])], "conv_id long, t array<struct<a: long, b: long, n: long>>")
    assert [tuple(r) for r in turn_trie.prefix_trie(one).collect()] == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
    assert turn_trie.prefix_trie(one.where("false")).collect() == []


# --- periodic runs


def expected_runs(w):
    n, out = len(w), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= 2 * q and not any(q % d == 0 and w[i : i + q - d] == w[i + d : i + q] for d in range(1, q)):
                out.add((i, j + q - i, q))
            i = max(i + 1, j)
    return sorted(out)


def periodic_words(pick):
    words = []
    for _ in range(pick.randrange(0, 6)):
        letters = pick.choice([1, 2, 3, 50])
        lap = [f"w{pick.randrange(letters)}" for _ in range(pick.randrange(1, pick.choice([4, 12, 30, 70])))]
        kind = pick.randrange(4)
        if kind == 0:
            words += lap
        elif kind == 1:
            words += (lap * pick.randrange(2, 6))[: pick.randrange(1, 400)]
        elif kind == 2:
            words += ((["w0"] * pick.randrange(1, 60) + ["w1"]) * 4)[: pick.randrange(1, 300)]
        else:
            words += ((lap * pick.randrange(2, 5) + ["w9"]) * pick.randrange(2, 5))[:400]
    return words


def test_runs_are_brute_force():
    pick = random.Random(5)
    found = 0
    for _ in range(120):
        texts = [periodic_words(pick) for _ in range(pick.randrange(1, 5))]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        h = np.array([zlib.crc32(w.encode()) * 0x9E3779B97F4A7C15 % 2**64 for t in texts for w in t], dtype=np.uint64)
        for words, got in zip(texts, periodic.runs_of(h, first), strict=True):
            assert got == expected_runs(words)
            found += len(got)
    assert found > 1000


def test_query_rows_are_brute_force(spark, docs, doc_rows):
    pick = random.Random(6)
    more = [(i, " ".join(periodic_words(pick))) for i in range(100, 260)] + [(1000, "a " * 20_000), (1001, None)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    table = docs.unionByName(extra, allowMissingColumns=True)
    expected = Counter()
    for doc, text in doc_rows + more:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 5000:
            runs = [(0, n, 1)] if len(set(words)) == 1 else []
        else:
            runs = [r for r in expected_runs(words) if r[1] >= 24]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected[doc, len(runs), *row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest()] += 1
    got = periodic.digests(periodic.periodic(table, periodic.planted(table)))
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_periodic_operator_returns_texts_and_spans(spark, no_docs):
    table = spark.createDataFrame([(1, "x y " * 12 + "z"), (2, None), (None, "a\tb")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, [tuple(s) for s in r.spans], r.left) for r in periodic.periodic(table).collect()}
    assert got == {1: (25, [(0, 24, 2)], "x y z"), 2: (0, [], ""), None: (2, [], "a b")}
    assert periodic.periodic(no_docs).collect() == []
