"""Page text, quality sampling, licence scan and the pipeline."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import html_text, licences, resampling

from .conftest import prose

# Page text

LONG = "Some words of the article that go on and on for quite a while here."
PAGE = f"""<!DOCTYPE html><html><head><title>Other words</title><style>p{{a:b}}</style><script>var a = "</p><article>";</script></head>
<body class="with-sidebar"><nav><ul><li><a href="/a">Menu</a></li><li><a href="/b">Words of a menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies and more words than the article has, in a long notice.</div>
<article><header><h1>Head &amp; line</h1></header><p><b>{LONG}<br><p>Second &lt;one&gt;,
 with\twhite   space &#233;&copy;<div class="ad">Buy this now, it is very cheap and good.</div><p>Last <a href="x">link</a>ed.</p>
<form>Name <input name="n"></form><section id="comments"><p>First! A reader comments here.</p></section></article>
<aside>Side words in a bar that nobody reads at all.</aside><footer>&copy; all of it, and a very long line of footer words to close.</footer></body></html>"""
TEXT = f"Head & line\n{LONG}\nSecond <one>, with white space é©\nLast linked."

CASES = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    ("<html></html>", ""),
    (PAGE, TEXT),
    ("no markup at all", "no markup at all"),
    ("<article><p>" + "word " * 50_000 + "</p></article>", ("word " * 50_000).strip()),
    ("<article><p>cut off in a <b", "cut off in a"),
    ("<article><p>a < b &amp b</article>", "a < b & b"),
    ("<article></article><footer>words of a footer</footer>", ""),
    ("<main><div><p>One two three.</p></div><div role='navigation'>x y</div><p>Four.</p></main>", "One two three.\nFour."),
]


def test_page_text(spark):
    rows = [(i, f"u{i}", page) for i, (page, _) in enumerate(CASES)] + [(0, None, PAGE), (None, "u", PAGE), (4, "u4", PAGE)]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, text int")
    expected = Counter((i, u, t, len(t)) for i, u, t in [(i, f"u{i}", t) for i, (_, t) in enumerate(CASES)] + [(0, None, TEXT), (None, "u", TEXT), (4, "u4", TEXT)])
    assert Counter(tuple(r) for r in html_text.extract(pages).select("page_id", "url", "text", "n_chars").collect()) == expected
    assert html_text.extract(pages.where("false")).collect() == []
    unlabelled = pages.where("html = 'no markup at all'")
    assert html_text.fitted_weights(unlabelled) == html_text.DEFAULT_WEIGHTS
    assert html_text.extract(unlabelled).first()["text"] == "no markup at all"


def best_region(scores):
    """Highest total of a contiguous part, by trying all."""
    return max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)


def test_region_has_the_highest_score():
    weights = {"word": 1.0, "link word": 0.2, "other tag": -2.5}
    import random

    pick = random.Random(5)
    for _ in range(200):
        counts = [pick.randrange(0, 6) for _ in range(pick.randrange(1, 12))]
        page = "<i>".join(" ".join("w" * n) for n in counts)
        scores = [x for n in counts for x in ([n * 1.0] if n else []) + [-2.5]][:-1]
        assert len(html_text.main_text(page, weights).split()) * 1.0 >= best_region(scores)


def test_weights_of_labelled_pages(spark):
    pages = spark.createDataFrame([(i, PAGE) for i in range(5)], "page_id long, html string")
    weights = html_text.fitted_weights(pages)
    assert weights["word"] > 0 and weights["link word"] > 0
    assert all(v < 0 for k, v in weights.items() if not k.endswith("word")) and weights["footer"] < weights["p"]
    within, without = html_text.kind_counts([PAGE] * 5)
    assert weights == html_text.weights_of(within, without)


# Quality


@pytest.fixture(scope="module")
def corpus(spark):
    import random

    pick = random.Random(1)
    good = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(300):
        n = pick.randrange(20, 60)
        if i % 5 == 0:
            text, mark = " ".join(f"{pick.choice(good)}%%" for _ in range(n)), (0, 0)
        elif i % 5 == 1:
            text, mark = " ".join(pick.choice(good) if pick.random() < 0.8 else pick.choice(["bad1", "bad2"]) for _ in range(n)), (1, 1)
        else:
            text, mark = " ".join(pick.choice(good) for _ in range(n)), (1, 0)
        rows.append((i, text))
        if i % 3:
            labels.append((i, *mark))
    labels += [(None, 1, 0), (5, None, None), (7, 1, 0), (7, 0, 0), (9999, 1, 0)]
    rows += [(300, None), (301, ""), (None, "w1 w2"), (302, "w1 " * 20_000), (2, rows[2][1])]
    return spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, kind int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_keeps_clean_and_rejects_junk(corpus):
    docs, labels = corpus
    out = resampling.resample(docs, labels).collect()
    assert len(out) == docs.count()
    kept = {k: np.mean([r.kept for r in out if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 5 == k]) for k in range(5)}
    assert kept[0] == 0 and kept[1] < 0.2 and min(kept[2], kept[3], kept[4]) > 0.9
    again = {r.doc_id: r.kept for r in resampling.resample(docs.repartition(7), labels).collect()}
    assert again == {r.doc_id: r.kept for r in out}
    left = resampling.selected(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in out)


def test_ratios_are_brute_force(corpus):
    docs, labels = corpus
    sample = resampling.labelled_kinds(labels).where("not held")
    first, second = resampling.ratios(docs.drop("kind").join(sample, "doc_id", "left"))
    kinds = {r.doc_id: r.kind for r in sample.collect()}
    bags = [np.zeros(resampling.BUCKETS) for _ in range(3)]
    for r in docs.collect():
        _, bucket = resampling.features([(r.text or "").encode()])
        for b in bucket.tolist():
            bags[0][b] += 1
            if kinds.get(r.doc_id):
                bags[kinds[r.doc_id]][b] += 1
    raw, target, toxic = bags
    used = np.flatnonzero(raw)
    assert np.allclose(first[used], np.log((target[used] + 1) / (raw[used] * target.sum() / raw.sum() + 1)), atol=1e-5)
    assert np.allclose(second[used], np.log((target[used] * toxic.sum() / target.sum() + 1) / (toxic[used] + 1)), atol=1e-5)


def test_quality_without_labels_or_rows(corpus):
    docs, labels = corpus
    assert all(r.kept and r.weight == 0 for r in resampling.resample(docs, labels.where("false")).collect())
    assert resampling.resample(docs.where("false"), labels).collect() == []


def test_draw_follows_the_weights(spark):
    """Over many seeds, the chance to be drawn is that of drawing one by one in proportion to exp(weight / temperature)."""
    weights, temperature, seeds = [0.0, 0.05, 0.1, -0.1, 0.15], 0.05, 4_000
    docs = spark.createDataFrame([(i, i * 7, w) for i, w in enumerate(weights)], "doc_id long, rid long, weight double")
    keys = spark.range(seeds).withColumnRenamed("id", "seed").join(docs)
    keys = keys.withColumn("key", F.col("weight") / temperature + resampling.gumbel(F.col("seed").cast("int"), "doc_id", "rid"))
    order = keys.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct((-F.col("key")).alias("key"), "doc_id"))).alias("order")).collect()
    odds = np.exp(np.array(weights) / temperature)
    first = odds / odds.sum()
    second = np.array([first[i] + sum(first[j] * odds[i] / (odds.sum() - odds[j]) for j in range(5) if j != i) for i in range(5)])
    for k, chance in ((1, first), (2, second)):
        drawn = Counter(e.doc_id for r in order for e in r.order[:k])
        share = np.array([drawn[i] for i in range(5)]) / seeds
        assert np.all(np.abs(share - chance) < 4 * np.sqrt(chance * (1 - chance) / seeds))
    top = next(r.order for r in order if r.seed == 3)
    for k, n in ((0.6, 3), (9, 5), (0, 0)):
        kept = {r.doc_id for r in resampling.draw(docs.coalesce(1), k, temperature, 3).collect() if r.kept}
        assert kept == {e.doc_id for e in top[:n]}


def test_texts_without_words_are_rejected(corpus):
    docs, labels = corpus
    bare = docs.sparkSession.createDataFrame([(900, "%%% ### @@@", 3), (901, " \n ", 3), (902, "w1 w2 w3 %%%", 3)], docs.schema)
    out = {r.doc_id: r for r in resampling.resample(docs.union(bare), labels).collect()}
    assert all(out[i].weight is None and not out[i].kept for i in (300, 301, 900, 901)) and out[902].weight is not None
    half = resampling.resample(docs, labels, k=0.5).collect()
    worded = sum(r.weight is not None for r in half)
    assert sum(r.kept for r in half) in (round(worded / 2), round(worded / 2) + 1)


def test_kth_largest(spark):
    values = [5, 5, 5, -7, 0, 1 << 62, -(1 << 62), 123456789012345, -1, 77]
    table = spark.createDataFrame([(v,) for v in values], "key long")
    ranked = sorted(values, reverse=True)
    assert [resampling.kth_largest(table, "key", k) for k in range(1, 11)] == ranked
    assert resampling.kth_largest(table, "key", 11) is None and resampling.kth_largest(table, "key", 0) is None


# Licences

STATED = [
    ("Licensed under the Apache License, Version 2.0.", "Apache"),
    ("Released under the MIT License.", "MIT"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
    ("This library may be used under the terms of the GNU Lesser General Public License.", "LGPL"),
    ("Source code is licensed under the BSD 3-Clause License.", "BSD"),
]


NEAR = [
    ("Released under the Eclipse Public License 2.0.", "EPL"),
    ("SPDX-License-Identifier: EPL-2.0", "EPL"),
    ("This work is licensed under CC BY-ND 4.0.", "CC-BY-ND"),
    ("This work is licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA"),
    ("Published under CC BY-NC-ND 4.0.", "CC-BY-NC-ND"),
    ("Released under the Mozilla Public License 2.0.", "MPL"),
    ("This work is licensed under CC BY 4.0.", "CC-BY"),
    ("This program is distributed under the terms of the GNU Affero General Public License.", "AGPL"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL"),
    ("This project is licensed under the zlib License.", "zlib"),
]


def test_neighbouring_families_are_told_apart(spark):
    """Every statement gets its own family or none, and nearly all of them theirs; a wrong prediction is not confirmed."""
    rows = [(i, prose(i, 60) + "\n" + line + "\n" + prose(i + 99, 30)) for i, (line, _) in enumerate(NEAR)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.family for r in licences.licences(docs).collect()}
    assert {i: NEAR[i][1] for i in found} == found and len(found) >= len(NEAR) - 1
    known = licences.templates(spark).collect()
    for line, family in NEAR:  # each family predicted in turn: brute force over the templates
        terms = set(spark.createDataFrame([(line,)], "t string").select(licences.terms(F.col("t")).alias("x")).first().x)
        named = {r.family: [set(t.terms) for t in r.templates if t.need == "" or t.need in terms] for r in known}
        held = {f: max((len(terms & t) / len(t), len(terms & t), sorted(terms & t)) for t in ts) for f, ts in named.items() if ts}
        for name, (share, n, own) in held.items():
            rivals = [t & terms for f, ts in named.items() if f != name for t in ts if len(t & terms) / len(t) >= licences.CONFIRMED]
            confirmed = share >= licences.CONFIRMED and not any(len(r) > n and set(own) <= r for r in rivals)
            assert not confirmed or name == family, (line, name)


def test_licences_are_found_and_prose_is_not(spark):
    rows = [(i, prose(i, 60) + "\n" + line + "\n" + prose(i + 99, 30)) for i, (line, _) in enumerate(STATED)]
    clean = [(100 + i, prose(200 + i, 80)) for i in range(60)]
    clean += [(170, "Wir gehen mit dem Hund.\nDie Lizenz ist mit dabei."), (171, None), (172, ""), (173, "w " * 100_000), (None, "No licence here.")]
    extra = [(4, rows[4][1]), (None, STATED[1][0])]
    docs = spark.createDataFrame([(*r, "MIT", 0.5) for r in rows + clean + extra], "doc_id long, text string, family string, probability double")
    found = licences.scan(docs).where("confirmed").collect()
    got = Counter((r.doc_id, r.family, r.text) for r in found)
    assert got == Counter([(i, f, line) for i, (line, f) in enumerate(STATED)] + [(4, "LGPL", STATED[4][0]), (None, "MIT", STATED[1][0])])
    plan = licences.licences(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert licences.scan(docs.where("false")).collect() == []


WRAPPED = [
    ("Redistribution and use in source and binary forms, with or\nwithout modification, are permitted provided that the following\nconditions are met:", "BSD"),
    ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\nfiles", "MIT"),
    ("This program and the accompanying materials are made available\nunder the terms of the Eclipse Public\nLicense", "EPL"),
]


def test_wrapped_notices_are_found_once(spark):
    rows = [(i, prose(i, 60) + "\n" + text + "\n\n" + prose(i + 99, 30)) for i, (text, _) in enumerate(WRAPPED)]
    rows += [(10, "Released under the MIT License.\nReleased under the MIT License.\nshort line\nanother one"), (11, "a\nb\n\nc\nd"), (12, None)]
    rows += [(0, rows[0][1])] + [(100 + i, prose(200 + i, 80)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licences.scan(docs).where("confirmed").collect()
    got = Counter((r.doc_id, r.family) for r in found)
    assert got == Counter([(0, "BSD"), (0, "BSD"), (1, "MIT"), (2, "EPL"), (10, "MIT"), (10, "MIT")])
    for r in found:
        assert r.text == "\n".join(dict(rows)[r.doc_id].split("\n")[r.paragraph : r.paragraph + r.n_lines])
    units = {(r.paragraph, r.n_lines, r.text) for r in licences.paragraphs(docs.where("doc_id in (10, 11)")).collect()}
    assert units == {
        (0, 1, "Released under the MIT License."), (1, 1, "Released under the MIT License."), (2, 1, "short line"), (2, 2, "short line\nanother one"),
        (3, 1, "another one"), (0, 1, "a"), (0, 2, "a\nb"), (1, 1, "b"), (3, 1, "c"), (3, 2, "c\nd"), (4, 1, "d"),
    }


# Pipeline


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (20, 1, 0), (21, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = " ".join(prose(30, 70).split()[:40])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows, counts = docs, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, str(tmp_path))
        if number < 4:
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(f"{tmp_path}/{name}")
        rows = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(Counter(r.doc_id for r in rows.select("doc_id").collect()))
    assert counts[1][2] == 0 and counts[2][9] == 1 and counts[3][30] == 0 and counts[3][31] == 1
    assert rows.where("not lossless").count() == 0
    assert counts[4] == Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []
