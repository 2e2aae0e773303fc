"""Licence scan by a trained paragraph classifier, DataFrame functions only.

A paragraph (a line of a text, or up to ``WRAPPED`` neighbouring lines of one wrapped sentence) becomes a sparse vector of
hashed words and word pairs. A multinomial logistic regression
gives the probability of each licence family and of "unknown". It is trained on statements made from the families' names
and usual phrasings, on their notices, and, as unknown, on the same phrasings with other names and on a bounded sample of
paragraphs from the corpus. The unknown class is calibrated on held-out rows: a family is accepted only above the
probability that held-out unknown paragraphs stay under, save for a share ``FALSE_SHARE``. An accepted paragraph is then
compared with the templates of its family, and confirmed if it holds enough of the words and word pairs of one of them. It is
not confirmed where another family's template explains all of these and more: "CC BY-NC" in a statement of "CC BY-NC-SA".
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import sample_of, stored

UNKNOWN = "unknown"
WORD = r"[\p{L}\p{N}]"
FEATURES = 1 << 13
CORPUS_SAMPLE = 8_000  # paragraphs of the corpus used in training
HELD_OUT = 0.25
FALSE_SHARE = 0.001
LEAST = 0.5  # least probability of an accepted family
CONFIRMED = 0.6  # share of a template's words and word pairs
WRAPPED = 4  # lines taken together, at most
WIDTH = 120  # characters of a line that may go on in the next one, at most

# Licence families and the names they go by.
NAMES = {
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3", "GNU AGPL"],
    "Apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0", "Apache License"],
    "BSL": ["Boost Software License", "Boost Software License 1.0", "BSL-1.0", "Boost Software License, Version 1.0"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "New BSD License", "Simplified BSD License"],
    "CC-BY": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "CC BY 3.0", "Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0", "CC BY-NC 3.0", "CC BY-NC"],
    "CC-BY-NC-ND": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC-BY-NC-ND-4.0", "CC BY-NC-ND 3.0", "CC BY-NC-ND"],
    "CC-BY-NC-SA": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC-BY-NC-SA-4.0", "CC BY-NC-SA 3.0", "CC BY-NC-SA"],
    "CC-BY-ND": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC-BY-ND-4.0", "CC BY-ND 3.0", "CC BY-ND"],
    "CC-BY-SA": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0", "CC BY-SA 3.0", "CC BY-SA"],
    "CC0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "CC0 1.0 Universal Public Domain Dedication"],
    "EPL": ["Eclipse Public License", "Eclipse Public License, version 2.0", "EPL-2.0", "Eclipse Public License 2.0", "EPL 2.0", "EPL-1.0"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License, version 2", "GPL-3.0", "GPLv3", "GPLv2", "GNU GPL"],
    "ISC": ["ISC License", "ISC"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3", "LGPL-2.1", "GNU LGPL"],
    "MIT": ["MIT License", "MIT", "Expat License", "The MIT License (MIT)"],
    "MPL": ["Mozilla Public License", "Mozilla Public License, version 2.0", "MPL-2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense", "The Unlicense"],
    "zlib": ["zlib License", "zlib/libpng License"],
    UNKNOWN: ["standard terms", "supplier agreement", "house rules", "terms of the publisher", "general terms of sale", "name of the author", "old county charter", "rules of the club", "direction of the board", "same roof"],
}
PHRASES = [
    "Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.", "Distributed under the {}.",
    "Published under {}.", "Made available under the {}.", "Available under {}.", "This work is licensed under the {}.",
    "This work is licensed under {}.", "This project is licensed under the {}.", "This software is released under the {}.",
    "This program is distributed under the terms of the {}.", "This text may be used under the {}.", "The code is under the {}.",
    "License: {}", "Licence: {}", "SPDX-License-Identifier: {}", "You may use this file under the terms of the {}.",
    "All content is provided under {}.", "Subject to the {}, this file may be copied.", "See the {} for details.",
    "Copyright the authors. Licensed under the {}.", "This page and its pictures are under {} unless noted otherwise.",
]
NOTICES = {
    "Apache": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    UNKNOWN: [
        "All rights reserved.", "Permission to speak was granted by the chair.", "The licence fee is due in spring.", "He lost his driving licence.",
        "Copies of the report are free of charge.", "The public may use the general entrance.", "Version 2.0 of the plan was released in May.",
        "They were released under supervision.", "The terms of the contract are subject to the law.", "A license plate was found near the creative arts centre.",
    ],
}


def words(text: Column) -> Column:
    """Lower-case words: runs of letters, marks and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def terms(text: Column) -> Column:
    """Words and pairs of neighbouring words."""
    one = words(text)
    pairs = F.zip_with(one, F.slice(one, 2, F.greatest(F.size(one) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(one, F.slice(pairs, 1, F.greatest(F.size(one) - 1, F.lit(0))))


def _statements(spark: SparkSession) -> DataFrame:
    """(family, text, template, need) of all names in all phrases and of the notices; need: a word that must be held, or empty."""
    named = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(n).alias("name")) for f, names in NAMES.items() for n in names))
    made = spark.range(1).select(F.explode(named).alias("s")).select("s.family", "s.name", F.explode(F.array(*map(F.lit, PHRASES))).alias("phrase"))
    made = made.select("family", F.replace("phrase", F.lit("{}"), F.col("name")).alias("text"), "name")
    # A name of one word is also a word of some language: its templates are the whole statements.
    # These must hold the name, as the rest of the statement fits every family.
    several, named_by = F.size(words(F.col("name"))) > 1, F.element_at(words(F.col("name")), 1)
    made = made.select("family", "text", F.when(several, F.col("name")).otherwise(F.col("text")).alias("template"), F.when(several, "").otherwise(named_by).alias("need"))
    noted = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(n).alias("text")) for f, notices in NOTICES.items() for n in notices))
    notes = spark.range(1).select(F.explode(noted).alias("s")).select("s.family", "s.text", F.col("s.text").alias("template"), F.lit("").alias("need"))
    return made.union(notes)


def templates(spark: SparkSession) -> DataFrame:
    """(family, templates): for each family the terms of its names and notices, and the word each needs, if any."""
    known = _statements(spark).where(F.col("family") != UNKNOWN).select("family", F.struct(F.array_distinct(terms(F.col("template"))).alias("terms"), "need").alias("template"))
    return known.groupBy("family").agg(F.collect_set("template").alias("templates"))


def _named(template: Column) -> Column:
    return (template["need"] == "") | F.array_contains(F.col("terms"), template["need"])


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, paragraph, n_lines, text): every line with a word, numbered from 0, and wrapped lines taken together.

    A line goes on in the next one if it has ``WIDTH`` characters at most, does not end with . ! ? or :, and the next line
    holds a word. At each line that goes on start a paragraph of two lines and, if it goes on further, one of up to
    ``WRAPPED``. Lines of one paragraph are joined by a line break. ``rid`` is a hash of the whole text.
    """
    text = F.col("text").cast("string")
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("rid"), F.split(text, "\n").alias("lines"))
    goes_on = F.transform("lines", lambda x: (F.char_length(x) <= WIDTH) & ~x.rlike(r"[.!?:]\s*$") & x.rlike(WORD))
    lines = lines.withColumn("goes_on", goes_on).select("*", F.posexplode("lines").alias("paragraph", "line")).where(F.col("line").rlike(WORD))

    def joined(n: int) -> Column:
        """The lines from this one on as far as they go on, ``n`` at most."""
        size = F.lit(n)
        for i in range(n - 1, 0, -1):
            here = F.coalesce(F.get("goes_on", F.col("paragraph") + i - 1), F.lit(False))
            more = F.coalesce(F.get("lines", F.col("paragraph") + i).rlike(WORD), F.lit(False))
            size = F.when(here & more, size).otherwise(F.lit(i))
        return F.struct(size.alias("n_lines"), F.array_join(F.slice("lines", F.col("paragraph") + 1, size), "\n").alias("text"))

    one = F.struct(F.lit(1).alias("n_lines"), F.col("line").alias("text"))
    several = F.filter(F.array_distinct(F.array(joined(2), joined(WRAPPED))), lambda x: x["n_lines"] > 1)
    wrapped = F.when(F.get("goes_on", F.col("paragraph")), F.concat(F.array(one), several)).otherwise(F.array(one))
    return lines.select("doc_id", "rid", "paragraph", F.inline(wrapped).alias("n_lines", "text"))


def _without_overlaps(found: DataFrame) -> DataFrame:
    """``found`` without unconfirmed wrapped paragraphs, those that hold a confirmed line of their family, and those near a better one.

    Of wrapped paragraphs of a family that start less than ``WRAPPED`` lines apart, the one that holds most of a template
    stays; ties go to fewer lines, then to the first.
    """
    found = found.where("n_lines = 1 or confirmed")
    family = Window.partitionBy("doc_id", "rid", "family").orderBy("paragraph")
    line = F.min(F.when(F.expr("n_lines = 1 and confirmed"), F.col("paragraph"))).over(family.rangeBetween(0, WRAPPED - 1))
    whole = F.when(F.col("n_lines") > 1, F.struct("alike", -F.col("n_lines"), -F.col("paragraph")))
    marked = found.withColumn("line", line).withColumn("whole", whole)
    named = F.coalesce(F.col("line") < F.col("paragraph") + F.col("n_lines"), F.lit(False))
    best = F.max(F.when(~named, F.col("whole"))).over(family.rangeBetween(1 - WRAPPED, WRAPPED - 1))
    marked = marked.withColumn("named", named).withColumn("best", best)
    return marked.where((F.col("n_lines") == 1) | (~F.col("named") & (F.col("whole") == F.col("best")))).drop("line", "whole", "named", "best")


class Classifier:
    """Families, the fitted model and the accepted probability."""

    def __init__(self, spark: SparkSession, lines: DataFrame, sample: int = CORPUS_SAMPLE):
        self.families = sorted(f for f in NAMES if f != UNKNOWN) + [UNKNOWN]
        number = F.array_position(F.array(*map(F.lit, self.families)), F.col("family")) - 1
        # The corpus sample: the paragraphs with the smallest hashes of their places, without those that hold a template.
        places = sample_of(lines.select("doc_id", "paragraph"), sample, "doc_id", "paragraph")
        some = lines.join(F.broadcast(places), ["doc_id", "paragraph"], "left_semi").select("text").distinct()
        held = self._alike(some.withColumn("terms", terms(F.col("text"))).crossJoin(F.broadcast(templates(spark))))
        other = held.groupBy("text").agg(F.max("alike").alias("alike")).where(F.col("alike") < CONFIRMED)
        # There is one notice of each wording, so notices are always trained on; statements and paragraphs may be held out.
        notice = (F.col("template") == F.col("text")) & (F.col("need") == "")
        rows = _statements(spark).select("family", "text", notice.alias("notice")).union(other.select(F.lit(UNKNOWN), "text", F.lit(False))).distinct()
        rows = rows.select("text", "notice", number.cast("double").alias("label"), terms(F.col("text")).alias("terms"))
        rows = rows.withColumn("held", F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1000)) < int(1000 * HELD_OUT)).withColumn("held", F.expr("held and not notice"))
        self.hashing = HashingTF(inputCol="terms", outputCol="features", numFeatures=FEATURES, binary=True)
        rows = stored(self.hashing.transform(rows).drop("terms"))
        regression = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=60, probabilityCol="p", rawPredictionCol="raw", predictionCol="best")
        self.model = regression.fit(rows.where("not held"))
        missed = self._with_family(self.model.transform(rows.where(f"held and label = {len(self.families) - 1}")))
        high = missed.agg(F.percentile("probability", F.lit(1 - FALSE_SHARE))).first()[0]
        self.least = min(0.99, max(LEAST, high or 0.0))

    def _with_family(self, scored: DataFrame) -> DataFrame:
        """Add the most probable family, unknown set aside, and its probability."""
        known = F.slice(vector_to_array("p"), 1, len(self.families) - 1)
        best = F.array_max(known)
        name = F.element_at(F.array(*map(F.lit, self.families)), F.array_position(known, best).cast("int"))
        return scored.withColumn("probability", best).withColumn("family", name)

    @staticmethod
    def _alike(rows: DataFrame) -> DataFrame:
        """Add ``alike``: the largest share of one template's terms among ``terms``."""
        share = F.transform("templates", lambda t: F.when(_named(t), F.size(F.array_intersect(t["terms"], F.col("terms"))) / F.size(t["terms"])).otherwise(F.lit(0.0)))
        return rows.withColumn("alike", F.array_max(share))

    def predict(self, lines: DataFrame) -> DataFrame:
        """``lines`` accepted as a family, with family, probability and alike (the template comparison)."""
        scored = self.model.transform(self.hashing.transform(lines.withColumn("terms", terms(F.col("text")))))
        accepted = self._with_family(scored).where(F.col("probability") >= self.least).drop("features", "raw", "p", "best")
        # Some twenty families, so their templates are broadcast.
        known = templates(lines.sparkSession)
        every = known.agg(F.collect_list(F.struct("family", "templates")).alias("every"))
        compared = self._alike(accepted.join(F.broadcast(known), "family")).join(F.broadcast(every))
        return compared.withColumn("confirmed", self._confirmed()).drop("templates", "terms", "every")

    @staticmethod
    def _confirmed() -> Column:
        """Whether enough of a template is held and no other family's template holds the same terms of the text and more."""

        def held(templates: Column) -> Column:
            """Of each template: its share held, the number of terms held, these terms."""
            named = F.filter(templates, _named)
            shared = F.transform(named, lambda t: F.struct(t["terms"].alias("t"), F.array_intersect(t["terms"], F.col("terms")).alias("held")))
            return F.transform(shared, lambda s: F.struct((F.size(s["held"]) / F.size(s["t"])).alias("share"), F.size(s["held"]).alias("n"), s["held"].alias("held")))

        own = F.array_max(held(F.col("templates")))
        others = F.flatten(F.transform(F.filter("every", lambda e: e["family"] != F.col("family")), lambda e: held(e["templates"])))
        rival = F.exists(others, lambda r: (r["share"] >= CONFIRMED) & (r["n"] > own["n"]) & (F.size(F.array_except(own["held"], r["held"])) == 0))
        return F.coalesce((F.col("alike") >= CONFIRMED) & ~rival, F.lit(False))


def scan(docs: DataFrame, sample: int = CORPUS_SAMPLE) -> DataFrame:
    """(doc_id, paragraph, n_lines, family, probability, alike, confirmed, text) of every paragraph accepted as a licence family.

    ``paragraph`` is its first line, ``n_lines`` the number of lines. Lines that are accepted and not confirmed are returned
    as such; wrapped paragraphs only if confirmed, and not beside a confirmed line of theirs. Null or empty text: no
    paragraphs. Null doc_id stays null; repeated rows give repeated rows; paragraphs of any length are classified whole. An
    empty table gives no rows. Ties between families go to the first by name. Other columns are ignored.
    """
    found = paragraphs(docs)
    found = Classifier(docs.sparkSession, found.where("n_lines = 1"), sample).predict(found)
    return _without_overlaps(found).select("doc_id", "paragraph", "n_lines", "family", "probability", "alike", "confirmed", "text")


def licences(docs: DataFrame) -> DataFrame:
    """Result of the query: doc_id, paragraph, n_lines, family, probability and alike (four digits), n_chars of confirmed licences."""
    found = scan(docs).where("confirmed")
    return found.select(
        "doc_id", "paragraph", "n_lines", "family", F.round("probability", 4).alias("probability"), F.round("alike", 4).alias("alike"),
        F.char_length("text").cast("long").alias("n_chars"),
    )
