"""Licence scans with a trained paragraph classifier (DataFrame operations and MLlib only).

A paragraph is a block of lines between blank ones (however it is wrapped); words are runs of letters and digits (with inner dots), in
lower case. The classifier is a multinomial logistic regression with L1 weights over word
1- to 3-grams, one class per licence family and one for unknown text.

Features: the templates' n-grams that hold a key term, a template word that is rare in
ordinary text (in at most ``RARE`` of a bounded paragraph sample, of 1,000 at least). A paragraph without a key
term has no feature, and the fit is refused unless the empty vector is unknown, so such
paragraphs are settled by the array test that looks for key terms, without a score.

Training rows: each template whole, its halves and its ``PART``-word stretches as their
family; the sample's paragraphs (up to ``SAMPLE`` rows with the smallest text hash, at most
``SAMPLE_CHARS`` characters each; bounded by these parameters), the mentions in ``MENTIONS``
and the empty text as unknown. Paragraphs that a template confirms are not used as unknown.
Calibration: the log odds of the best family against unknown, each training row's under weights
fitted on the other folds, fit a one-feature logistic regression, whose output is the
probability that the paragraph is a licence at all; below 0.5 it is unknown.

A paragraph is judged in windows of ``WINDOW`` words, half a window apart, so a notice inside a long paragraph is seen
like one that stands alone; each line of a paragraph of several lines is judged as well (a list of notices).
A window or line without a key term is settled as above.

Confirmation: how far a template covers a window is the share of the template's word pairs that the window holds, or of
the window's own pairs (two at least) that the template has, whichever is more; a family has its best
template's. A prediction counts if its family covers ``CONFIRM`` and every other family less than it does. So a
fragment that several families share confirms none of them, and a notice is not confirmed for a sister
family that shares most of its words.

Defined results: null and wordless texts have no paragraph and no licence; copies of a text
and repeated rows get the same result; a licence named twice in a text is listed once; without any
document there is nothing to train on and the result is empty; if the calibration would call an empty
paragraph a licence, its shift is lowered until it does not (``lowered`` on the classifier says so).
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, register, table, text_key

RARE = 0.005
SAMPLE = 4_000
SAMPLE_CHARS = 1_000
PART = 8
CONFIRM = 0.6
FOLDS = 3
WINDOW = 60
UNKNOWN = "unknown"

# Short notices of the licence families, as they stand in source files and on pages.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "You can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1 or version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("CC0", "This work is dedicated to the public domain under CC0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission."),
)
FAMILIES = sorted({family for family, _ in TEMPLATES})
# Sentences about licences that grant nothing.
MENTIONS = (
    "You need a licence to drive.", "The driver's license was renewed in version 3.", "MIT researchers published a paper.",
    "The Apache helicopter took off.", "A table was reserved for all.", "He has the rights of a citizen.",
    "The general public was invited.", "Read the license before you sign.", "This work is the best so far.",
    "The software is free of bugs.", "Attribution of the painting is disputed.", "The terms of the contract are under review.",
    "Released under pressure.", "The foundation published version 4.0 of the report.", "mit", "gnu", "cc", "all rights", "version 2.0",
)


def words(text: Column) -> Column:
    """Lower-case words: letters and digits, with dots inside kept (2.0)."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.][\p{L}\p{N}]+)*"), F.lit(0))


def grams(w: Column, n: int) -> Column:
    """Space-joined runs of ``n`` words."""
    last = F.size(w) - n
    runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(w, i + 1, n), " "))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<string>"))


def template_words(text: str) -> list[str]:
    """The same rule for the fixed texts above."""
    return re.findall(r"[^\W_]+(?:[.][^\W_]+)*", text.lower())


def runs(ws: list[str], n: int) -> list[str]:
    return [" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)]


def stretches(ws: list[str]) -> list[list[str]]:
    """The whole template, its halves, and its ``PART``-word stretches."""
    half = -(-len(ws) // 2)
    parts = [ws, ws[:half], ws[len(ws) - half:]]
    return parts + [ws[i:i + PART] for i in range(0, len(ws) - PART + 1, PART // 2) if len(ws) > PART]


def _array_sql(values) -> str:
    """A string array literal of fixed words and word pairs (letters, digits, dots, blanks only)."""
    return "array(" + ",".join(f"'{v}'" for v in values) + ")"


def _confirmed_by(family: str) -> str:
    """SQL: a template of the family shares ``CONFIRM`` of its word pairs, or of the window's, in ``pairs``."""
    tests = []
    for theirs in (sorted(set(runs(template_words(said), 2))) for f, said in TEMPLATES if f == family):
        both = f"size(array_intersect(pairs, {_array_sql(theirs)}))"
        tests.append(f"{both} >= {CONFIRM * len(theirs)} OR ({both} >= 2 AND {both} >= {CONFIRM} * size(array_distinct(pairs)))")
    return "(" + " OR ".join(tests) + ")"


def covers() -> Column:
    """How far each template, in the fixed order, covers the row's ``pairs``."""
    parts = []
    for _, said in TEMPLATES:
        theirs = sorted(set(runs(template_words(said), 2)))
        both = f"size(array_intersect(pairs, {_array_sql(theirs)}))"
        parts.append(f"greatest({both} / {len(theirs)}D, CASE WHEN {both} >= 2 THEN {both} / CAST(size(array_distinct(pairs)) AS DOUBLE) ELSE 0D END)")
    return F.expr("array(" + ", ".join(parts) + ")")


def confirmed() -> Column:
    """True if the row's ``family`` covers enough of its window by ``cover`` and every other family covers less."""
    of = {f: [i for i, (g, _) in enumerate(TEMPLATES) if g == f] for f in FAMILIES}
    best = lambda places: "array_max(array(" + ", ".join(f"cover[{i}]" for i in places) + "))"
    tests = [f"WHEN '{f}' THEN {best(of[f])} >= {CONFIRM} AND {best(of[f])} > {best([i for g in FAMILIES if g != f for i in of[g]])}" for f in FAMILIES]
    return F.expr("CASE family " + " ".join(tests) + " ELSE false END")


def paragraphs_of(text: Column) -> Column:
    """Blocks of lines between blank ones."""
    return F.split(text, r"\n[ \t\r\x0B\f]*(?:\n[ \t\r\x0B\f]*)+")


def windows(w: Column) -> Column:
    """A paragraph's words in windows, half a window apart; a short one is one window."""
    half = WINDOW // 2
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - half - 1, F.lit(0)), F.lit(half))
    return F.transform(starts, lambda i: F.slice(w, i + 1, WINDOW))


def paragraph_sample(paragraphs: DataFrame) -> DataFrame:
    """The ``SAMPLE`` different paragraphs (cut to ``SAMPLE_CHARS``) with the smallest hashes.

    A hash bound for a few times as many rows comes first, so that what is sorted does not grow with
    the number of tasks; it is raised until enough pass or all do. Copies collapse in their tasks."""
    n = max(1, paragraphs.count())
    cut = paragraphs.select(F.substring("said", 1, SAMPLE_CHARS).alias("said")) \
        .withColumn("h", F.shiftrightunsigned(F.xxhash64("said"), 1))
    share = min(1.0, 8 * SAMPLE / n)
    while True:
        some = cut if share >= 1 else cut.where(F.col("h") < F.lit(int(share * (1 << 63))))
        picked = materialise(some.distinct().orderBy("h", "said").limit(SAMPLE))
        if share >= 1 or picked.count() >= SAMPLE:
            return picked
        share = min(1.0, 8 * share)


class Classifier:
    """Vocabulary, weights and calibration; all tables are bounded by the templates and the sample."""

    def __init__(self, paragraphs: DataFrame):
        """``paragraphs``: (said), the corpus's lines; a bounded sample is taken by hash."""
        spark = paragraphs.sparkSession
        sample = paragraph_sample(paragraphs).select(words(F.col("said")).alias("w")).where(F.size("w") > 0)
        by_any = " OR ".join(_confirmed_by(f) for f in FAMILIES)
        ordinary = materialise(sample.withColumn("pairs", grams(F.col("w"), 2)).where(f"NOT ({by_any})").select("w"))
        n = max(1, ordinary.count())
        of_templates = sorted({w for _, said in TEMPLATES for w in template_words(said)})
        seen = {r["word"]: r["count"] for r in ordinary.select(F.explode(F.array_distinct("w")).alias("word")).where(
            F.col("word").isin(of_templates)).groupBy("word").count().collect()}  # words of the templates only
        self.key_terms = [w for w in of_templates if seen.get(w, 0) <= RARE * max(n, 1000) and not re.fullmatch(r"[0-9.]+", w)]
        keys = set(self.key_terms)
        self.vocabulary = sorted({g for _, said in TEMPLATES for k in (1, 2, 3) for g in runs(template_words(said), k)
                                  if keys.intersection(g.split(" "))})
        parts = [(f, part, i % FOLDS) for f, said in TEMPLATES for i, part in enumerate(stretches(template_words(said)))
                 if len(part) >= 3 and keys.intersection(part)]
        parts += [(UNKNOWN, template_words(m), i % FOLDS) for i, m in enumerate((*MENTIONS, "") * FOLDS)]
        unknown = ordinary.select(F.lit(UNKNOWN).alias("family"), "w", F.pmod(F.xxhash64("w"), F.lit(FOLDS)).cast("int").alias("fold"))
        rows = unknown.unionByName(spark.createDataFrame(parts, "family string, w array<string>, fold int"))
        self.labels = [UNKNOWN, *FAMILIES]
        index = F.array_position(F.expr(_array_sql(self.labels)), F.col("family")).cast("double") - 1
        share = rows.groupBy("family").agg((1 / F.count("*")).alias("weight"))
        self.vectors = CountVectorizerModel.from_vocabulary(self.vocabulary, "grams", "features")
        self.vectors.setBinary(True)
        data = materialise(self.vectors.transform(rows.withColumn("grams", self._grams(F.col("w")))
                                                  .withColumn("label", index)).join(share, "family")
                           .select("label", "features", "weight", "fold").coalesce(2))  # bounded by the sample
        self.model = self._fit(data)
        odds = None
        for fold in range(FOLDS):
            part = self._fit(data.where(F.col("fold") != fold)).transform(data.where(F.col("fold") == fold)).select(
                self._odds(F.col("rawPrediction")).alias("odds"), (F.col("label") > 0).cast("double").alias("label"),
                F.when(F.col("label") > 0, F.col("weight") / (len(self.labels) - 1)).otherwise(F.col("weight")).alias("weight"))
            odds = part if odds is None else odds.unionByName(part)
        self.calibration = LogisticRegression(weightCol="weight", regParam=0.01, maxIter=100).fit(
            VectorAssembler(inputCols=["odds"], outputCol="features").transform(odds))
        self.slope, self.shift = float(self.calibration.coefficients[0]), float(self.calibration.intercept)
        intercepts = self.model.interceptVector.toArray()
        empty = self.slope * float(max(intercepts[1:]) - intercepts[0]) + self.shift  # log odds of a paragraph without a feature
        self.lowered = empty >= 0
        if self.lowered:
            self.shift -= empty + 1e-6

    def _fit(self, data: DataFrame):
        return LogisticRegression(family="multinomial", weightCol="weight", elasticNetParam=1.0, regParam=1e-3,
                                  maxIter=60, standardization=False).fit(data)

    def _odds(self, raw: Column) -> Column:
        margins = vector_to_array(raw)
        return F.array_max(F.slice(margins, 2, len(self.labels) - 1)) - margins[0]

    def key_array(self) -> Column:
        return F.expr(_array_sql(self.key_terms) if self.key_terms else "array('')")

    def _grams(self, w: Column) -> Column:
        """The 1- to 3-grams that hold a key term."""
        keys = self.key_array()
        some = [F.filter(grams(w, n), lambda g: F.arrays_overlap(F.split(g, " "), keys)) for n in (1, 2, 3)]
        return F.concat(*some)

    def predict(self, paragraphs: DataFrame) -> DataFrame:
        """Adds ``family`` (unknown included), ``probability`` and ``confirmed`` to (…, w) rows with a key term."""
        raw = self.model.transform(self.vectors.transform(paragraphs.withColumn("grams", self._grams(F.col("w")))))
        margins = vector_to_array("rawPrediction")
        known = F.slice(margins, 2, len(self.labels) - 1)
        best = F.element_at(F.expr(_array_sql(FAMILIES)), F.array_position(known, F.array_max(known)).cast("int"))
        chance = 1 / (1 + F.exp(-(F.lit(self.slope) * self._odds(F.col("rawPrediction")) + F.lit(self.shift))))
        out = raw.withColumn("probability", chance).withColumn("family", F.when(chance >= 0.5, best).otherwise(F.lit(UNKNOWN)))
        return out.withColumn("pairs", grams(F.col("w"), 2)).withColumn("cover", covers()).withColumn("confirmed", confirmed()) \
            .drop("pairs", "cover", "grams", "features", "rawPrediction", "prediction")


def scan(docs: DataFrame) -> DataFrame:
    """Licence windows and lines of every distinct text: k1, k2, paragraph and part (from 0: its windows, then its lines),
    family, probability, confirmed."""
    blocks = docs.where(F.col("text").isNotNull()).select(
        *text_key(F.col("text")), F.posexplode(paragraphs_of(F.col("text"))).alias("paragraph", "said"))
    found = Classifier(blocks.where(F.col("said").rlike(r"[\p{L}\p{N}]")).select("said"))
    lines = F.when(F.contains("said", F.lit("\n")), F.transform(F.split("said", "\n"), words)).otherwise(F.array().cast("array<array<string>>"))
    cand = blocks.select("k1", "k2", "paragraph", "said", words(F.col("said")).alias("w")) \
        .where(F.arrays_overlap("w", found.key_array())).dropDuplicates(["k1", "k2", "paragraph"]) \
        .select("k1", "k2", "paragraph", F.posexplode(F.concat(windows(F.col("w")), lines)).alias("part", "w")) \
        .where(F.arrays_overlap("w", found.key_array()))
    return found.predict(cand).where(F.col("family") != UNKNOWN).drop("w")


@register("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ok = F.col("confirmed")
    per_text = scan(docs).groupBy("k1", "k2").agg(
        F.count("*").alias("n_predicted"), F.count_if(ok).alias("n_confirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(ok, F.col("family")))), ",").alias("licences"),
        F.max(F.when(ok, F.col("probability"))).alias("probability"))
    zero = F.lit(0).cast("long")
    return docs.select("doc_id", *text_key(F.col("text"))).join(per_text, ["k1", "k2"], "left").select(
        "doc_id", F.coalesce("n_predicted", zero).alias("n_predicted"), F.coalesce("n_confirmed", zero).alias("n_confirmed"),
        F.coalesce("licences", F.lit("")).alias("licences"), F.round("probability", 6).alias("probability"))
