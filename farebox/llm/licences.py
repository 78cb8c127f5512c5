"""Licence families of paragraphs by a trained classifier, in DataFrame operations.

Sparse features are the words and word pairs of a stretch of words, hashed into
``DIMENSIONS`` slots. A multinomial logistic regression is fitted on wordings of
known licence notices, varied by dropped and added words, against stretches of
the corpus that share no wording with them (class unknown). A stretch is of a
family when its calibrated probability is high enough and the words it shares
with the nearest template of that family confirm it.

A paragraph reaches to the next blank line, whatever its lines are. Its stretches
overlap and are of bounded length, by the length of the templates that they can
confirm. Only those around a cue word are made: the cues are words of the
templates, so many of each that no stretch without one can be confirmed.

The weights of the fitted model are one constant array, so scoring is a sum of
array look-ups inside the scan: no paragraph is shuffled.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.common import stored

UNKNOWN = "unknown"
DIMENSIONS = 2048
BACKGROUND_ROWS = 2000    # most corpus stretches that the unknown class is fitted on
MIN_PROBABILITY = 0.5     # floor of the calibrated cut
CONFIRMED = 0.6           # least share of a template's words that a stretch must hold
SCALES = (6, 12, 24, 48)  # words of a stretch; a template fits the first that has 1.5 times its words
SPAN = SCALES[-1]
CHUNK = 4096              # words of a text that are searched at once
EMBEDDED = 3              # corpus stretches that each template is put into for training

#: Wordings of licence notices by family.
TEMPLATES: list[tuple[str, str]] = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "Licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Licensed under the Creative Commons Attribution-NonCommercial 4.0 License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced "
                    "without the prior written permission of the publisher"),
    ("proprietary", "All rights reserved"),
]
FAMILIES = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]

#: Words of any prose. They neither bound a notice nor, if others do, are cues.
COMMON = {"a", "and", "any", "are", "as", "be", "by", "in", "is", "it", "no", "not", "of", "or",
          "that", "the", "this", "to", "under", "with", "without", "you"}
#: Letter words of each template; digits of a version may differ.
OWN = [sorted(set(re.findall(r"[a-z]+", body.lower()))) for _, body in TEMPLATES]
#: The place in SCALES of the stretches that may confirm each template.
FITS = [next(k for k, size in enumerate(SCALES)
             if 2 * size >= 3 * len(re.findall(r"[a-z0-9]+", body.lower()))) for _, body in TEMPLATES]


def cues() -> list[str]:
    """Words of which every stretch that is confirmed holds one: of n words of a
    template it holds k at least, so it holds one of any n - k + 1 of them."""
    often = {w: sum(w in own for own in OWN) for own in OWN for w in own}
    found = set()
    for own in OWN:
        k = next(k for k in range(len(own) + 1) if k / len(own) >= CONFIRMED)
        ranked = sorted(own, key=lambda w: (w in COMMON, -often[w], -len(w), w))
        found.update(ranked[:len(own) - k + 1])
    return sorted(found)


CUES = cues()


def words(text: Column) -> Column:
    """Words in lower case: letters, and digits with the marks inside a version."""
    flat = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(F.trim(flat), " "), lambda w: F.length(w) > 0)


def features(w: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))),
                       lambda a, b: F.concat_ws(" ", a, b))
    # the last pair lacks its second word
    pairs = F.slice(pairs, 1, F.greatest(F.size(w) - 1, F.lit(0)))
    return F.array_distinct(F.concat(w, pairs))


def slots(feats: Column) -> Column:
    """Hashed features: positions from 0."""
    return F.array_distinct(F.transform(feats, lambda f: F.pmod(F.xxhash64(f), F.lit(DIMENSIONS))
                                        .cast("int")))


def _cued(text: Column) -> Column:
    """Whether a text holds a cue, as one of its ``words``."""
    return F.lower(text).rlike(r"(?<![\p{L}\p{N}])(?:" + "|".join(CUES) + r")(?![\p{L}\p{N}])")


def _tokens(text: Column) -> Column:
    """(line, w) of every word in order; an empty w stands for a blank line."""
    def of_line(line: Column, at: Column) -> Column:
        w = F.when(line.rlike(r"\S"), words(line)).otherwise(F.array(F.lit("")))
        return F.transform(w, lambda x: F.struct(at.alias("line"), x.alias("w")))
    return F.flatten(F.transform(F.split(text, r"\n"), of_line))


def chunks(texts: DataFrame, *cols: str) -> DataFrame:
    """(cols, start, core, toks): every text (column ``text``) in chunks of CHUNK
    words from word ``core`` on, with SPAN words more on both sides."""
    t = texts.select(*cols, _tokens(F.col("text")).alias("all")).where(F.size("all") > 0)
    first = lambda k: F.greatest(k - SPAN, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("all") - 1, F.lit(CHUNK)),
        lambda k: F.struct(first(k).alias("start"), k.alias("core"),
                           F.slice("all", first(k) + 1, k - first(k) + CHUNK + SPAN).alias("toks")))
    return t.select(*cols, F.inline(pieces))


def stretches(texts: DataFrame, *cols: str) -> DataFrame:
    """(cols, scale, start, toks): the stretches around each cue word that stay in
    its paragraph. A notice of up to two thirds of a scale's words that holds the
    cue lies in one of the scale whole: they begin a quarter of it apart."""
    c = chunks(texts, *cols)
    inside = F.col("core") - F.col("start")
    cue = F.array(*map(F.lit, CUES))
    anchors = F.filter(
        F.sequence(inside, F.least(inside + CHUNK, F.size("toks")) - 1),
        lambda p: F.array_contains(cue, F.element_at("toks", p + 1)["w"]))
    first = lambda p: F.greatest(p - SPAN, F.lit(0))
    around = F.transform(anchors, lambda p: F.struct(
        (F.col("start") + first(p)).alias("from"), (p - first(p)).alias("at"),
        F.slice("toks", first(p) + 1, p - first(p) + SPAN).alias("near")))
    c = c.select(*cols, F.inline(around))
    # the words between the blank lines before and behind the cue
    blanks = F.filter(F.transform("near", lambda x, i: F.when(x["w"] == "", i)),
                      lambda i: i.isNotNull())
    c = c.withColumn("blanks", blanks)
    low = F.coalesce(F.array_max(F.filter("blanks", lambda i: i < F.col("at"))) + 1, F.lit(0))
    high = F.coalesce(F.array_min(F.filter("blanks", lambda i: i > F.col("at"))), F.size("near"))
    c = c.withColumns({"low": low, "high": high})
    grid = []
    for k, size in enumerate(SCALES):
        for quarter in range(4):
            begin = F.col("at") - quarter * size // 4
            a, z = F.greatest(begin, F.col("low")), F.least(begin + size, F.col("high"))
            grid.append(F.struct(F.lit(k).alias("scale"), (F.col("from") + a).alias("start"),
                                 F.slice("near", a + 1, z - a).alias("toks")))
    return c.select(*cols, F.inline(F.array_distinct(F.array(*grid))))


def _adder(table: Column):
    return lambda s, k: s + F.element_at(table, k + 1)


class Model:
    """Weights of each family by slot, its intercept, and the calibrated cut."""

    def __init__(self, weights: list[list[float]], intercepts: list[float], cut: float):
        self.weights, self.intercepts, self.cut = weights, intercepts, cut

    def score(self, rows: DataFrame, at: str = "at") -> DataFrame:
        """Add ``probability`` of the likeliest family and its place ``best`` in
        FAMILIES[1:]. Each step is a projection of its own and used more than once
        by the next, so that no sum is computed twice."""
        sums = []
        for row, b in zip(self.weights, self.intercepts, strict=True):
            # a constant array: a look-up by position, not a search
            table = F.split(F.lit(",".join(f"{x:.6g}" for x in row)), ",").cast("array<double>")
            sums.append(F.aggregate(at, F.lit(float(b)), _adder(table)))
        z = rows.withColumn("__z", F.array(*sums))
        known = F.array_max(F.slice("__z", 2, len(FAMILIES) - 1))
        z = z.withColumns({"__top": F.array_max("__z"), "__known": known})
        total = sum((F.exp(F.element_at("__z", k + 1) - F.col("__top"))
                     for k in range(len(FAMILIES))), F.lit(0.0))
        return z.withColumns({
            "probability": F.exp(F.col("__known") - F.col("__top")) / total,
            "best": F.array_position(F.slice("__z", 2, len(FAMILIES) - 1), F.col("__known"))
            .cast("int")}).drop("__z", "__top", "__known")


def _few_rows(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    """(family, body) of constants."""
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(b).alias("body")) for f, b in pairs])
    return spark.range(1).select(F.inline(rows))


def _background(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, w), stored: stretches of SPAN words without a cue from the whole texts of
    BACKGROUND_ROWS documents."""
    texts = (docs.select(F.col(text_col).alias("text"))
             .where(F.length("text") > 0).withColumn("h", F.xxhash64("text")))
    # only hashes are ranked; the texts of the few are fetched, copies as one
    first = texts.select("h").orderBy("h").limit(BACKGROUND_ROWS).distinct()
    some = texts.join(F.broadcast(first), "h").groupBy("h").agg(F.min("text").alias("text"))
    starts = F.sequence(F.lit(0), F.size("toks") - 1, F.lit(SPAN))
    cut = (chunks(some, "h").select(
        "h", "start", F.posexplode(F.transform(starts, lambda k: F.slice("toks", k + 1, SPAN))))
        .select(F.xxhash64("h", "start", "pos").alias("h"),
                F.filter(F.col("col.w"), lambda x: x != "").alias("w")))
    cut = cut.where((F.size("w") > 0) & ~F.arrays_overlap("w", F.array(*map(F.lit, CUES))))
    return stored(cut.orderBy("h", "w").limit(BACKGROUND_ROWS), "licence-background")


def _training_rows(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(family, w): templates in several wordings, alone and inside of prose, and
    corpus stretches without a cue."""
    known = _few_rows(spark, TEMPLATES).select("family", words(F.col("body")).alias("w"))
    # wordings: the whole, its halves, and the whole without every third word
    variants = known.select("family", F.explode(F.array(
        F.col("w"), F.slice("w", 1, F.ceil(F.size("w") * 0.7).cast("int")),
        F.filter("w", lambda x, i: i % 3 != 2),
        F.filter("w", lambda x, i: i % 4 != 1),
        F.concat(F.array(F.lit("this"), F.lit("text"), F.lit("is")), F.col("w")))).alias("w"))
    other = _background(docs, id_col, text_col)
    prose = other.orderBy("h", "w").limit(EMBEDDED).select(F.col("w").alias("prose"))
    pad = F.greatest(F.size("w"), F.lit(4))
    before, behind = F.slice("prose", 1, pad), F.slice(F.reverse("prose"), 1, pad)
    inside = known.crossJoin(F.broadcast(prose)).select("family", F.explode(F.array(
        F.concat(before, "w"), F.concat("w", behind), F.concat(before, "w", behind))).alias("w"))
    variants = variants.union(inside)
    other = other.select(F.lit(UNKNOWN).alias("family"), "w")
    # cue words in plain prose are unknown too
    plain = _few_rows(spark, [(UNKNOWN, s) for s in (
        "a driving license is needed", "he has permission to go", "the license was lost",
        "licensed premises", "a licence to fish", "permission was granted by the mayor",
        "the license plate of the car")])
    return variants.union(other).union(plain.select("family", words(F.col("body"))))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the templates and at most BACKGROUND_ROWS stretches of the corpus.

    The cut is calibrated on the training rows: no unknown one may reach it."""
    spark = docs.sparkSession
    rows = _training_rows(spark, docs, id_col, text_col)
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    rows = rows.select(label.cast("double").alias("label"), "family",
                       slots(features(F.col("w"))).alias("at"))
    marked = rows.withColumn("terms", F.transform("at", lambda k: k.cast("string")))
    tf = HashingTF(inputCol="terms", outputCol="x", numFeatures=4 * DIMENSIONS, binary=True)
    # balance: templates weigh about as much as the background; few rows, two tasks
    weighted = tf.transform(marked).withColumn(
        "weight", F.when(F.col("family") == UNKNOWN, 0.1).otherwise(1.0)).coalesce(2).cache()
    fitted = LogisticRegression(featuresCol="x", weightCol="weight", regParam=0.002,
                                family="multinomial", standardization=False,
                                maxIter=40).fit(weighted)
    coef = fitted.coefficientMatrix.toArray()
    own = [tf.indexOf(str(k)) for k in range(DIMENSIONS)]
    n = coef.shape[0]
    weights = [[float(coef[f][own[k]]) for k in range(DIMENSIONS)] if f < n else
               [0.0] * DIMENSIONS for f in range(len(FAMILIES))]
    intercepts = [float(fitted.interceptVector[f]) if f < n else -30.0
                  for f in range(len(FAMILIES))]
    model = Model(weights, intercepts, MIN_PROBABILITY)
    worst = (model.score(weighted.where(F.col("family") == UNKNOWN))
             .agg(F.max("probability")).first()[0])
    weighted.unpersist()
    model.cut = min(0.95, max(MIN_PROBABILITY, worst or 0.0))
    return model


def _shares(w: Column, scale: Column) -> Column:
    """The share of each template's words that a stretch holds, 0 for the templates
    of other scales."""
    return F.array(*[F.when(scale == fits, F.size(F.array_intersect(
        F.array(*map(F.lit, own)), w)) / len(own)).otherwise(F.lit(0.0))
        for own, fits in zip(OWN, FITS, strict=True)])


def _bounds(rows: DataFrame) -> DataFrame:
    """Add ``first`` and ``last``: the words of a stretch (from 0) between which it
    still holds all those words of template ``nearest`` that prose seldom has."""
    telling = F.array(*[F.array(*[F.lit(w) for w in own if w not in COMMON]) for own in OWN])
    rows = rows.withColumn("told", F.array_intersect(F.element_at(telling, F.col("nearest")),
                                                     F.col("w")))
    # the last start, and then the first end, by which no word of these is lost
    rows = rows.withColumn("first", F.array_max(F.filter(
        F.sequence(F.lit(0), F.size("w") - 1),
        lambda k: F.size(F.array_except("told", F.slice("w", k + 1, SPAN))) == 0)))
    return rows.withColumn("last", F.array_min(F.filter(
        F.sequence(F.col("first"), F.size("w") - 1),
        lambda k: F.size(F.array_except("told", F.slice("w", F.col("first") + 1,
                                                        k - F.col("first") + 1))) == 0)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence notice: doc_id, paragraph (the line it begins in, from 0,
    blank lines counted), body (the lines that hold it), family, probability,
    template_share.

    Of stretches that overlap the one is reported that holds most of its template.
    Null and empty texts give no rows, repeated rows give repeated rows, an empty
    table none. The unknown class gives no row. Other columns are ignored."""
    model = train(docs, id_col, text_col)
    # stored: the number of a row must not change
    cued = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                  .where(_cued(F.col("text")))
                  .withColumn("row", F.monotonically_increasing_id()), "licence-texts")
    near = stretches(cued, "row").withColumn("w", F.col("toks.w"))
    near = near.withColumn("shares", _shares(F.col("w"), F.col("scale"))).where(
        F.exists("shares", lambda x: x >= CONFIRMED))
    worded = near.withColumn("at", slots(features(F.col("w"))))
    # stored, since a filter would move below the projections and repeat their sums
    best = stored(model.score(worded).drop("at"), "licence-scores").withColumn(
        "family", F.element_at(F.array(*map(F.lit, FAMILIES[1:])), F.col("best")))
    of = F.array(*[F.lit(f) for f, _ in TEMPLATES])
    best = best.withColumn("own", F.zip_with(
        "shares", of, lambda x, f: F.when(f == F.col("family"), x).otherwise(F.lit(0.0))))
    best = best.withColumn("share", F.array_max("own")).where(
        (F.col("probability") > model.cut) & (F.col("share") >= CONFIRMED))
    best = _bounds(best.withColumn("nearest", F.array_position("own", F.col("share")).cast("int")))
    line = lambda k: F.element_at("toks", F.col(k) + 1)["line"]
    found = best.select("row", F.struct(
        (-F.col("share")).alias("share"), (F.col("first") - F.col("last")).alias("size"),
        (-F.col("probability")).alias("probability"), (F.col("start") + F.col("first")).alias("a"),
        (F.col("start") + F.col("last")).alias("z"), line("first").alias("top"),
        line("last").alias("end"), "family").alias("f"))
    # best first; what overlaps a better one is the same notice
    ranked = found.groupBy("row").agg(F.array_sort(F.collect_set("f")).alias("all"))
    apart = F.aggregate("all", F.slice("all", 1, 0), lambda held, f: F.when(
        F.exists(held, lambda h: (h["a"] <= f["z"]) & (f["a"] <= h["z"])), held)
        .otherwise(F.concat(held, F.array(f))))
    notices = ranked.select("row", F.inline(apart))
    body = F.array_join(F.slice(F.split("text", r"\n"), F.col("top") + 1,
                                F.col("end") - F.col("top") + 1), "\n")
    return cued.join(notices, "row").select(
        "doc_id", F.col("top").cast("long").alias("paragraph"), body.alias("body"), "family",
        F.round(-F.col("probability"), 4).alias("probability"),
        F.round(-F.col("share"), 4).alias("template_share"))
