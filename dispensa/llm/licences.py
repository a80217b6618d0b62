"""Licence notices in documents: a trained classifier of paragraphs, confirmed by templates.

A paragraph (a line) becomes counts of its words and word pairs, hashed into ``BUCKETS`` places and divided
by the root of their number. A multinomial logistic regression over the licence families and an "unknown"
class is fitted by gradient steps with an L1 penalty, so that most weights are 0. It learns from variants of
the templates below, near misses, and at most ``BACKGROUND`` paragraphs of the corpus without licence words
(from the ``BACKGROUND_DOCS`` documents with the least hashes). A fifth of the rows is kept apart: on it a
temperature is chosen, and the probability below which a paragraph is unknown, such that at most one in a
hundred of its unknown ones would pass.

All paragraphs of all documents are scored. First with one weight for each place, the most by which any
family's exceeds unknown's: where that sum is not positive, no family can win. The rest get all classes'
probabilities, and the winning family's templates are compared: a prediction is confirmed if a template's
word pairs, ``CONFIRM`` of them at least, occur in the paragraph. Notices are often wrapped over several lines, so
it is confirmed too if they occur in the paragraph and up to ``REACH`` ones before and after it, read as one text,
and no other family's template has more of its pairs there.

Only DataFrame functions are used. Defined results: a null, empty or blank text has no paragraphs and no
notices; a paragraph without ASCII letters or digits is unknown; ties go to the family first in the
alphabet; every row gets one result, repeated or not; columns named like a result are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispensa.sources.staging import Staging

BUCKETS = 4096
BACKGROUND, BACKGROUND_DOCS = 1500, 500
VARIANTS = 6
STEPS = 30
RATE, PENALTY = 1.0, 5e-5
CONFIRM = 0.6
REACH = 8
UNKNOWN = "unknown"

# Usual wordings of notices.
TEMPLATES: dict[str, list[str]] = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL-3.0 license.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "Released under the GPL version 2.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
        "Licensed under the LGPL-3.0 license.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright by the author. All rights reserved.",
        "Copyright 2020 the authors. All rights reserved.",
        "No part of this work may be reproduced without the written permission of the copyright holder.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}
NEAR_MISSES = [
    "A driving licence was issued to the applicant in March.",
    "The licence plate of the car was not readable.",
    "The film was released under great pressure to the public.",
    "This work is under review by the public board.",
    "He reserved a table for all of the guests.",
    "All rights and duties of the members are listed below.",
    "The version of the program that the school teaches is free.",
    "The institute at MIT released a report of the work.",
    "The general public may use this file at any time.",
    "Creative people work in common rooms.",
    "The pub was licensed under the old law to sell beer.",
    "A copy of the paper is available at the office.",
    "The following conditions are met by the building.",
    "The apache people live in the south west.",
    "Permission to speak was granted by the chair.",
]
_HINTS = "(?i)licen|copyright|rights reserved|public domain|redistribut|warrant|gpl|mit |apache|creative commons|spdx"
RESULTS = ("n_paragraphs", "notices", "licence", "probability", "confirmed")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, also inside of a lambda."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, rest), F.slice(words, 2, rest), lambda a, b: F.concat_ws(" ", a, b))


def _places(words: Column) -> Column:
    grams = F.concat(words, _pairs(words))
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int"))


def _sum(places: Column, weights: Column) -> Column:
    return F.aggregate(places, F.lit(0.0), lambda s, i: s + F.get(weights, i))


def _logits(places: Column, weights: Column, bias: Column) -> Column:
    root = F.sqrt(F.greatest(F.size(places), F.lit(1)).cast("double"))
    return F.zip_with(weights, bias, lambda w, b: b + _sum(places, w) / root)


def _softmax(logits: Column, temperature: Column | float) -> Column:
    powers = _let(logits, lambda zs: F.transform(zs, lambda z: F.exp((z - F.array_max(zs)) / temperature)))
    return _let(powers, lambda e: _let(_total(e), lambda sum_: F.transform(e, lambda x: x / sum_)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, y: s + y)


@dataclass
class Model:
    """Families in the order of their weights, the last one unknown; one row holds all numbers."""

    families: list[str]
    weights: list[list[float]]
    bias: list[float]
    temperature: float
    threshold: float

    def table(self, like: DataFrame) -> DataFrame:
        unknown = len(self.families) - 1
        best = [
            max(w[j] - self.weights[unknown][j] for w in self.weights[:unknown]) for j in range(BUCKETS)
        ]
        gate = max(b - self.bias[unknown] for b in self.bias[:unknown])
        templates = [(f, t) for f in self.families[:unknown] for t in TEMPLATES[f]]
        spark = like.sparkSession
        row = spark.createDataFrame(
            [(self.families, self.weights, self.bias, best, gate, self.temperature, self.threshold, templates)],
            "families array<string>, weights array<array<double>>, bias array<double>, best array<double>, gate double, "
            "temperature double, threshold double, templates array<struct<family:string,text:string>>",
            verifySchema=False,
        )
        pairs = F.transform(
            "templates", lambda t: F.struct(t["family"].alias("family"), _let(_words(t["text"]), _pairs).alias("pairs"))
        )
        return row.withColumn("templates", pairs)


def _examples(docs: DataFrame, text: str) -> DataFrame:
    """(text, family): variants of the templates that lack a few words, near misses, and paragraphs of the corpus."""
    spark = docs.sparkSession
    known = [(t, f) for f, ts in TEMPLATES.items() for t in ts] + [(t, UNKNOWN) for t in NEAR_MISSES]
    known = spark.createDataFrame(known, "text string, family string")
    known = known.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    # The first variant is the template itself. Others have words before or after it; long ones lack a tenth of theirs.
    long = F.size(F.split("text", " ")) > 14
    keep = lambda w, i: ~long | (F.col("variant") == 0) | (F.pmod(F.xxhash64(w, i, "variant", "text"), F.lit(10)) > 0)
    said = F.array_join(F.filter(F.split("text", " "), keep), " ")
    around = F.lit([["", ""], ["Note:", ""], ["", "See the file for details."], ["The text is", ""], ["", "Thank you"], ["This file:", "and so on"]])
    add = F.get(around, F.col("variant"))
    known = known.select(F.trim(F.concat_ws(" ", F.get(add, F.lit(0)), said, F.get(add, F.lit(1)))).alias("text"), "family")
    few = docs.select(F.col(text).alias("text")).where("text is not null").orderBy(F.xxhash64("text"), "text").limit(BACKGROUND_DOCS)
    lines = few.select(F.explode(F.split("text", "\n")).alias("text")).where(~F.rlike("text", F.lit(_HINTS)) & (F.trim("text") != ""))
    lines = lines.orderBy(F.xxhash64("text"), "text").limit(BACKGROUND)
    return known.unionByName(lines.withColumn("family", F.lit(UNKNOWN)))


def _softened(w: float, step: float) -> float:
    """The weight, closer to 0 by ``step``."""
    return math.copysign(max(0.0, abs(w) - step), w)


def fit(docs: DataFrame, staging: Staging, text: str = "text") -> Model:
    families = [*TEMPLATES, UNKNOWN]
    k = len(families)
    rows = _examples(docs, text).withColumn("y", F.array_position(F.lit(families), F.col("family")).cast("int") - 1)
    rows = rows.withColumn("words", _words(F.col("text"))).withColumn("places", _places(F.col("words")))
    apart = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(5)) == 0
    rows = staging.keep(rows.where("size(places) > 0").select("y", "places", apart.alias("apart")).coalesce(4), "examples")
    train = rows.where("not apart")
    counts = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    # Families weigh as much as unknown does, together.
    weight = [total / (2 * (k - 1) * max(1, counts.get(c, 0))) for c in range(k - 1)] + [total / (2 * max(1, counts.get(k - 1, 0)))]
    spark = docs.sparkSession
    weights, bias = [[0.0] * BUCKETS for _ in families], [0.0] * k
    square, square_b = [[1e-8] * BUCKETS for _ in families], [1e-8] * k
    for _ in range(STEPS):
        now = spark.createDataFrame(
            [(weights, bias, [w / max(1, total) for w in weight])],
            "weights array<array<double>>, bias array<double>, cost array<double>",
            verifySchema=False,
        )
        logits = _logits(F.col("places"), F.col("weights"), F.col("bias"))
        scored = train.crossJoin(F.broadcast(now)).withColumn("p", _softmax(logits, 1.0))
        error = F.transform("p", lambda p, c: (p - (c == F.col("y")).cast("double")) * F.get("cost", F.col("y")))
        scored = scored.select("places", error.alias("error")).withColumn("x", 1 / F.sqrt(F.size("places").cast("double")))
        each = scored.select(F.explode(F.concat("places", F.array(F.lit(-1)))).alias("place"), "error", "x")
        sums = [F.sum(F.get("error", F.lit(c)) * F.when(F.col("place") < 0, 1.0).otherwise(F.col("x"))) for c in range(k)]
        for place, *slopes in each.groupBy("place").agg(*sums).collect():
            for c, g in enumerate(slopes):
                if place < 0:
                    square_b[c] += g * g
                    bias[c] -= RATE * g / math.sqrt(square_b[c])
                else:
                    square[c][place] += g * g
                    pace = RATE / math.sqrt(square[c][place])
                    weights[c][place] = _softened(weights[c][place] - pace * g, pace * PENALTY)
    return _calibrated(Model(families, weights, bias, 1.0, 0.5), rows.where("apart"))


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """The model with the temperature of the best likelihood on rows kept apart, and the least probability to be believed."""
    table = F.broadcast(model.table(rows).select("weights", "bias"))
    found = rows.crossJoin(table).select("y", _logits(F.col("places"), F.col("weights"), F.col("bias")).alias("z")).collect()

    def chances(z: list[float], t: float) -> list[float]:
        e = [math.exp((x - max(z)) / t) for x in z]
        return [x / sum(e) for x in e]

    grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0]
    loss = {t: -sum(math.log(max(1e-12, chances(r["z"], t)[r["y"]])) for r in found) for t in grid}
    model.temperature = min(grid, key=lambda t: (loss[t], t))
    unknown = len(model.families) - 1
    wrong = sorted(max(chances(r["z"], model.temperature)[:unknown]) for r in found if r["y"] == unknown)
    if wrong:
        model.threshold = min(0.95, max(0.5, wrong[min(len(wrong) - 1, math.floor(0.99 * len(wrong)))]))
    return model


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents' columns with n_paragraphs, the notices (paragraph from 0, family, probability, confirmed),
    and the family, probability and confirmation of the best one: confirmed before likelier before earlier."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS and c != text]
    lines = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda p: F.rlike(p, F.lit(r"\S")))
    rows = docs.select(F.struct(*kept).alias("doc"), F.coalesce(lines, F.array().cast("array<string>")).alias("lines"))
    rows = rows.crossJoin(F.broadcast(model.table(docs)))  # one row of bounded size

    def may_win(line: Column) -> Column:
        root = lambda places: F.sqrt(F.greatest(F.size(places), F.lit(1)).cast("double"))
        return _let(_let(_words(line), _places), lambda p: _sum(p, F.col("best")) + F.col("gate") * root(p) > 0)

    numbered = F.transform("lines", lambda p, i: F.struct(i.alias("paragraph"), p.alias("line")))
    rows = rows.withColumn("likely", F.filter(numbered, lambda n: may_win(n["line"])))

    def judge(n: Column) -> Column:
        def with_words(words: Column) -> Column:
            p = _softmax(_logits(_places(words), F.col("weights"), F.col("bias")), F.col("temperature"))
            ranked = F.zip_with(p, F.col("families"), lambda x, f: F.struct(x.alias("probability"), f.alias("family")))
            # array_min over the negated probability: ties go to the first name.
            least = F.array_min(F.transform(ranked, lambda r: F.struct((-r["probability"]).alias("q"), r["family"].alias("family"))))
            return F.struct(n["paragraph"].alias("paragraph"), least.alias("least"))

        return _let(_words(n["line"]), with_words)

    rows = rows.withColumn("judged", F.transform("likely", judge))
    believed = F.filter("judged", lambda j: (j["least"]["family"] != UNKNOWN) & (-j["least"]["q"] >= F.col("threshold")))

    def near(i: Column) -> Column:
        return F.array_join(F.slice("lines", F.greatest(i - REACH, F.lit(0)) + 1, F.lit(2 * REACH + 1)), " ")

    def confirm(j: Column) -> Column:
        own = lambda t: t["family"] == j["least"]["family"]

        def held(pairs: Column) -> Column:
            """For each template whether it is held, of how many pairs, and whether it is the family's."""
            size = lambda t: F.size(F.array_intersect(t["pairs"], pairs))
            told = F.transform("templates", lambda t: F.struct(size(t).alias("n"), F.size(t["pairs"]).alias("of"), own(t).alias("own")))
            return F.filter(told, lambda t: t["n"] >= CONFIRM * t["of"])

        alone = _let(_let(_words(F.get("lines", j["paragraph"])), _pairs), lambda pairs: F.exists(held(pairs), lambda t: t["own"]))
        most = lambda h: F.array_max(F.transform(h, lambda t: F.struct(t["n"].alias("n"), t["own"].alias("own"))))["own"]
        wrapped = _let(_let(_words(near(j["paragraph"])), _pairs), lambda pairs: _let(held(pairs), most))
        best = alone | F.coalesce(wrapped, F.lit(False))
        return F.struct(
            j["paragraph"].alias("paragraph"), j["least"]["family"].alias("family"), (-j["least"]["q"]).alias("probability"),
            best.alias("confirmed"),
        )

    rows = rows.withColumn("notices", F.transform(believed, confirm))
    best = F.array_max(
        F.transform("notices", lambda n: F.struct(n["confirmed"].alias("c"), n["probability"].alias("p"), (-n["paragraph"]).alias("i"), n["family"].alias("f")))
    )
    return rows.withColumn("top", best).select(
        "doc.*", F.size("lines").alias("n_paragraphs"), "notices",
        F.col("top.f").alias("licence"), F.col("top.p").alias("probability"), F.col("top.c").alias("confirmed"),
    )
