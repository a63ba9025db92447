"""Licence scans: a trained paragraph classifier over sparse word n-grams.

Paragraphs (lines, and runs of non-blank lines joined, as notices are often
wrapped) become sets of word 1- to 3-grams; a multinomial logistic
regression gives each licence family, an ``unknown`` licence and ``none`` a
probability. It is trained here, from the notices below (whole, by sentence and
with words left out), from notices of made-up licences for the unknown class,
and from at most ``negatives`` paragraphs of the corpus without a licence word.
A temperature fitted on held-out variants calibrates the probabilities; what is
licence-like but under ``sure`` for every family is unknown. A family's
prediction is confirmed by comparison with its notices: some notice's word
2-grams must be found in the paragraph to a share of ``confirm``, and none of the
n-grams that such a notice lacks and that turn it into another licence (ND, NC, SA,
another version) or into none ("not licensed under"); otherwise the prediction
turns into unknown. A paragraph that holds notices of two licences is unknown for
the one that the other contradicts.

Only n-grams of the notices have weights, and only content words can start one,
so a paragraph without a content word of the notices scores as ``none`` whatever
else it holds: its words end at one set lookup each. The n-grams of the rest are
exploded, joined with the weights (a table of fixed size) and summed per
paragraph. Everything on rows is DataFrame functions; the driver only trains.

Defined results: null and empty texts have no paragraph; a row with a null id is
scanned and reported with that null; repeated rows are reported once; text is scanned, at any length.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound, first_by_hash

#: Public notices of licence families.
NOTICES: dict[str, list[str]] = {
    "MIT": [
        "Licensed under the MIT License.",
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "Apache-1.1": [
        "Licensed under the Apache Software License, Version 1.1.",
        "Released under the Apache License 1.1.",
        "SPDX-License-Identifier: Apache-1.1",
    ],
    "BSD": [
        "Licensed under the BSD License.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License.",
        "Licensed under the GPL.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License.",
        "Released under the LGPL.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License.",
        "Released under the AGPL.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Released under CC BY 4.0.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Released under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under CC BY-NC 4.0.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Released under CC BY-ND 4.0.",
    ],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Released under CC BY-NC-SA 4.0.",
    ],
    "CC-BY-NC-ND": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Released under CC BY-NC-ND 4.0.",
    ],
    "CC0": [
        "Licensed under CC0 1.0.",
        "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain worldwide.",
        "Released under CC0 1.0 Universal.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited.",
        "This document is proprietary and confidential.",
    ],
}
#: Sentences that hold licence words and grant nothing.
OTHER = [
    "He lost his driving license last year.",
    "She is a licensed plumber and a copyright lawyer.",
    "You need permission to use the public library.",
    "A license to fish costs ten dollars.",
    "The license plate was stolen.",
    "The bar applied for a liquor license.",
    "They have a license to sell food.",
    "The software is free for a limited time.",
    "General public opinion was under review.",
    "They work under the terms of a contract.",
    "See the version history of this project.",
]
#: Word n-grams that a family's notices lack and that make another
#: licence, or none, of a paragraph that is otherwise like them.
SHARE = ["by sa", "attribution sharealike", "attribution share"]
TRADE = ["by nc", "attribution noncommercial", "attribution non"]
CHANGE = ["by nd", "attribution noderivatives", "attribution noderivs", "attribution no"]
TRADE_SHARE = ["nc sa", "noncommercial sharealike", "noncommercial share", "commercial sharealike", "commercial share"]
TRADE_CHANGE = ["nc nd", "noncommercial noderivatives", "noncommercial noderivs", "noncommercial no", "commercial noderivatives", "commercial noderivs", "commercial no"]
AGAINST: dict[str, list[str]] = {
    "CC-BY": [*SHARE, *TRADE, *CHANGE],
    "CC-BY-SA": [*TRADE, *CHANGE],
    "CC-BY-NC": [*SHARE, *CHANGE, *TRADE_SHARE, *TRADE_CHANGE],
    "CC-BY-ND": [*SHARE, *TRADE],
    "CC-BY-NC-SA": [*CHANGE, *TRADE_CHANGE],
    "CC-BY-NC-ND": [*SHARE, *TRADE_SHARE],
    "Apache-2.0": ["license version 1.1", "license version 1.0", "license 1.1", "license 1.0", "license v 1.1", "apache 1.1", "apache 1.0"],
    "Apache-1.1": ["license version 2.0", "license 2.0", "license v 2.0", "apache 2.0"],
    "MPL-2.0": ["license version 1.1", "license version 1.0", "license v 1.1", "license 1.1", "mpl 1.1", "mpl 1.0"],
    "GPL": ["gnu lesser general", "gnu library general", "gnu affero general"],
    "LGPL": ["gnu affero general"],
    "Proprietary": ["rights reserved to", "rights reserved for", "rights are reserved"],
}
#: What denies any family.
DENIALS = "not licensed|not released|not be licensed|not be released|not available under|not distributed under|not covered by|not subject to|not under the|never licensed|never released|no longer licensed|no longer released|isn t licensed|isn t released|aren t licensed|wasn t licensed|wasn t released|neither licensed|commons clause".split("|")
UNKNOWN, NONE = "unknown", "none"
#: Words that start no n-gram.
COMMON = "a an and any are as at be by for from he her his i in is it last may not of on only or she that the their they this to under was we were with without you".split()
#: Words that keep a paragraph from being a negative.
CUES = r"(?i)licen[cs]|copyright|permission|warrant|redistribut|spdx|all rights|gpl|creative commons"
SPLIT = r"[^\p{L}\p{N}.]+|\.(?![\p{N}])"


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[^\w.]+|_|\.(?![0-9])", text.lower()) if w]


def grams_of(words: list[str], sizes: tuple[int, ...] = (1, 2, 3)) -> set[str]:
    return {" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1) if words[i] not in COMMON}


class Model:
    """Weights of the n-grams per class, biases, and what confirms a family."""

    def __init__(self, negatives: Callable[[list[str]], list[list[str]]], seed: int = 5, steps: int = 300, decay: float = 1e-3):
        """negatives: from the known n-grams to those of each negative paragraph."""
        rng = np.random.default_rng(seed)
        self.classes = [*NOTICES, UNKNOWN, NONE]
        rows: list[tuple[list[str], int]] = []

        def variants(text: str, label: int, times: int) -> None:
            words = words_of(text)
            rows.append((words, label))
            for _ in range(times):
                kept = [w for w in words if rng.random() > 0.12]
                rows.append((kept or words, label))

        for label, name in enumerate(NOTICES):
            for notice in NOTICES[name]:
                for part in dict.fromkeys([notice, *re.split(r"(?<=[a-z]{3})\.\s", notice)]):
                    variants(part, label, 6)
        made_up = ["Foobar", "Examplia", "Zenith", "Quasar Community", "Northwind", "Open Widget", "Tern", "Kestrel Labs"]
        shapes = ["Licensed under the {} License.", "Released under the {} License, version 1.2.", "This work is licensed under the {} Public License.", "You may use this under the terms of the {} license agreement.", "SPDX-License-Identifier: LicenseRef-{}"]
        for name, shape in itertools.product(made_up, shapes):
            variants(shape.format(name), len(NOTICES), 3)
        for text in OTHER:
            variants(text, len(NOTICES) + 1, 6)
        rows += [([], len(NOTICES) + 1)] * 40  # what holds no word of the notices
        names_only = {w for name in made_up for w in words_of(name)}
        known = sorted(g for g in set().union(*(grams_of(w) for w, label in rows if label != len(NOTICES) + 1), *(grams_of(words_of(t)) for t in OTHER)) if not names_only & set(g.split()))
        self.of = {g: i for i, g in enumerate(known)}
        found = [(grams_of(words), label) for words, label in rows] + [(set(own), len(NOTICES) + 1) for own in negatives(known)]
        x = np.zeros((len(found), len(known)))
        for i, (own, _) in enumerate(found):
            x[i, [self.of[g] for g in own if g in self.of]] = 1
        y = np.array([label for _, label in found])
        k = len(self.classes)
        even = 1 / np.maximum(np.bincount(y, minlength=k)[y], 1) ** 0.5
        even /= even.sum()
        held = rng.random(len(found)) < 0.15
        fit = np.where(held, 0.0, even)
        self.weights, self.bias = np.zeros((len(known), k)), np.zeros(k)
        target, speed = np.eye(k)[y], np.full((len(known), k), 1e-4)
        speed_b = np.full(k, 1e-4)
        for _ in range(steps):  # AdaGrad on the whole sample
            p = self._softmax(x @ self.weights + self.bias)
            back = (p - target) * (fit / fit.sum())[:, None]
            g, gb = x.T @ back + decay / len(known) * self.weights, back.sum(0)
            speed += g**2
            speed_b += gb**2
            self.weights -= 0.15 * g / np.sqrt(speed)
            self.bias -= 0.15 * gb / np.sqrt(speed_b)
        logits = (x @ self.weights + self.bias)[held]
        options = np.linspace(0.5, 4, 36)
        loss = [-np.log(self._softmax(logits / t)[np.arange(held.sum()), y[held]] + 1e-12).mean() for t in options] if held.any() else [0.0]
        temperature = float(options[int(np.argmin(loss))]) if held.any() else 1.0
        self.weights, self.bias = self.weights / temperature, self.bias / temperature

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def probabilities(self, text: str) -> dict[str, float]:
        on = [self.of[g] for g in grams_of(words_of(text)) if g in self.of]
        p = self._softmax((self.weights[on].sum(0) + self.bias)[None])[0]
        return dict(zip(self.classes, p.tolist(), strict=True))


def paragraph_words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), SPLIT), lambda w: w != "")


def known_grams(words: Column, known: list[str]) -> Column:
    """The known n-grams among an array of words. Only places where a known
    n-gram can start are looked at; membership is a lookup in a set of literals
    that is built once, not for every row."""
    first = sorted({g.split(" ")[0] for g in known})
    places = lambda w: F.filter(F.transform(w, lambda x, i: F.when(x.isin(first), i)), lambda i: i.isNotNull())

    def grams(w: Column) -> Column:
        of_size = lambda at, n: F.transform(at, lambda i: F.array_join(F.slice(w, i + 1, F.lit(n)), " "))
        sizes = lambda at: F.concat(F.transform(at, lambda i: F.get(w, i)), of_size(at, 2), of_size(at, 3))
        return bound(places(w), lambda at: F.array_distinct(F.filter(sizes(at), lambda g: g.isin(known))))

    return bound(words, grams)


def paragraphs(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    lines = docs.select(F.col(id_col).alias("__id"), F.posexplode(F.split(F.col(text), "\n")).alias("paragraph", "line"))
    return lines.where("trim(line) <> ''")


def fit_licences(docs: DataFrame, id_col: str = "doc_id", text: str = "text", negatives: int = 400) -> Model:
    """Train on the notices and at most ``negatives`` paragraphs, of as many
    documents, the first by a hash of the id."""
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__doc"), F.xxhash64(F.lit("licences"), id_col).alias("mark"))
    chosen = first_by_hash(ids, negatives, "__doc").distinct()
    rows = docs.select(F.col(id_col).alias("__doc"), F.col(text).alias("text")).join(F.broadcast(chosen), "__doc").select("mark", "text")  # so few rows may be broadcast
    lines = paragraphs(rows, "mark", "text").where(~F.col("line").rlike(CUES)).select("line").distinct()
    lines = lines.orderBy(F.xxhash64("line"), "line").limit(negatives)
    # of a line only its known n-grams are collected, whatever its length
    return Model(lambda known: [r.grams for r in lines.select(known_grams(paragraph_words(F.col("line")), known).alias("grams")).collect()])


def runs(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Runs of non-blank lines: the index of the first line, and the lines."""
    rows = docs.select(F.col(id_col).alias("__id"), F.split(F.col(text), "\n").alias("all"))
    full = rows.withColumn("full", F.transform("all", lambda x: x.rlike(r"\S")))
    edge = lambda step: F.filter(F.transform("full", lambda x, i: F.when(x & ~F.coalesce(F.get("full", i + step), F.lit(False)), i)), lambda i: i.isNotNull())
    both = full.select("__id", "all", F.explode(F.arrays_zip(edge(-1).alias("first"), edge(1).alias("last"))).alias("e"))
    found = both.select("__id", F.col("e.first").alias("run"), F.slice("all", F.col("e.first") + 1, F.col("e.last") - F.col("e.first") + 1).alias("lines"))
    return found.withColumn("run_mark", F.xxhash64("lines"))


def scan_licences(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", sure: float = 0.5, confirm: float = 0.6) -> DataFrame:
    """(id_col, paragraph, family, probability, similarity, confirmed, chars): a
    row for each line whose most likely class is not ``none``, and one for each
    run of lines that is confirmed for a family by its lines joined but by none
    alone (by a notice of three 2-grams or more: fewer meet by chance in a run); it replaces the lines that hint at that family unconfirmed.
    ``paragraph`` is the index of the line, or of the first line of the run."""
    spark: SparkSession = docs.sparkSession
    kinds = model.classes
    against = sorted({g for own in AGAINST.values() for g in own} | set(DENIALS))
    known = sorted({*model.of, *against})
    keys = ["__id", "run", "run_mark"]
    # joined lines in overlapping parts: a stretch of words as long as any notice lies whole in one of them
    span = 2 * max(len(words_of(notice)) for own in NOTICES.values() for notice in own)

    def seen(ws: Column) -> Column:
        """Each line, and each part of a run of several, with its known n-grams."""
        line = lambda i: F.get("lines", i)
        single = F.transform(ws, lambda w, i: F.struct((F.col("run") + i).alias("paragraph"), F.lit(-1).alias("part"), F.xxhash64(line(i)).alias("mark"), F.length(line(i)).alias("chars"), known_grams(w, known).alias("grams")))

        def parts(run: Column) -> Column:
            whole = run["words"]
            last = F.greatest(F.lit(0), F.floor((F.size(whole) - 1) / F.lit(span)).cast("int") - 1)
            return F.transform(F.sequence(F.lit(0), last), lambda part: F.struct(F.col("run").alias("paragraph"), part.alias("part"), F.col("run_mark").alias("mark"), run["chars"].alias("chars"), known_grams(F.slice(whole, part * span + 1, F.lit(2 * span)), known).alias("grams")))

        joined = F.when(F.size("lines") > 1, bound(F.struct(F.flatten(ws).alias("words"), F.length(F.array_join("lines", " ")).alias("chars")), parts)).otherwise(F.array().cast("array<struct<paragraph:int,part:int,mark:bigint,chars:int,grams:array<string>>>"))
        return F.filter(F.concat(single, joined), lambda s: F.size(s["grams"]) > 0)

    words = F.transform("lines", paragraph_words)
    lines = runs(docs, id_col, text).select(*keys, F.explode(bound(words, seen)).alias("s")).select(*keys, "s.*")
    names = [f"w{i}" for i in range(len(kinds))]
    # what only contradicts has no weight
    none = [0.0] * len(kinds)
    table = [(g, g in model.of, g in against, *(map(float, model.weights[model.of[g]]) if g in model.of else none)) for g in known]
    weights = spark.createDataFrame(table, "gram string, weighs boolean, denies boolean, " + ", ".join(f"{n} double" for n in names))
    row = [*keys, "paragraph", "part", "mark", "chars"]
    hits = lines.select(*row, F.explode("grams").alias("gram")).distinct()
    hits = hits.join(F.broadcast(weights), "gram")  # a row for each n-gram of the notices: a fixed size
    summed = hits.groupBy(*row).agg(F.collect_list(F.when(F.size(F.split("gram", " ")) == 2, F.col("gram"))).alias("pairs"), F.collect_list(F.when(F.col("denies"), F.col("gram"))).alias("denied"), F.max("weighs").alias("weighs"), *[F.sum(n).alias(n) for n in names]).where("weighs")
    # most paragraphs have a known word by chance: plain columns tell that they are ``none``, the last class
    logit = [F.col(n) + F.lit(float(b)) for n, b in zip(names, model.bias, strict=True)]
    summed = summed.where(F.greatest(*logit[:-1]) >= logit[-1] - 1e-9)
    logits = F.array(*logit)
    summed = summed.withColumn("z", logits).withColumn("e", F.transform("z", lambda v: F.exp(v - F.array_max("z"))))
    summed = summed.withColumn("p", F.transform("e", lambda v: v / F.aggregate("e", F.lit(0.0), lambda s, x: s + x)))
    best = F.array_position("p", F.array_max("p")).cast("int")
    scored = summed.withColumn("family", F.element_at(F.array(*[F.lit(c) for c in kinds]), best)).withColumn("probability", F.array_max("p")).where(F.col("family") != NONE)
    # comparison with each notice of the family: the share of its 2-grams that are found
    notices = [(name, sorted(grams_of(words_of(notice), (2,)))) for name, own in NOTICES.items() for notice in own]
    shares = [F.when((F.col("family") == name) & ((F.col("part") < 0) | F.lit(len(own) > 2)), F.size(F.array_intersect("pairs", F.array(*[F.lit(g) for g in own]))) / F.lit(float(len(own)))) for name, own in notices if own]
    scored = scored.withColumn("similarity", F.coalesce(F.greatest(*shares), F.lit(0.0)))
    denied = F.arrays_overlap("denied", F.array(*[F.lit(g) for g in DENIALS]))
    for name, own in AGAINST.items():
        denied = denied | ((F.col("family") == name) & F.arrays_overlap("denied", F.array(*[F.lit(g) for g in own])))
    confirmed = ~denied & (F.col("family") != UNKNOWN) & (F.col("probability") >= sure) & (F.col("similarity") >= confirm)
    scored = scored.withColumn("confirmed", confirmed).where((F.col("part") < 0) | F.col("confirmed"))
    # in a run, for each likeliest family: a line that is confirmed stands before the joined lines, these before hints
    own = Window.partitionBy(*keys, "family")
    by_line, by_run = F.max(F.col("confirmed") & (F.col("part") < 0)).over(own), F.max(F.col("part") >= 0).over(own)
    first = F.row_number().over(own.orderBy(F.desc(F.col("part") >= 0), F.desc("similarity"), F.desc("probability"), "part"))
    kept = scored.select("*", by_line.alias("by_line"), by_run.alias("by_run"), first.alias("first"))
    kept = kept.where(F.when(F.col("part") < 0, F.col("confirmed") | F.col("by_line") | ~F.col("by_run")).otherwise(~F.col("by_line") & (F.col("first") == 1)))
    out = kept.withColumn("family", F.when(F.col("confirmed"), F.col("family")).otherwise(UNKNOWN))
    out = out.withColumn("joined", F.col("part") >= 0).dropDuplicates(["__id", "paragraph", "joined", "mark", "chars", "family"])
    return out.select(F.col("__id").alias(id_col), "paragraph", "family", "probability", "similarity", "confirmed", "chars")
