"""Licence scans: a trained paragraph classifier, in DataFrame functions and Spark ML only.

Paragraphs are the lines of a text. A multinomial logistic regression with an L1 share
reads the word 1- to ``GRAMS``-grams of the templates that hold a telling word (no
function word), and names a licence family or ``unknown``. It is trained on the templates in
several forms, on sentences that only mention licences, and on at most ``SAMPLE`` paragraphs
of the corpus that resemble no template. A temperature fitted on paragraphs held out of
the training calibrates the probabilities, that of ``unknown`` among them.

A predicted family stands only if the paragraph also holds at least ``CONFIRM`` of the
2-grams of one of the family's templates; otherwise it is reported unconfirmed.

A paragraph without any telling word has no feature at all, so it has the
intercepts' class, which must be ``unknown`` (checked after training); such paragraphs are
left out before their n-grams are made. Texts are
scanned whole. Null, empty and blank texts have no paragraphs; repeated rows repeat their
findings; an empty corpus gives an empty result. Null ids are kept.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import cut

GRAMS = 3
SAMPLE = 2000
PARTS = 40  # of the sample
CONFIRM = 0.6
UNKNOWN = "unknown"
_WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"

# Usual wording of licence notices.
TEMPLATES: dict[str, list[str]] = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC0": [
        "Released into the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
}

# Sentences that only mention such words.
MENTIONS = [
    "He lost his driving license on the way to work.",
    "The general public was asked to comment on the second version.",
    "A researcher at MIT released a paper about free software.",
    "The Apache helicopter landed on the source of the river.",
    "Her fishing license is subject to the terms of the council.",
    "The city granted a license to the new bar, free of charge.",
    "They work under a public contract with a creative director.",
    "Copies of the notice were included in the library.",
    "The album was released in version after version.",
    "Attribution of the painting to the master is subject to doubt.",
    "Permission to use the hall is granted to any person.",
    "The domain is public and the conditions are met.",
]

# Words that carry no licence by themselves.
FUNCTION_WORDS = "a an the of and or to in is are was be by for from with without on at this that it its you may not can any all as under use file copy have has should shall which".split()


def words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(_WORD), F.lit(0))


def grams(w: Column, n: int) -> Column:
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.array_join(F.slice(w, i + 1, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))


def _py_words(text: str) -> list[str]:
    import re

    return re.findall(_WORD, text.lower())


def _py_grams(w: list[str], n: int) -> list[str]:
    return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]


def vocabulary() -> list[str]:
    """The n-grams of the templates, without those of function words only."""
    found = {g for forms in TEMPLATES.values() for t in forms for n in range(1, GRAMS + 1) for g in _py_grams(_py_words(t), n)}
    return sorted(g for g in found if not set(g.split()) <= set(FUNCTION_WORDS))


def _telling() -> list[str]:
    """The single words among the features; every n-gram of the vocabulary holds one."""
    return sorted({w for g in vocabulary() for w in g.split()} - set(FUNCTION_WORDS))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``<id_col>, paragraph, content, w`` of the lines that hold a telling word; lines are numbered from 0.

    Texts without the longest part of any such word between other characters are left out first.
    """
    parts = sorted({max(w.replace("+", "-").replace(".", "-").split("-"), key=lambda p: (p not in FUNCTION_WORDS, len(p))) for w in _telling()})
    some = docs.where(F.arrays_overlap(F.split(F.lower(text_col), "[^a-z0-9]+"), _strings(parts)))
    lines = some.select(id_col, F.posexplode(F.split(text_col, r"\r?\n")).alias("paragraph", "content")).withColumn("w", words(F.col("content")))
    return _only(lines, F.arrays_overlap("w", _strings(_telling())))


def _only(rows: DataFrame, condition: Column) -> DataFrame:
    """``rows`` that fulfil the condition. The optimizer cannot move it below the columns it reads, so that those are worked out once a row."""
    return rows.withColumn("_one", F.explode(F.when(condition, F.array(F.lit(1))))).drop("_one")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def similarities(w: Column) -> Column:
    """For every template an entry ``similarity, family``: the share of its 2-grams that the paragraph holds."""
    templates = F.array(*[
        F.struct(F.lit(family).alias("family"), F.array(*[F.lit(g) for g in sorted(set(_py_grams(_py_words(t), 2)))]).alias("grams")) for family, forms in TEMPLATES.items() for t in forms
    ])
    return _let(grams(w, 2), lambda have: F.transform(templates, lambda t: F.struct((F.size(F.array_intersect(t["grams"], have)) / F.size(t["grams"])).alias("similarity"), t["family"].alias("family"))))


def _shapes(text: str) -> list[str]:
    """Forms in which a notice is met."""
    w = text.split()
    out = [text, text.upper(), text.lower(), "Copyright holder. " + text, "// " + text, "* " + text + " All rights reserved."]
    return out + ([" ".join(w[:-1]), " ".join(w[1:])] if len(w) > 6 else [])


class Scanner:
    """The trained model with its temperature."""

    def __init__(self, classes: list[str], model: LogisticRegressionModel, temperature: float):
        self.classes, self.model, self.temperature = classes, model, temperature

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``content``) and ``p``, the calibrated probability per class."""
        scored = self.model.transform(_featured(rows)).withColumn("raw", vector_to_array("rawPrediction"))
        exp = _let(F.array_max("raw"), lambda top: F.transform("raw", lambda r: F.exp((r - top) / self.temperature)))
        p = _let(exp, lambda e: _let(F.aggregate(e, F.lit(0.0), lambda s, x: s + x), lambda total: F.transform(e, lambda x: x / total)))
        return scored.withColumn("p", p).drop("raw", "rawPrediction", "probability", "prediction", "features")


def _featured(rows: DataFrame) -> DataFrame:
    with_words = rows if "w" in rows.columns else rows.withColumn("w", words(F.col("content")))
    with_grams = with_words.withColumn("g", F.concat(*[grams(F.col("w"), n) for n in range(1, GRAMS + 1)]))
    vectors = CountVectorizerModel.from_vocabulary(vocabulary(), "g", "features", binary=True)
    return vectors.transform(with_grams).drop("g")


def train(corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Scanner:
    """A scanner for this corpus."""
    spark: SparkSession = corpus.sparkSession
    classes = [UNKNOWN, *TEMPLATES]
    rows = [(s, float(i)) for i, c in enumerate(classes) if c != UNKNOWN for t in TEMPLATES[c] for s in _shapes(t)]
    rows += [(s, 0.0) for t in MENTIONS for s in _shapes(t)]
    built = spark.createDataFrame(rows, "content string, label double")
    # the smallest hashes in each of PARTS parts: the same paragraphs at every run, `sample` at most
    place = F.xxhash64("content")
    far = F.array_max(similarities(F.col("w")))["similarity"] < CONFIRM / 2
    strange = _only(paragraphs(corpus, id_col, text_col), far).select("content", place.alias("place"))
    first = F.row_number().over(W.partitionBy(F.pmod("place", F.lit(PARTS))).orderBy("place", "content"))
    strange = cut(strange.withColumn("n", first).where(F.col("n") <= sample // PARTS).select("content", F.lit(0.0).alias("label")))
    plain = spark.createDataFrame([("nothing of the kind", 0.0)] * 50, "content string, label double")
    data = _featured(built.unionAll(strange).unionAll(plain)).withColumn("held", F.pmod(F.xxhash64("content"), F.lit(5)) == 0).select("features", "label", "held").coalesce(1).cache()  # a few thousand rows at most
    fitted = LogisticRegression(regParam=1e-3, elasticNetParam=0.5, family="multinomial", maxIter=50).fit(data.where("not held"))
    held = fitted.transform(data.where("held")).select(vector_to_array("rawPrediction").alias("raw"), F.col("label").cast("int").alias("label")).collect()  # bounded by the training rows
    data.unpersist()
    temperature = min((1.15**i for i in range(20)), key=lambda t: sum(_loss(r["raw"], r["label"], t) for r in held))
    intercepts = list(fitted.interceptVector)
    if max(range(len(intercepts)), key=lambda i: intercepts[i]) != 0:
        raise RuntimeError("a paragraph without features would not be unknown")
    return Scanner(classes, fitted, temperature)


def _loss(raw: list[float], label: int, t: float) -> float:
    top = max(raw)
    return math.log(sum(math.exp((r - top) / t) for r in raw)) - (raw[label] - top) / t


def scan(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, paragraph, family, probability, similarity, confirmed``: the paragraphs that are not unknown.

    ``similarity`` is the share of a template of the predicted family that the paragraph holds.
    """
    scanner = scanner or train(docs, id_col, text_col)
    scored = scanner.probabilities(paragraphs(docs, id_col, text_col))
    names = F.array(*[F.lit(c) for c in scanner.classes])
    best = scored.withColumn("probability", F.array_max("p")).withColumn("family", F.get(names, F.array_position("p", F.array_max("p")).cast("int") - 1))
    found = _only(best, F.col("family") != UNKNOWN)
    own = F.filter(similarities(F.col("w")), lambda s: s["family"] == F.col("family"))
    found = found.withColumn("similarity", F.array_max(own)["similarity"])
    return found.select(id_col, "paragraph", "family", "probability", "similarity", (F.col("similarity") >= CONFIRM).alias("confirmed"))
