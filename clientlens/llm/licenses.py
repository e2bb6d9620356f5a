"""Licence scan: a trained classifier of paragraphs, with a calibrated unknown class, confirmed by templates.

Paragraphs stand between blank lines. Their lines are joined, so a wrapped notice is whole, and they are scored
in parts: sentences, or overlapping windows of words where a sentence is long. Every part goes to a sparse (L1) multinomial
logistic regression over word 1- and 2-grams, trained on notices of licence families, on notices of made-up
licences (the class `unknown`), on sentences that several licences share, and on ordinary sentences of the
corpus (the class `none`). A part without any word that has a weight gets the intercepts as its scores and thereby
`none`; such parts, nearly all, are passed over, which changes no result.

Notices are made by a rule, names of a family in carrier sentences. Some carriers and some made-up names are kept
out of training; the probability that a family's prediction has to reach is calibrated on them. A prediction is
confirmed if most of the part's 2-grams are in templates of its family, or the part holds most of one template.

Only DataFrame and ML functions that run in the JVM.

Cases: a null or empty text has no paragraphs and gives no rows; a repeated row gives its findings again; null
ids are allowed; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clientlens.llm.common import drawn, staged

UNKNOWN, NONE = "unknown", "none"

# Names of licence families in notices (fixed values).
NAMES = {
    "MIT": ("the MIT License", "the MIT license", "MIT", "the Expat License"),
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache 2.0", "the Apache-2.0 license", "the Apache License 2.0", "der Apache-Lizenz"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GNU GPL v3", "GPL-3.0", "GPLv3", "the GPL version 3 or later"),
    "GPL-2.0": ("the GNU General Public License, version 2", "the GNU GPL v2", "GPL-2.0", "GPLv2", "the GPL version 2"),
    "LGPL": ("the GNU Lesser General Public License", "the GNU LGPL", "LGPL-2.1", "LGPLv3", "the GNU Lesser General Public License, version 2.1"),
    "AGPL-3.0": ("the GNU Affero General Public License", "the GNU AGPL", "AGPL-3.0", "AGPLv3"),
    "MPL-2.0": ("the Mozilla Public License", "the Mozilla Public License, v. 2.0", "MPL-2.0", "MPL 2.0"),
    "BSD": ("the BSD License", "the BSD 3-Clause License", "BSD-3-Clause", "the BSD 2-Clause License", "the simplified BSD license"),
    "ISC": ("the ISC License", "ISC", "the ISC license"),
    "CC-BY-NC": ("CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC"),
    "CC-BY-SA": ("CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA"),
    "CC-BY": ("CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "CC BY"),
    "CC0": ("CC0", "CC0 1.0", "the Creative Commons Zero dedication"),
    "Unlicense": ("the Unlicense", "Unlicense"),
    # Made up, or without a family.
    UNKNOWN: (
        "the Foobar License", "a custom license", "the Acme Public License, version 1.0", "our own terms", "the Zeta Source License 2.0",
        "a proprietary license", "the Northwind Community License", "your end user license agreement", "the Quux Licence",
        "the Sample Mutual Sharing Pact", "the Example Foundation General License", "the license of the publisher",
    ),
}

# Sentences that a name stands in (fixed values); every fourth is kept out of training.
CARRIERS = (
    "Released under {}.", "Licensed under {}.", "This project is licensed under the terms of {}.", "This file is under the terms of {}.",
    "This work is licensed under {}.", "This software is distributed under {}.", "The code is available under {}.", "Published under {}.",
    "This program is licensed under {}.", "See the LICENSE file; it is covered by {}.", "SPDX-License-Identifier: {}", "License: {}",
    "All source code here is released under {}.", "You may use it under the terms of {}.", "This library is free software under {}.",
    "Das Projekt steht unter {}.", "Veröffentlicht unter {}.", "Dieses Werk ist lizenziert unter {}.", "Ce logiciel est publié sous {}.",
    "Distribué sous {}.", "Publicado bajo {}.", "Este programa se distribuye bajo {}.", "{} applies to this document.", "Copyright the authors, {}.",
)

# Sentences of licence texts (fixed values, from the public texts); those that several licences share are `unknown`.
TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    ("AGPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work and dedicated it to the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    (UNKNOWN, "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    (UNKNOWN, "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    (UNKNOWN, "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    (UNKNOWN, "All rights reserved."),
    (UNKNOWN, "Copyright by the authors. All rights reserved."),
    (UNKNOWN, "Unauthorized copying of this file is strictly prohibited."),
    (UNKNOWN, "Use of this material requires the written permission of the copyright holder."),
)

# Ordinary sentences with words of licences (fixed values).
ORDINARY = (
    "The driver showed his license to the officer and asked for permission to leave.", "She studied physics at MIT before she moved to Boston.",
    "The Apache helicopter landed near the village.", "He bought a refrigerator with a two year warranty.", "A fishing licence for the lake costs ten euros.",
    "The general public was not informed of the version of events.", "Copyright law is taught in the third year.", "They were free to use the source of the river.",
    "The commons of the village were open to all, under certain conditions.", "Mozilla published a new version of its browser.", "The software was released in May.",
    "Der Fahrer zeigte seinen Führerschein, die Lizenz zum Fahren.", "Il a obtenu une licence de lettres.",
)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def notices() -> Iterator[tuple[str, str, bool]]:
    """(family, text, kept out) of all notices: names in carriers, and sentences of licence texts."""
    for family, names in NAMES.items():
        for n, name in enumerate(names):
            for c, carrier in enumerate(CARRIERS):
                yield family, carrier.format(name), c % 4 == 3 or (family == UNKNOWN and n % 3 == 2)
    for family, text in TEXTS:
        yield family, text, False
    for n, text in enumerate(ORDINARY):
        yield NONE, text, n % 4 == 3


def parts(docs: DataFrame, id_col: str, text_col: str, longest: int = 80, step: int = 60) -> DataFrame:
    """(id, paragraph, sentence, body, words) of all parts of all paragraphs, both numbered from 0.

    A sentence of over `longest` words is scored in windows of so many, one every `step` words; they share its number.
    """
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = found.select("id", F.posexplode(F.split("text", r"\n[ \t\r]*+\n\s*+")).alias("paragraph", "lines"))
    sentences = F.split(F.replace("lines", F.lit("\n"), F.lit(" ")), r"(?<=[.!?])\s++")
    found = found.select("id", "paragraph", F.posexplode(sentences).alias("sentence", "body"))
    # Out of an explode the words are a value, which is not computed again for each of its uses.
    found = found.select("*", F.explode(F.array(words(F.col("body")))).alias("all")).where(F.size("all") > 0)
    size = F.size("all")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((size - longest) / step), F.lit(0)).cast("int"))
    windows = F.when(size <= longest, F.array("all")).otherwise(F.transform(starts, lambda i: F.slice("all", i * step + 1, longest)))
    body = F.when(size <= longest, F.col("body")).otherwise(F.array_join("words", " "))
    return found.select("*", F.explode(windows).alias("words")).select("id", "paragraph", "sentence", body.alias("body"), "words")


def _grams() -> list:
    """Words and pairs of neighbours that notices hold, present or not."""
    return [
        CountVectorizer(inputCol="words", outputCol="f1", vocabSize=1 << 14, binary=True),
        NGram(n=2, inputCol="words", outputCol="pairs"),
        CountVectorizer(inputCol="pairs", outputCol="f2", vocabSize=1 << 14, binary=True),
        VectorAssembler(inputCols=["f1", "f2"], outputCol="features"),
    ]


def _notices(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(notices()), "family string, body string, kept_out boolean")
    return rows.withColumn("words", words(F.col("body")))


@dataclass
class Classifier:
    model: PipelineModel
    families: list[str]
    least: float  # calibrated probability from which a family counts
    active: list[str]  # words that have a weight, alone or in a pair


def _active(model: PipelineModel) -> list[str]:
    """Words without which a part's scores are the intercepts."""
    single, _, double, _, regression = model.stages
    rows, columns = regression.coefficientMatrix.numRows, regression.coefficientMatrix.numCols
    weights = regression.coefficientMatrix.toArray().reshape(rows, columns)
    terms = [*single.vocabulary, *double.vocabulary]
    return sorted({word for n in weights.any(axis=0).nonzero()[0] for word in terms[n].split(" ")})


def train(docs: DataFrame, *, text_col: str = "text", ordinary_rows: int = 200, wrong: float = 0.01) -> Classifier:
    """Learn from the notices and from the sentences of about `ordinary_rows` different documents (the bound of the
    sample, chosen by hash).

    Of the notices and sentences kept out that are not of the family they are taken for, at most a share of
    `wrong` reaches the probability from which a family counts.
    """
    spark = docs.sparkSession
    made = _notices(spark)
    families = sorted({family for family, _, _ in notices()})
    # A licence text is met in pieces, too.
    cut = F.when(F.size("words") > 24, F.transform(F.sequence(F.lit(0), F.size("words") - 12, F.lit(6)), lambda i: F.slice("words", i + 1, 18)))
    pieces = made.select("family", "kept_out", F.explode(F.concat(F.array("words"), F.coalesce(cut, F.array()))).alias("words"))

    few = drawn(docs.select(F.col(text_col).alias("text")).dropna(), "text", ordinary_rows)
    own = made.where(F.col("family") != NONE).select("body")
    ordinary = parts(few.select(F.lit(0).alias("id"), "text"), "id", "text").join(own, "body", "left_anti")
    ordinary = ordinary.select(F.lit(NONE).alias("family"), (F.pmod(F.xxhash64("body"), F.lit(4)) == 3).alias("kept_out"), "words").distinct()

    index = F.array_position(F.lit(families), F.col("family")).cast("double") - 1
    rows = pieces.unionByName(ordinary).withColumn("label", index)
    totals = rows.groupBy("label").agg(F.count("*").alias("n"))
    rows = rows.join(totals, "label").withColumn("weight", 1.0 / F.sqrt("n"))
    rows = staged(rows.coalesce(1), "licence-training")
    grams = Pipeline(stages=_grams()).fit(made.where(F.col("family") != NONE).select("words"))
    regression = LogisticRegression(weightCol="weight", family="multinomial", elasticNetParam=1.0, regParam=2e-4, maxIter=60)
    model = PipelineModel([*grams.stages, regression.fit(grams.transform(rows.where("not kept_out")))])

    said = model.transform(rows.where("kept_out")).select("label", "prediction", F.array_max(vector_to_array("probability")).alias("p"))
    named = ~F.element_at(F.lit(families), F.col("prediction").cast("int") + 1).isin(UNKNOWN, NONE)
    others = F.element_at(F.lit(families), F.col("label").cast("int") + 1).isin(UNKNOWN, NONE)
    missed = F.when(named & (F.col("label") != F.col("prediction")), F.col("p")).otherwise(0.0)
    least = said.where(others).agg(F.percentile(missed, 1 - wrong)).first()[0]
    # Without any word that has a weight a part has to be ordinary; else nothing may be passed over.
    bare = families[int(model.stages[-1].interceptVector.argmax())] == NONE
    return Classifier(model, families, min(0.95, max(0.5, least or 0.5)), _active(model) if bare else [])


def scan(docs: DataFrame, classifier: Classifier, *, id_col: str = "doc_id", text_col: str = "text", confirmed: float = 0.6) -> DataFrame:
    """(id, paragraph, sentence, licence, predicted, probability, template_share, confirmed, body) of every part
    taken for a licence notice."""
    found = parts(docs, id_col, text_col)
    if classifier.active:
        found = found.where(F.arrays_overlap("words", F.lit(classifier.active)))
    found = classifier.model.transform(found).select(
        "id", "paragraph", "sentence", "body", "pairs",
        F.element_at(F.lit(classifier.families), F.col("prediction").cast("int") + 1).alias("predicted"),
        F.array_max(vector_to_array("probability")).alias("probability"),
    )
    made = _notices(docs.sparkSession)
    at = F.sequence(F.lit(1), F.greatest(F.size("words") - 1, F.lit(1)))
    made = made.select("family", F.transform(at, lambda i: F.array_join(F.slice("words", i, 2), " ")).alias("pairs_of"))
    templates = made.groupBy("family").agg(
        F.collect_list("pairs_of").alias("templates"), F.array_distinct(F.flatten(F.collect_list("pairs_of"))).alias("known")
    )
    found = found.where(F.col("predicted") != NONE).join(templates, F.col("predicted") == F.col("family"), "left")
    shared = F.size(F.array_intersect("pairs", "known")) / F.greatest(F.size(F.array_distinct("pairs")), F.lit(1))
    # A notice inside a longer sentence: most of one template, of three pairs at least.
    held = lambda t: F.when(F.size(t) > 2, F.size(F.array_intersect("pairs", t)) / F.size(t)).otherwise(0.0)
    share = F.greatest(F.coalesce(shared, F.lit(0.0)), F.coalesce(F.array_max(F.transform("templates", held)), F.lit(0.0)))
    found = found.withColumn("template_share", share)
    sure = (F.col("probability") >= classifier.least) & (F.col("template_share") >= confirmed) & (F.col("predicted") != UNKNOWN)
    return found.select(
        F.col("id").alias(id_col), "paragraph", "sentence",
        F.when(sure, F.col("predicted")).otherwise(UNKNOWN).alias("licence"), "predicted",
        F.round("probability", 4).alias("probability"), F.round("template_share", 4).alias("template_share"),
        sure.alias("confirmed"), "body",
    )
