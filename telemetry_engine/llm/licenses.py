"""Licence notices in documents: a trained paragraph classifier, confirmed by templates.

A paragraph is a line.  Its features are the words and pairs of words (lower
case, letters and digits) of the templates below that it holds, present or not.
A sparse (L1) multinomial logistic regression over licence families and
``none`` is trained on the templates, their parts, and at most ``SAMPLE``
paragraphs of the corpus that share no three-word run with a template (chosen
by a hash).  A paragraph is a notice if ``none`` has a probability below one
half.  A family whose probability stays below a threshold is ``unknown``; the
threshold is calibrated on the templates' parts (0.8 of what all but a
twentieth reach), at least ``MIN_KNOWN``.  A prediction is confirmed when a template of the family is
similar: the share of the smaller set of word pairs that both have is at least
``CONFIRM``.  An unconfirmed prediction is ``unknown`` too.

Only paragraphs with a telling feature are scored.  The intercepts favour
``none``, and features whose weights together cannot make up for that are not
telling; a paragraph with no others cannot be a notice.

All of it is DataFrame, SQL and Spark ML functions.  Null and empty texts have
no paragraph; rows are treated one by one, so repeated rows and null ids change
nothing; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

SAMPLE = 2_000
MIN_KNOWN = 0.5
CONFIRM = 0.5
NONE, UNKNOWN = "none", "unknown"

# Notices of the licence families, as their licences or usual practice word them.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This work is licensed under the GNU General Public License, version 2.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction.",
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Distributed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under the Creative Commons Attribution license CC BY.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Free for non-commercial use under the Creative Commons Attribution-NonCommercial license.",
    ],
    "proprietary": [
        "Copyright. All rights reserved. No part of this work may be reproduced without the prior written permission "
        "of the publisher.",
        "All rights reserved.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++"), F.lit(0))


def _runs(words: Column, size: int) -> Column:
    """All runs of ``size`` words."""
    n = F.size(words)
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))),
                                         lambda i: F.array_join(F.slice(words, i, size), " "))
                  ).otherwise(F.expr("cast(array() AS array<string>)"))


def _features(words: Column) -> Column:
    return F.array_distinct(F.concat(words, _runs(words, 2)))


ORDINARY = [
    "The morning train was late again, and nobody on the platform seemed surprised.",
    "Add the flour slowly and stir until no lumps are left, then let it rest for an hour.",
    "Results of the second run were close to those of the first, with less noise.",
    "She opened the window to hear the rain better and went on reading.",
    "The committee will meet on Thursday to go over the budget for the coming year.",
    "Our team lost the final by two points after a long and even game.",
    "A short walk along the river leads to the old mill and its garden.",
    "Please send me the photographs from the trip when you find the time.",
]


def _templates(spark: SparkSession) -> DataFrame:
    """(template, family, text): the templates whole, a fixed number of rows."""
    rows = [(n, family, text) for n, (family, text) in
            enumerate((f, t) for f, texts in TEMPLATES.items() for t in texts)]
    return spark.createDataFrame(rows, "template int, family string, text string").coalesce(1)


def _examples(templates: DataFrame) -> DataFrame:
    """(family, words): templates, and those of more than 12 words in halves too."""
    w = templates.select("family", _words(F.col("text")).alias("w"))
    half = (F.size("w") / 2).cast("int")
    long = w.where(F.size("w") > 12)
    return (w.unionAll(long.select("family", F.slice("w", F.lit(1), half)))
            .unionAll(long.select("family", F.slice("w", half + 1, F.size("w"))))
            .withColumnRenamed("w", "words"))


class Classifier:
    def __init__(self, vectorizer: CountVectorizerModel, regression: LogisticRegressionModel, families: list[str],
                 threshold: float, common: dict[str, int]):
        """common: in how many paragraphs of the sample each feature occurs."""
        self.vectorizer, self.regression, self.families, self.threshold = vectorizer, regression, families, threshold
        weights, bias = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
        if not (bias[1:] < bias[0]).all():
            raise ValueError("without features a paragraph must be no notice")
        speak = {t: float((weights[1:, k] - weights[0, k]).max()) for k, t in enumerate(vectorizer.vocabulary)}
        # A notice needs a family within log(families) of ``none``.  Common features whose weights together
        # cannot close the intercepts' gap are not enough: a notice holds one of the others.
        left = float((bias[0] - bias[1:]).min()) - math.log(len(families) - 1)
        self.terms = []
        for t in sorted((t for t in speak if speak[t] > 0), key=lambda t: (-common.get(t, 0) / speak[t], t)):
            if common.get(t, 0) and speak[t] < left:
                left -= speak[t]
            else:
                self.terms.append(t)
        #: a word of each such feature, the rarer one of a pair
        self.words = sorted({min(t.split(" "), key=lambda w: (common.get(w, 0), w)) for t in self.terms})

    def scored(self, df: DataFrame) -> DataFrame:
        """Adds ``p``, the probabilities of ``families``, to a table with ``features``."""
        got = self.regression.transform(self.vectorizer.transform(df))
        return got.withColumn("p", vector_to_array("probability")).drop(
            "vector", "rawPrediction", "probability", "prediction")


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, text): the non-empty lines, numbered from 0 within the document."""
    return (docs.select(C.col(id_col).alias("doc_id"), F.posexplode(F.split(C.col(text_col).cast("string"), "\n", -1))
                        .alias("paragraph", "text")).where(F.trim("text") != ""))


def _distinct_sample(lines: DataFrame, size: int) -> DataFrame:
    """At most ``size`` distinct lines, those of the least hash.

    An estimate of the number of distinct lines cuts by the hash first, with room to spare, so that only
    some twice ``size`` of them and their copies meet, map-side combined.
    """
    h = F.shiftrightunsigned(F.xxhash64("text"), 1)
    n = lines.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    if n > 4 * size:
        lines = lines.where(h < int(2 * size / n * (1 << 63)))
    return lines.distinct().orderBy(h, "text").limit(size)


def train(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> Classifier:
    """Fit on the templates and at most ``sample`` paragraphs of the corpus."""
    spark = docs.sparkSession
    templates = _templates(spark)
    runs = [r["run"] for r in templates.select(F.explode(_runs(_words(F.col("text")), 3)).alias("run")).distinct().collect()]
    known = F.array(*[F.lit(r) for r in sorted(runs)])  # fixed: the templates' runs
    lines = docs.select(F.explode(F.split(C.col(text_col).cast("string"), "\n", -1)).alias("text")).where(F.trim("text") != "")
    # whole paragraphs; twice as many as wanted, as some may resemble a template
    some = _distinct_sample(lines, 2 * sample).select(F.lit(NONE).alias("family"), "text")
    some = (C.computed(some, words=_words(F.col("text"))).drop("text")
            .where(~F.arrays_overlap(_runs(F.col("words"), 3), known)).orderBy(F.xxhash64("words")).limit(sample))
    # so that there is ordinary text to learn from in any corpus
    plain = spark.createDataFrame([(NONE, t) for t in ORDINARY], "family string, text string").coalesce(1)
    some = some.unionByName(plain.select("family", _words(F.col("text")).alias("words")))
    examples = _examples(templates)
    families = [NONE, *TEMPLATES]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    data = examples.unionByName(some).select(number.cast("double").alias("label"),
                                             _features(F.col("words")).alias("features"))
    data = C.store(data.coalesce(1), C.work_dir(spark, "licences"))
    vocabulary = sorted(r["f"] for r in examples.select(F.explode(_features(F.col("words"))).alias("f")).distinct().collect())
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary, "features", "vector", binary=True)
    vectors = vectorizer.transform(data)
    counts = {r["label"]: r["count"] for r in vectors.groupBy("label").count().collect()}
    # half of the weight to ``none``, the rest to the families alike
    share = {label: 1.0 / c * (1.0 if label else len(TEMPLATES)) for label, c in counts.items()}
    weight = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col("label"))
    regression = LogisticRegression(featuresCol="vector", family="multinomial", weightCol="weight", regParam=2e-4,
                                    elasticNetParam=1.0, maxIter=100).fit(vectors.withColumn("weight", weight))
    common = {r["f"]: r["count"] for r in data.where("label = 0").select(F.explode("features").alias("f"))
              .where(F.col("f").isin(vocabulary)).groupBy("f").count().collect()}
    model = Classifier(vectorizer, regression, families, MIN_KNOWN, common)
    own = model.scored(data.where("label > 0")).select(F.get("p", F.col("label").cast("int")).alias("p"))
    model.threshold = max(MIN_KNOWN, float(own.agg(F.percentile_approx("p", 0.05)).first()[0]) * 0.8)
    return model


def scan(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, family, probability, template, similarity, text) of every paragraph that is a notice."""
    spark = docs.sparkSession
    few = lambda values: F.array(*map(F.lit, values))  # noqa: E731  the templates' own words, a fixed number
    rows = C.computed(paragraphs(docs, id_col, text_col), words=_words(F.col("text")))
    rows = C.computed(rows.where(F.arrays_overlap("words", few(model.words))), features=_features(F.col("words")))
    rows = rows.where(F.arrays_overlap("features", few(model.terms)))
    rows = model.scored(rows).where(F.get("p", F.lit(0)) < 0.5)
    best = F.array_max(F.transform("p", lambda p, i: F.struct(F.when(i == 0, -1.0).otherwise(p).alias("p"), (-i).alias("i"))))
    rows = (rows.withColumn("best", best)
            .withColumn("family", F.element_at(F.array(*map(F.lit, model.families)), 1 - F.col("best.i")))
            .withColumn("pairs", _runs(F.col("words"), 2)))
    # a fixed number of templates, compared with the paragraphs of their family
    own = _templates(spark).select("template", "family", _runs(_words(F.col("text")), 2).alias("own"))
    row = [F.col(c) for c in ("doc_id", "paragraph", "family", "best", "text")]
    lists = own.groupBy("family").agg(F.collect_list(F.struct("template", "own")).alias("templates"))
    near = F.array_max(F.transform("templates", lambda t: F.struct(
        _closeness(F.col("pairs"), t["own"]).alias("s"), (-t["template"]).alias("t"))))
    got = rows.join(F.broadcast(lists), "family").select(*row, near.alias("near"))
    sure = (F.col("best.p") >= model.threshold) & (F.col("near.s") >= CONFIRM)
    return got.select("doc_id", "paragraph", F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"),
                      F.col("best.p").alias("probability"), (-F.col("near.t")).alias("template"),
                      F.col("near.s").alias("similarity"), "text")


def _closeness(a: Column, b: Column) -> Column:
    """Share of the smaller set that both have."""
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))
