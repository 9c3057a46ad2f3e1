"""Licence families of paragraphs, with DataFrame functions only.

Model. A multinomial logistic regression over word n-grams (1 to 3), trained
here on paragraphs made from short public licence notices (each notice, cut and
thinned versions of it, and notices within other words), against sentences about
licences in general and a bounded sample of the corpus' own paragraphs
(``NEGATIVES`` at most) as the class ``unknown``. An elastic-net penalty makes
the weights sparse. On held-out paragraphs a temperature is chosen by log loss
and the least probability at which a family is told (otherwise ``unknown``) by
precision.

Scan. Every paragraph (a line that isn't blank) is scored where it is read, by
the counter and the regression, which are bounded by the notices' n-grams. A
prediction is confirmed if the paragraph and one of the family's notices share
enough of their n-grams (containment).

Defined results: null and empty texts have no paragraphs; rows that repeat in
full are counted once and reported each; an empty table gives no rows; extra
columns are never looked at; whole texts are read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, text_or_empty

NEGATIVES = 4_000
WORDS = r"[^a-z0-9]+"

# --- fixed values: short public notices of licence families, as they are usually worded
NOTICES = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This software is proprietary and confidential. Unauthorized copying is strictly prohibited.",
    ],
}
# --- fixed values: sentences about licences that grant none
OTHER = [
    "He lost his driving license last year and had to take the test again.",
    "The city council granted the restaurant a new license to sell wine.",
    "A license is required to fish in this river.",
    "The apache helicopter landed near the village.",
    "Students at MIT presented their work to the public.",
    "The general public is invited to the free concert.",
    "Version 3 of the report was released in May.",
    "The source of the river is in the mountains and it is free of ice.",
    "Copyright law protects authors of original works.",
    "The library is open to any person free of charge.",
    "Permission to enter the building was granted by the office.",
    "The terms of the agreement were published by the foundation.",
]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def all_ngrams(w: Column, longest: int = 3) -> Column:
    """N-grams of 1 to ``longest`` words, as often as they occur."""

    def of(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, each).otherwise(F.expr("cast(array() as array<string>)"))

    return F.concat(w, *[of(n) for n in range(2, longest + 1)])


def ngrams(w: Column, longest: int = 3) -> Column:
    """Distinct n-grams of 1 to ``longest`` words."""
    return F.array_distinct(all_ngrams(w, longest))


def training_set(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """``(family, w, fold)``: words of training paragraphs; fold 0 is held out.

    Every notice gives itself and versions of it: its first and last two
    thirds, each fourth word left out, and itself between two ordinary words.
    """
    rows = [(f, t) for f, ts in NOTICES.items() for t in ts]
    notices = spark.createDataFrame(rows, "family string, t string").select("family", words(F.col("t")).alias("w"))
    n = F.size("w")
    versions = [F.col("w"), F.concat(F.array(F.lit("here")), F.col("w"), F.array(F.lit("today")))]
    part = F.greatest(F.ceil(n * 2 / 3), F.least(n, F.lit(4))).cast("int")
    versions += [F.slice("w", F.lit(1), part), F.slice("w", n - part + 1, part)]

    def thinned(k: int) -> Column:
        return F.filter("w", lambda x, i: (i % 8 != 2 * k + 1) | (n < 8))

    versions += [thinned(k) for k in range(4)]
    made = notices.select("family", F.explode(F.array(*versions)).alias("w"))
    other = spark.createDataFrame([(t,) for t in OTHER], "t string").select(F.lit("unknown").alias("family"), words(F.col("t")).alias("w"))
    # a bounded sample of the corpus: paragraphs with the smallest hashes, without licence cues
    lines = docs.select(F.explode(F.split(text_or_empty(text), "\n")).alias("t"))
    lines = lines.where(F.trim("t") != "").withColumn("h", F.xxhash64(F.lit(1), "t"))
    cue = F.lower("t").rlike(CUE_PATTERN)
    sample = lines.where(~cue).orderBy("h").limit(NEGATIVES).dropDuplicates(["h"])
    ordinary = sample.select(F.lit("unknown").alias("family"), words(F.col("t")).alias("w"))
    every = made.unionByName(other).unionByName(ordinary).where(F.size("w") > 0)
    return every.withColumn("fold", F.pmod(F.xxhash64(F.lit(3), "family", "w"), F.lit(5)))


# words that keep a paragraph out of the sample of ordinary ones: those of the notices that ordinary text has no use for
CUES = sorted(
    "license licensed licence licenced licenses copyright spdx gpl lgpl agpl mit apache bsd mozilla mpl cc0 gnu affero creative "
    "redistribution redistribute permission proprietary confidential unencumbered waived reserved warranty "
    "sharealike noncommercial domain".split()
)
CUE_PATTERN = r"\b(?:" + "|".join(CUES) + r"|cc[ -]by)\b"


class LicenseModel:
    """The fitted counter of n-grams and regression with its families, the notices' n-grams, and the calibration."""

    def __init__(self, counter, regression, families: list[str], notices: DataFrame, temperature: float, least: float):
        self.counter, self.regression, self.families = counter, regression, families
        self.notices, self.temperature, self.least = notices, temperature, least


def _scores(paragraphs: DataFrame, counter, regression, families: list[str]) -> DataFrame:
    """``paragraphs`` (with words ``w``) and ``z``: every family's margin and name."""
    counted = counter.transform(paragraphs.withColumn("grams", all_ngrams(F.col("w"))))
    margins = regression.transform(counted).withColumn("margins", vector_to_array("margins"))
    names = F.array(*[F.lit(x) for x in families])
    return margins.withColumn("z", F.zip_with("margins", names, lambda z, f: F.struct(z.alias("z"), f.alias("family")))).drop(
        "grams", "features", "margins"
    )


def _best(z: Column, temperature: float) -> Column:
    """An array of one: the family of the largest probability, and that probability ``p``."""

    def of(each: Column) -> Column:
        top = F.array_max(each)
        total = F.aggregate(each, F.lit(0.0), lambda s, x: s + F.exp(x["z"] / F.lit(temperature)))
        return F.struct(top["family"].alias("family"), (F.exp(top["z"] / F.lit(temperature)) / total).alias("p"))

    return F.transform(F.array(z), of)


def fit(spark: SparkSession, docs: DataFrame, text: str = "text") -> LicenseModel:
    rows = checkpointed(training_set(spark, docs, text))
    train = rows.where("fold <> 0")
    # features: the notices' n-grams only, so the model is bounded by the notices
    notice = spark.createDataFrame([(f, i, t) for f, ts in NOTICES.items() for i, t in enumerate(ts)], "family string, nid int, t string")
    notice = notice.select("family", "nid", ngrams(words(F.col("t"))).alias("grams"))
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(notice)
    labels = sorted([*NOTICES, "unknown"])
    number = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("family")).cast("double") - 1
    ready = counter.transform(train.select("family", ngrams(F.col("w")).alias("grams"))).withColumn("label", number)
    # each class weighs the same
    counts = {r["family"]: r["count"] for r in ready.groupBy("family").count().collect()}
    weight = F.element_at(F.create_map(*[F.lit(x) for f, c in counts.items() for x in (f, 1.0 / c)]), F.col("family"))
    model = LogisticRegression(
        family="multinomial", regParam=2e-4, elasticNetParam=0.5, maxIter=60, weightCol="cw", labelCol="label", featuresCol="features",
        standardization=False, rawPredictionCol="margins", probabilityCol="", predictionCol="",
    ).fit(ready.withColumn("cw", weight * F.lit(1000.0)))
    # calibration on held-out paragraphs: temperature by log loss, least probability by precision
    held = rows.where("fold = 0").select(F.col("family").alias("truth"), "w")
    z = checkpointed(_scores(held, counter, model, labels).select("truth", "z"))
    temperatures = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
    own = F.array_max(F.filter("z", lambda x: x["family"] == F.col("truth")))["z"]
    total = lambda t: F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp(x["z"] / t))
    losses = z.agg(*[F.avg(F.log(total(t)) - own / t).alias(f"x{i}") for i, t in enumerate(temperatures)]).first()
    losses = [x if x is not None else 0.0 for x in losses]
    temperature = temperatures[losses.index(min(losses))]
    told = z.select("truth", F.inline(_best(F.col("z"), temperature))).where("family <> 'unknown'")
    steps = [0.5, 0.6, 0.7, 0.8, 0.9]
    seen = told.agg(*[
        F.coalesce(F.avg(F.when(F.col("p") >= s, (F.col("family") == F.col("truth")).cast("double"))), F.lit(1.0)).alias(f"s{i}")
        for i, s in enumerate(steps)
    ]).first()
    least = next((s for s, precision in zip(steps, seen) if precision >= 0.98), steps[-1])
    grams = notice.select("family", "nid", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
    return LicenseModel(counter, model, labels, checkpointed(grams), temperature, least)


def tell(paragraphs: DataFrame, model: LicenseModel) -> DataFrame:
    """Every one of ``paragraphs`` (with words ``w``) is scored; those that a family is told for, with ``family`` and ``p``."""
    scored = _scores(paragraphs, model.counter, model.regression, model.families)
    told = F.filter(_best(F.col("z"), model.temperature), lambda x: (x["family"] != "unknown") & (x["p"] >= model.least))
    return scored.select(*paragraphs.columns, F.inline(told))


def confirm(told: DataFrame, model: LicenseModel, contained: float = 0.6) -> DataFrame:
    """``(id, family, p, contained, confirmed)`` for told paragraphs ``(id, w, family, p)``."""
    grams = told.select("id", "family", F.size(ngrams(F.col("w"))).alias("own"), F.explode(ngrams(F.col("w"))).alias("gram"))
    shared = grams.join(F.broadcast(model.notices), ["family", "gram"]).groupBy("id", "nid", "size", "own").agg(F.count(F.lit(1)).alias("both"))
    best = shared.groupBy("id").agg(F.max(F.col("both") / F.least("size", "own")).alias("contained"))
    out = told.select("id", "family", "p").join(best, "id", "left").withColumn("contained", F.coalesce("contained", F.lit(0.0)))
    return out.withColumn("confirmed", F.col("contained") >= contained)


def scan_paragraphs(paragraphs: DataFrame, model: LicenseModel, contained: float = 0.6) -> DataFrame:
    """``(id, family, p, contained, confirmed)`` for paragraphs ``(id, w)`` that a family is told for."""
    return confirm(tell(paragraphs.select("id", "w"), model), model, contained)


def scan(docs: DataFrame, model: LicenseModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its paragraphs, those told a licence, the confirmed families and the largest probability."""
    body = text_or_empty(text)
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc"), F.xxhash64(body).alias("th"), body.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.trim(x) != "")
    counted = rows.select("doc", "th", F.size(lines).cast("long").alias("n_paragraphs"))
    every = rows.select("doc", "th", F.posexplode(lines).alias("pos", "par")).withColumn("w", words(F.col("par")))
    told = tell(every, model).withColumn("ph", F.md5("par")).dropDuplicates(["doc", "th", "pos"])
    told = checkpointed(told.drop("par"))
    # equal paragraphs are compared with the notices once
    distinct = told.dropDuplicates(["ph"]).select(F.col("ph").alias("id"), "w", "family", "p")
    found = confirm(distinct, model).select("id", "confirmed")
    per_doc = told.join(found, F.col("ph") == F.col("id")).groupBy("doc", "th").agg(
        F.count(F.lit(1)).alias("n_licensed"), F.count(F.when(F.col("confirmed"), 1)).alias("n_confirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
        F.max("p").alias("p"),
    )
    out = counted.join(per_doc, ["doc", "th"], "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("doc").try_cast(docs.schema[key].dataType).alias(key), "n_paragraphs",
        F.coalesce("n_licensed", zero).alias("n_licensed"), F.coalesce("n_confirmed", zero).alias("n_confirmed"),
        F.coalesce("families", F.lit("")).alias("families"), F.coalesce("p", F.lit(0.0)).alias("probability"),
    )
