"""Licence notices in whole texts, with DataFrame and MLlib functions only.

Paragraphs are lines, and notices that run over several lines. Lines that hold a cue, a word without which no template
sentence is whole, are classified: word
bigrams and trigrams that occur in the templates feed a multinomial logistic regression over licence families and
``unknown``. It is trained here, on template sentences with words left out at fixed hashes and on ``UNKNOWN`` sentences and
at most ``SAMPLE`` paragraphs of the corpus. An isotonic fit on held-out variants turns the chance of any known family
into a calibrated one. A prediction counts as confirmed if the paragraph also holds most bigrams of a template sentence
of the family.

Texts with a cue are also read as words without regard to lines, comment marks and blank lines, in overlapping windows of
``SPAN`` words. A template sentence is found in a window that holds most of its bigrams, and most of those that no other
family has, unless a similar sentence of another family that is found too holds more of what tells the two apart. A
family found so is a finding of its own, next to that of a line, so two licences give two rows.

Defined results: null and empty texts have no findings; every line with a cue is a finding, those below ``KNOWN`` or not
confirmed with family ``unknown``, but for lines that belong to a notice over several lines; such a notice has the number of
its first line and its lines joined; lines are numbered from 0, whatever other lines hold; rows with null or
repeated ids have findings like any other; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import common

#: Notices by family, a sentence each. They are what such notices say.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability',
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "as is" basis, without warranties or conditions of any kind',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL version 3 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU GPL version 2 only.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"),
    "public domain": (
        "This work is released into the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "ISC": ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
}
#: Sentences about rights that name none of the families.
UNKNOWN = (
    "Copyright the authors. All rights reserved.",
    "Licensed under the terms that you can find in the LICENSE file.",
    "This work is licensed under a license of its own, version 7.",
    "Released under the Example Vendor License, version 1.",
    "You need the permission of the owner to use this software.",
    "The driver has a licence and the warranty covers two years.",
    "No part of this work may be copied without the permission of the publisher.",
    "The software license of this vendor is not free.",
    "Please read the license agreement before you use the software.",
)
CUES = ("licens", "licenc", "copyright", "spdx", "permission", "warrant", "redistribut", "public domain", "gpl", "mozilla public")
SAMPLE = 2_000
#: Variants of each template sentence; of variant v, v in VARIANTS * 2 words are left out.
VARIANTS = 24
KNOWN, CONFIRMED = 0.5, 0.6
#: Words read together; windows begin at every half of it, and no template has as many as that.
SPAN = 128
#: Share of a template's bigrams from which on another family's sentence is compared with it.
ALIKE = 0.3
SENTENCES = "array<struct<family:string,own:array<string>,marks:array<string>,rivals:array<struct<own:array<string>,mine:array<string>,theirs:array<string>>>>>"


def words_in(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def grams(words: Column, n: int) -> Column:
    last = F.size(words) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), F.greatest(last + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def with_grams(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``two`` and ``terms``: distinct bigrams, and bigrams and trigrams."""
    rows = rows.withColumn("__w", words_in(F.col(text)))
    return rows.withColumn("two", F.array_distinct(grams(F.col("__w"), 2))).withColumn("terms", F.concat("two", grams(F.col("__w"), 3))).drop("__w")


def _template_bigrams() -> list[dict]:
    """Bigrams of each template sentence, those of no other family, and what tells it from similar sentences."""
    rows = []
    for family, sentences in TEMPLATES.items():
        for sentence in sentences:
            words = re.findall(r"[^\W_]+", sentence.lower())
            rows.append((family, dict.fromkeys(map(" ".join, zip(words, words[1:], strict=False))).keys()))
    out = []
    for family, own in rows:
        others = [two for name, two in rows if name != family]
        rivals = [{"own": list(two), "mine": sorted(own - two), "theirs": sorted(two - own)} for two in others if len(own & two) >= ALIKE * len(own)]
        out.append({"family": family, "own": list(own), "marks": sorted(own - set().union(*others)), "rivals": rivals})
    return out


def _share(own: Column, two: Column) -> Column:
    return F.when(F.size(own) == 0, 1.0).otherwise(F.size(F.array_intersect(own, two)) / F.size(own))


def _found(two: Column) -> Column:
    """Template sentences that the bigrams ``two`` hold: none if no bigram of a single family is among them."""
    is_held = lambda t: _share(t["own"], two) >= CONFIRMED
    beaten = lambda r: is_held(r) & (_share(r["theirs"], two) > _share(r["mine"], two))
    listed = F.from_json(F.lit(json.dumps(_template_bigrams())), SENTENCES)
    return F.filter(listed, lambda t: (_share(t["marks"], two) >= CONFIRMED) & is_held(t) & ~F.exists(t["rivals"], beaten))


def _marked(two: Column) -> Column:
    marks = sorted({mark for s in _template_bigrams() for mark in s["marks"]})
    return F.arrays_overlap(two, F.split(F.lit("\n".join(marks)), "\n"))


def with_notices(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``lines`` and ``notices`` (family, share, lines).

    Sentences that one line with a cue holds alone are not among them.
    """
    rows = docs.withColumn("lines", F.split("text", "\n", -1))
    words = F.flatten(F.transform("lines", lambda line, i: F.transform(words_in(line), lambda w: F.struct(w.alias("w"), i.alias("i")))))
    rows = rows.withColumn("__words", words)
    last = F.greatest(F.size("__words") - 1, F.lit(0))
    pair = lambda x, y: F.struct(F.concat_ws(" ", x["w"], y["w"]).alias("two"), x["i"].alias("a"), y["i"].alias("b"))
    rows = rows.withColumn("__pairs", F.zip_with(F.slice("__words", 1, last), F.slice("__words", 2, last), pair))
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size("__pairs"), F.lit(1)), F.lit(SPAN // 2)), lambda at: F.slice("__pairs", at, SPAN))
    rows = rows.withColumn("__windows", F.filter(windows, lambda w: _marked(w["two"])))

    def notice(t: Column, window: Column) -> Column:
        hits = F.filter(window, lambda p: F.array_contains(t["own"], p["two"]))
        at = lambda pairs, i: F.filter(pairs, lambda p: (p["a"] == i) & (p["b"] == i))
        seen = F.array_distinct(F.concat(hits["a"], hits["b"]))
        alone = F.exists(seen, lambda i: (F.size(F.array_distinct(at(hits, i)["two"])) >= CONFIRMED * F.size(t["own"])) & _any_cue(F.get("lines", i)))
        touched = lambda pairs, i: F.size(F.filter(pairs, lambda p: (p["a"] == i) | (p["b"] == i)))
        most = F.filter(seen, lambda i: 2 * touched(hits, i) >= touched(window, i))
        lines = F.when(alone, F.array().cast("array<int>")).when(F.size(most) > 0, most).otherwise(seen)
        return F.struct(t["family"].alias("family"), _share(t["own"], window["two"]).alias("share"), lines.alias("lines"))

    rows = rows.withColumn("notices", F.filter(F.flatten(F.transform("__windows", lambda w: F.transform(_found(w["two"]), lambda t: notice(t, w)))), lambda n: F.size(n["lines"]) > 0))
    return rows.drop("__words", "__pairs", "__windows")


def paragraphs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, line, part, sure, share) of every line that holds a cue, and of every notice over several lines.

    ``part`` tells that a line belongs to such a notice; ``sure`` and ``share`` are the family and similarity of a notice.
    """
    text = F.col(text_col).cast("string")
    rows = with_notices(docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).filter(_any_cue(F.col("text"), r"[^\p{L}\p{N}]+")))
    rows = rows.withColumn("__parts", F.array_distinct(F.flatten(F.col("notices")["lines"])))
    numbered = F.filter(F.transform("lines", lambda line, i: F.struct(i.alias("paragraph"), line.alias("line"))), lambda x: _any_cue(x["line"]))
    nothing = [F.lit(None).cast("string").alias("sure"), F.lit(None).cast("double").alias("share")]
    own = F.transform(numbered, lambda x: F.struct(x["paragraph"].alias("paragraph"), x["line"].alias("line"), F.array_contains("__parts", x["paragraph"]).alias("part"), *nothing))
    spans = F.transform("notices", lambda n: F.struct(n["family"].alias("family"), F.array_min(n["lines"]).alias("first"), F.array_max(n["lines"]).alias("last"), n["share"].alias("share")))
    rows = rows.withColumn("__spans", F.array_sort(spans))
    # Two windows may hold one notice: of those of a family that overlap the first stays.
    before = lambda i: F.get("__spans", i - 1)
    first = lambda n, i: (i == 0) | (before(i)["family"] != n["family"]) | (before(i)["last"] < n["first"])
    rows = rows.withColumn("__spans", F.filter("__spans", first))
    joined = lambda n: F.array_join(F.slice("lines", n["first"] + 1, n["last"] - n["first"] + 1), "\n")
    over = F.transform("__spans", lambda n: F.struct(n["first"].alias("paragraph"), joined(n).alias("line"), F.lit(False).alias("part"), n["family"].alias("sure"), n["share"].alias("share")))
    return rows.select("doc_id", F.explode(F.concat(own, over)).alias("p")).select("doc_id", "p.*")


def _any_cue(text: Column, between: str | None = None) -> Column:
    """``between`` is a pattern of what may stand between two words of a cue, if not a space."""
    low, found = F.lower(text), F.lit(False)
    for cue in CUES:
        found = found | (low.rlike(cue.replace(" ", between)) if between and " " in cue else low.contains(cue))
    return found


def _sentences(spark: SparkSession) -> DataFrame:
    rows = [(family, s) for family, sentences in TEMPLATES.items() for s in sentences] + [("unknown", s) for s in UNKNOWN]
    listed = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(s).alias("line")) for f, s in rows))
    return spark.range(1).select(F.explode(listed).alias("s")).select("s.*")


def _training(docs: DataFrame, text_col: str) -> DataFrame:
    """(family, line, v): variants of the sentences, and lines of the corpus without a cue as unknown."""
    spark = docs.sparkSession
    varied = _sentences(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    kept_words = F.filter(F.split("line", " "), lambda w, i: F.pmod(F.xxhash64(w, i, F.col("v")), F.lit(2 * VARIANTS)) >= F.col("v"))
    varied = varied.select("family", F.array_join(kept_words, " ").alias("line"), "v")
    # A bounded sample of a few documents' lines.
    few = docs.select(F.col(text_col).cast("string").alias("line")).filter("line is not null").orderBy(F.xxhash64("line")).limit(SAMPLE // 10)
    lines = few.select(F.explode(F.split("line", "\n", -1)).alias("line")).filter(~_any_cue(F.col("line"))).limit(SAMPLE)
    return varied.unionByName(lines.select(F.lit("unknown").alias("family"), "line", F.pmod(F.xxhash64("line"), F.lit(VARIANTS)).cast("int").alias("v")))


@dataclass
class Model:
    families: list[str]
    terms: CountVectorizerModel
    classes: LogisticRegressionModel
    calibration: IsotonicRegressionModel


def fit(docs: DataFrame, *, text_col: str = "text") -> Model:
    families = ["unknown", *TEMPLATES]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    rows = common.kept(with_grams(_training(docs, text_col), "line").withColumn("label", number.cast("double")), "notices")
    terms = CountVectorizer(inputCol="terms", outputCol="vector", binary=True, minDF=1.0, vocabSize=1 << 14).fit(rows.filter("family <> 'unknown' and v = 0"))
    vectors = terms.transform(rows)
    learner = LogisticRegression(featuresCol="vector", labelCol="label", family="multinomial", regParam=1e-3, elasticNetParam=0.3, maxIter=80)
    classes = learner.fit(vectors.filter("v % 4 <> 3"))
    rest = classes.transform(vectors.filter("v % 4 = 3")).select((1 - vector_to_array("probability")[0]).alias("raw"), F.when(F.col("label") > 0, 1.0).otherwise(0.0).alias("known"))
    return Model(families, terms, classes, IsotonicRegression(featuresCol="raw", labelCol="known").fit(rest))


def similarity(family: Column, two: Column) -> Column:
    """Largest share of the bigrams of a template sentence of ``family`` that ``two`` holds."""
    out = F.lit(0.0)
    for name, sentences in TEMPLATES.items():
        shares = []
        for sentence in sentences:
            own = F.array_distinct(grams(words_in(F.lit(sentence)), 2))
            shares.append(F.size(F.array_intersect(own, two)) / F.size(own))
        out = F.when(family == name, F.greatest(*shares)).otherwise(out)
    return out


def scan(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, family, predicted, probability, similarity, confirmed, line), a row per finding."""
    rows = with_grams(paragraphs(docs, id_col=id_col, text_col=text_col), "line")
    scored = model.classes.transform(model.terms.transform(rows)).drop("vector", "rawPrediction", "terms", "prediction")
    shares = vector_to_array("probability")
    known = F.slice(shares, 2, len(model.families) - 1)
    names = F.array(*map(F.lit, model.families[1:]))
    best = names[(F.array_position(known, F.array_max(known)) - 1).cast("int")]
    scored = scored.select("doc_id", "paragraph", "line", "part", "sure", "share", "two", (1 - shares[0]).alias("raw"), best.alias("predicted"))
    scored = model.calibration.transform(scored).withColumnRenamed("prediction", "chance").drop("raw")
    alone = (similarity(F.col("predicted"), F.col("two")) >= CONFIRMED) & (F.col("chance") >= KNOWN)
    scored = scored.withColumn("__alone", F.when(alone, F.array("predicted")).otherwise(F.array().cast("array<string>")))
    listed = F.when(_marked(F.col("two")), _found(F.col("two"))["family"]).otherwise(F.array().cast("array<string>"))
    scored = scored.withColumn("__families", F.when(F.col("sure").isNotNull(), F.array("sure")).otherwise(F.array_union("__alone", listed)))
    nothing = F.when(F.col("part"), F.array().cast("array<string>")).otherwise(F.array(F.lit("unknown")))
    scored = scored.withColumn("family", F.explode(F.when(F.size("__families") > 0, F.col("__families")).otherwise(nothing)))
    confirmed = F.col("family") != "unknown"
    share = F.coalesce("share", similarity(F.when(confirmed, F.col("family")).otherwise(F.col("predicted")), F.col("two")))
    return scored.select(
        "doc_id", "paragraph", "family", "predicted", F.round("chance", 6).alias("probability"), F.round(share, 6).alias("similarity"), confirmed.alias("confirmed"), "line",
    )
