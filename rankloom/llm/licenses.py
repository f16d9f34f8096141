"""License scan: a trained paragraph classifier, confirmed by template comparison.

A paragraph is a line of the text.  Its words (lowered runs of letters and digits, inner ``. - '``
kept) and word pairs are hashed into a sparse vector; a multinomial logistic regression names a license
family or the class ``unknown``.  It is trained on spans of the license templates below and,
as ``unknown``, on a sample of at most about ``UNKNOWN_SAMPLE`` corpus paragraphs that share no three words in
a row with a template.  A share of the training rows is held out: the temperature that gives them the
highest likelihood calibrates the probabilities, and a family is named only at ``LEAST`` or more.

A named family is confirmed when the paragraph and one of its templates have ``OVERLAP`` of the smaller
one's word triples in common; else the paragraph counts as unknown.

A notice that shares its line with other text would be outvoted, so windows of the line are classified and
confirmed too.  They lie where the line has triples of templates, as no other window could be confirmed: each
run of words whose triples are all some template's, and each chain of such runs with at most ``BETWEEN`` other words
between two (a notice with edits).  Runs may be short, so a window counts as ``LEAST_WINDOW`` words at
least when it is confirmed: a few words in common with a long template are no notice.  A line has every family that it
or one of its windows is confirmed for; but a window within another (or the line) that is confirmed
for a family has to share more triples with its own family than with that one.

Only DataFrame functions and Spark's own ML classes are used.  Edge cases: a null text is one empty paragraph;
paragraphs of fewer than three words have no triples and are never confirmed.  An empty table gives no
rows (and trains on the templates alone).  Every input row gives one output row, also for repeated or
null ids; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, whole_text

FEATURES = 1 << 14
UNKNOWN_SAMPLE = 4000
LEAST, OVERLAP = 0.5, 0.6
WINDOWS = (8, 12, 16)  # words of the windows that families are trained on
LEAST_WINDOW, BETWEEN = min(WINDOWS), 2
WORD = r"[\p{L}\p{N}]+(?:[.\-'][\p{L}\p{N}]+)*"
UNKNOWN = "unknown"

# Notices and opening paragraphs of public licenses.
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "This work is in the public domain.",
    ],
}
FAMILIES = [UNKNOWN, *TEMPLATES]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _pairs(of: Column) -> Column:
    """Neighbouring words; linear also in long paragraphs."""
    after = F.slice(of, F.lit(2), F.greatest(F.size(of) - 1, F.lit(0)))
    return F.array_compact(F.zip_with(of, after, lambda a, b: F.concat(a, F.lit(" "), b)))


def _triples_of(of: Column) -> Column:
    """All runs of three words; linear as ``_pairs``."""
    after = F.slice(of, F.lit(3), F.greatest(F.size(of) - 2, F.lit(0)))
    return F.array_compact(F.zip_with(_pairs(of), after, lambda a, b: F.concat(a, F.lit(" "), b)))


def grams(of: Column) -> Column:
    return F.concat(of, _pairs(of))


def _vectors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``words`` gets ``features``."""
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES).transform(rows.withColumn("grams", grams(F.col("words"))))


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.\-'][^\W_]+)*", text.lower())


def _triples(text: str) -> list[str]:
    found = _template_words(text)
    return sorted({" ".join(found[i:i + 3]) for i in range(len(found) - 2)})


def _every_triple() -> list[str]:
    return sorted({t for texts in TEMPLATES.values() for x in texts for t in _triples(x)})


def _all_triples() -> Column:
    return F.array(*(F.lit(t) for t in _every_triple()))


def _windows(of: Column) -> Column:
    """The windows of a line: its chains of runs, ``\\t`` between runs, spaces between words."""
    placed = F.transform(_triples_of(of), lambda t, i: F.struct(i.alias("at"), t.alias("triple")))
    shared = F.filter(placed, lambda x: x["triple"].isin(_every_triple()))
    before = F.concat(F.array(F.lit(None).cast("int")), F.transform(shared, lambda x: x["at"]))

    def piece(x: Column, last: Column) -> Column:
        # From a run's last triple to the next run it is 3 words, and those between. (Runs may also share a word.)
        step = x["at"] - last
        return (F.when(x.isNull(), "").when(step == 1, F.concat(F.lit(" "), F.substring_index(x["triple"], " ", -1)))
                .when(step <= BETWEEN + 3, F.concat(F.lit("\t"), x["triple"])).otherwise(F.concat(F.lit("\n"), x["triple"])))

    marked = F.array_join(F.zip_with(shared, before, piece), "")
    return F.when(F.size(shared) > 0, F.split(F.substring(marked, 2, (1 << 31) - 1), "\n")).otherwise(F.array().cast("array<string>"))


def units(lines: DataFrame) -> DataFrame:
    """``lines`` with ``chain`` and ``run``: the lines (both null), their chains (``run`` null) and the runs of chains of several."""
    def unit(chain: Column, run: Column, of: Column) -> Column:
        return F.struct(chain.cast("int").alias("chain"), run.cast("int").alias("run"), of.alias("words"))

    none = F.lit(None)
    chains = F.transform("windows", lambda x, n: unit(n, none, F.split(x, "[ \t]")))
    several = F.filter(F.transform("windows", lambda x, n: F.struct(n.alias("n"), F.split(x, "\t").alias("runs"))), lambda x: F.size(x["runs"]) > 1)
    runs = F.flatten(F.transform(several, lambda x: F.transform(x["runs"], lambda run, m: unit(x["n"], m, F.split(run, " ")))))
    every = F.concat(F.array(unit(none, none, F.col("words"))), chains, runs)
    others = [c for c in lines.columns if c != "words"]
    # A chain that is the line would only be judged twice.
    return (lines.withColumn("windows", _windows(F.col("words")))
            .withColumn("windows", F.when(F.get("windows", F.lit(0)) == F.array_join("words", " "), F.array().cast("array<string>")).otherwise(F.col("windows")))
            .select(*others, F.explode(F.when(F.size("windows") > 0, every).otherwise(F.array(unit(none, none, F.col("words"))))).alias("unit"))
            .select(*others, "unit.*"))


def spans() -> list[tuple[int, list[str], bool]]:
    """Training rows of the families: (label, words, held out): whole templates, and windows of them."""
    rows = []
    for label, family in enumerate(FAMILIES[1:], 1):
        for text in TEMPLATES[family]:
            found = _template_words(text)
            rows += [(label, found, False)] * 8 + [(label, found, True)] * 2
            for size in WINDOWS:
                for n, at in enumerate(range(0, max(0, len(found) - size + 1), 3)):
                    rows.append((label, found[at:at + size], n % 4 == 3))
    return rows


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, doc_id, paragraph, words)``: each line of each document."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    split = numbered.select("row", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "line"))
    return split.select("row", "doc_id", "paragraph", words(F.col("line")).alias("words"))


def _unlike(docs: DataFrame, sample: int, text: str) -> DataFrame:
    """``words`` of sampled paragraphs without a triple of any template."""
    lines = docs.select(F.explode(F.split(whole_text(text), "\n", -1)).alias("line")).where("line != ''")
    total = lines.count()
    draw = F.pmod(F.xxhash64("line"), F.lit(1 << 32))
    drawn = lines.where(draw < int(min(1.0, sample / max(1, total)) * (1 << 32))).distinct()  # a line that repeats is drawn once
    drawn = drawn.orderBy(F.xxhash64("line"), "line").limit(sample + sample // 4).select(words(F.col("line")).alias("words"))
    return drawn.where(~F.arrays_overlap(_triples_of(F.col("words")), _all_triples()))


def train(docs: DataFrame, sample: int = UNKNOWN_SAMPLE, key: str = "doc_id", text: str = "text") -> tuple[LogisticRegressionModel, float]:
    """The classifier and its temperature."""
    spark = docs.sparkSession
    families = spark.createDataFrame(spans(), "label int, words array<string>, held boolean")
    unlike = _unlike(docs, sample, text)
    unknown = unlike.select(F.lit(0).alias("label"), "words", (F.pmod(F.xxhash64("words"), F.lit(4)) == 0).alias("held"))
    # The class must exist in an empty corpus too.
    nothing = spark.createDataFrame([(0, ["none"], False), (0, ["none"], True)], families.schema)
    columns = _vectors(families.unionByName(unknown).unionByName(nothing)).select("label", "features", "held")
    with Scratch(spark) as files:
        # A few thousand rows whatever the corpus: few partitions, or every step would gather the gradient of each.
        rows = files(columns).coalesce(4)
        model = LogisticRegression(maxIter=60, regParam=1e-4, family="multinomial").fit(rows.where("not held"))
        return model, _temperature(model.transform(rows.where("held")))


def _temperature(held: DataFrame) -> float:
    """The temperature that gives the held-out rows the least mean loss."""
    held = held.select("label", vector_to_array("rawPrediction").alias("raw"))

    def loss(t: float) -> Column:
        scaled = F.transform("raw", lambda x: x / t)
        top = F.array_max(scaled)
        total = F.aggregate(scaled, F.lit(0.0), lambda s, x: s + F.exp(x - top))
        return F.avg(top + F.log(total) - F.element_at(scaled, F.col("label") + 1))

    grid = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0]
    losses = held.agg(*(loss(t).alias(str(i)) for i, t in enumerate(grid))).first()
    return min(zip(losses, grid))[1]


def _overlaps(of: Column, least: Column) -> Column:
    """Per family the largest share of the distinct triples ``of`` in common with one of its templates."""
    size = F.greatest(F.size(of), least)

    def share(text: str) -> Column:
        theirs = _triples(text)
        common = F.size(F.array_intersect(of, F.array(*(F.lit(t) for t in theirs))))
        return F.when(F.size(of) > 0, common / F.least(size, F.lit(len(theirs)))).otherwise(0.0)

    return F.array(*(F.array_max(F.array(*(share(x) for x in TEMPLATES[name]))) for name in FAMILIES[1:]))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, doc_id, paragraph, chain, run, family, probability, overlap, overlaps)``: every paragraph and window; family null
    where unknown, ``overlaps`` by family where one is named."""
    model, temperature = train(docs, key=key, text=text)
    scored = model.transform(_vectors(units(paragraphs(docs, key, text)))).select(
        "row", "doc_id", "paragraph", "chain", "run", "words", F.col("prediction").cast("int").alias("label"), vector_to_array("rawPrediction").alias("raw"))
    top = F.array_max("raw")
    probability = 1 / F.aggregate("raw", F.lit(0.0), lambda s, x: s + F.exp((x - top) / temperature))
    named = (F.col("label") > 0) & (F.col("probability") >= LEAST)
    least = F.when(F.col("chain").isNull(), 0).otherwise(LEAST_WINDOW - 2)
    judged = (scored.withColumn("probability", F.when(F.col("label") > 0, probability))
              .withColumn("triples", F.when(named, F.array_distinct(_triples_of(F.col("words")))))
              .withColumn("overlaps", F.when(F.col("triples").isNotNull(), _overlaps(F.col("triples"), least)))
              .withColumn("overlap", F.get("overlaps", F.col("label") - 1)))
    family = F.when(F.col("overlap") >= OVERLAP, F.element_at(F.array(*(F.lit(f) for f in FAMILIES)), F.col("label") + 1))
    return judged.select("row", "doc_id", "paragraph", "chain", "run", family.alias("family"), "probability", "overlap", "overlaps")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, doc_id, paragraph, family, probability, overlap)``: every paragraph as a whole; family null where unknown."""
    return judge(docs, key, text).where("chain is null").select("row", "doc_id", "paragraph", "family", "probability", "overlap")


def _counted(found: Column) -> Column:
    """Of a document's confirmed lines and windows those that count, as (paragraph, family), sorted, without repeats."""
    def around(x: Column, y: Column) -> Column:
        """Whether y holds x: the line holds its windows, a chain its runs."""
        return (y["paragraph"] == x["paragraph"]) & x["chain"].isNotNull() & (
            y["chain"].isNull() | ((y["chain"] == x["chain"]) & y["run"].isNull() & x["run"].isNotNull()))

    names = F.array(*(F.lit(f) for f in FAMILIES[1:]))

    def share(x: Column, family: Column) -> Column:
        return F.get(x["overlaps"], (F.array_position(names, family) - 1).cast("int"))

    def explained(x: Column) -> Column:
        return F.exists(found, lambda y: around(x, y) & (x["family"] != y["family"]) & (share(x, x["family"]) <= share(x, y["family"])))

    counts = F.filter(found, lambda x: F.when(x["chain"].isNull(), True).otherwise(~explained(x)))
    return F.array_sort(F.array_distinct(F.transform(counts, lambda x: F.struct(x["paragraph"].alias("paragraph"), x["family"].alias("family")))))


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_licenses (hits), families (distinct, sorted, comma-joined),
    hits (``paragraph:family`` in order, comma-joined; a line may have several)."""
    found = F.when(F.col("family").isNotNull(), F.struct("paragraph", "chain", "run", "family", "overlaps"))
    by_doc = judge(docs).groupBy("row", "doc_id").agg(F.count_if(F.col("chain").isNull()).alias("n_paragraphs"), F.collect_list(found).alias("found"))
    by_doc = by_doc.withColumn("found", _counted(F.col("found")))
    hits = F.transform("found", lambda x: F.concat_ws(":", x["paragraph"], x["family"]))
    families = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["family"])))
    return by_doc.select("doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_licenses"),
                         F.array_join(families, ",").alias("families"), F.array_join(hits, ",").alias("hits"))
