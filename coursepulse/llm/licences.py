"""Licence scan: a trained paragraph classifier, in DataFrame and Spark ML operations only.

A paragraph ends at a line without letters and digits, so comment marks do not join paragraphs. Notices are wrapped anywhere and
follow each other on one line: every piece of a paragraph, that is a line or a sentence of it, is judged, and every run of neighbouring pieces,
joined by spaces, whose inner pieces hold no more
words than the longest notice. A run's features are the words, and the runs of two and three words, that hold a licence
word (``CUES``). A
sparse multinomial logistic regression over these n-grams, trained on the notices below, gives a probability for each
licence family and for "unknown", which is trained on prose and on notices of licences that are not listed. The level below which a run is
unknown is calibrated on lines set aside from the training: notices with words taken out, of which a documented quantile may fall below
it, and notices of other unlisted licences, which should fall below it as far as nine of ten of the right ones stay above. A prediction is
confirmed by comparing the run with the family's notices: enough of some notice's word pairs must stand in it, and a pair weighs the
less the more families use it, so what all notices share confirms none. Of runs that share a piece the best confirmed one counts, if they are of one
family or are confirmed by the same word pairs; so a notice counts once. A run without a licence word has no feature at all and
is unknown by construction, so it is left out before anything is computed for it.

Defined cases: null and empty texts have no paragraph; several notices in a document give several findings, repeated
notices of the same wording and wrapping are one finding with their number; an empty table gives an empty result; a null id is kept as it is; extra
columns are ignored by ``scan``. Long texts are read whole.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import forget, stage

UNKNOWN = "unknown"

# Notices by licence family, as their publishers word them, and lines that are no notice.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "This software is distributed under the terms of the MIT license.",
        "MIT License",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Released under the BSD license.",
        "Use of this source code is governed by a BSD-style license.",
        "BSD 3-Clause License",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPL, version 2 or later.",
        "Released under the GNU GPL v3 license.",
        "GNU General Public License Version 3, 29 June 2007",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "GNU Affero General Public License Version 3, 19 November 2007",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software under the terms of the GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "ISC License",
    ),
    "Zlib": (
        "Licensed under the zlib License.",
        "SPDX-License-Identifier: Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable",
        "zlib License",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Released under the Creative Commons Attribution-ShareAlike license.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "Public-Domain": (
        "This work is in the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright (c) 2020 Example Company. All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ),
    UNKNOWN: (
        "The driver showed a valid license to the officer at the gate.",
        "Read the terms before you sign, the version on paper is the public one.",
        "She reserved all seats for the general meeting and copied the source of the river on a map.",
        "It is a common attribution of the painting, and the work is free to see.",
        "The software of the machine has a new version.",
        "He has the right to use the domain for public speaking.",
        "A copy of the binary file is under the table.",
        "The creative work of the apache people and the free press.",
        "A fishing license costs ten dollars and the permission of the owner is required.",
        "The copyright office moved to a new building.",
        "",
    ),
}

# Notices of licences that are not listed: what the unknown class learns besides prose, and what it is calibrated on.
UNLISTED = ("SPDX-License-Identifier: {}", "Licensed under the {} License.", "Licensed under the {} Public License, version 3.",
            "Released under the {} license.", "This software is distributed under the terms of the {} license.",
            "This project is released under the {} 2.0 license.", "{} License", "Licensed under {} 4.0.", "{} License Version 2.0, June 2010")
UNLISTED_LEARNED = ("Artistic", "Boost Software", "WTFPL", "Example Company", "own", "OFL-1.1", "Open Database")
UNLISTED_SET_ASIDE = ("Beerware", "Sleepycat", "PostgreSQL", "Ruby", "Acme", "NCSA", "house")

# The words that make a run of words a feature.
CUES = ("license", "licensed", "licenses", "licence", "licenced", "apache", "identifier", "bsd", "gnu", "gpl", "lgpl", "mozilla", "mpl", "cc",
        "cc0", "commons", "creative", "copyright", "copyrighted", "rights", "reserved", "permission", "granted", "redistribution",
        "redistribute", "unencumbered", "domain", "proprietary", "confidential", "prohibited", "spdx", "sharealike", "noncommercial",
        "attribution", "waived", "affero", "agpl", "eclipse", "epl", "isc", "zlib", "warranty", "liable")

#: Where a paragraph is cut into pieces: at line ends, and after the end of a sentence.
PIECE = r"\n|(?<=[.;])[ \t]+(?=\p{Lu})"
BLOCK = 256  # pieces whose confirmed runs are compared with each other


class Model(NamedTuple):
    """``classifier``: n-grams to probabilities; ``families``: names by class number; ``least``: the calibrated level;
    ``overlap``: the share of a notice's word pairs that confirms it."""

    classifier: PipelineModel
    families: list[str]
    least: float
    overlap: float


def tokens(line: Column) -> Column:
    """Lower-case words, numbers with their points, in order."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"(\d+(?:\.\d+)*|[\p{L}]+\d*)"))


def _words(notice: str) -> list[str]:
    """``tokens`` of a notice, which is ASCII."""
    return re.findall(r"\d+(?:\.\d+)*|[a-z]+\d*", notice.lower())


def _grams(words: Column, n: int) -> Column:
    """All runs of ``n`` words, as texts."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(n))))).otherwise(
            F.array().cast("array<string>"))


def ngrams(words: Column) -> Column:
    """The runs of one, two and three words that hold a cue."""
    cues = F.array(*map(F.lit, CUES))
    longer = F.concat(_grams(words, 2), _grams(words, 3))
    return F.concat(F.filter(words, lambda w: F.array_contains(cues, w)),
                    F.filter(longer, lambda gram: F.arrays_overlap(F.split(gram, " "), cues)))


def _lines(spark: SparkSession, lines: list[tuple[str, str]]) -> DataFrame:
    """family, class number, line, and its words."""
    number = {family: float(i) for i, family in enumerate(NOTICES)}
    rows = [F.struct(F.lit(family).alias("family"), F.lit(number[family]).alias("label"), F.lit(line).alias("line")) for family, line in lines]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("words", tokens(F.col("line")))


def notices(spark: SparkSession) -> DataFrame:
    """The listed notices, and the lines of the unknown class."""
    unlisted = [(UNKNOWN, line.format(name)) for line in UNLISTED for name in UNLISTED_LEARNED]
    return _lines(spark, [(family, line) for family, lines in NOTICES.items() for line in lines] + unlisted)


def fit(spark: SparkSession, quantile: float = 0.02, overlap: float = 0.6, vocabulary: int = 4000) -> Model:
    """Train on the notices and on copies with every third or every fourth word left out; calibrate on copies with
    every fifth word left out and on unlisted notices set aside. ``vocabulary``: the most n-grams that become features."""
    given = notices(spark)

    def without(step: int) -> DataFrame:
        holes = given.withColumn("hole", F.explode(F.sequence(F.lit(0), F.lit(step - 1))))
        return holes.withColumn("words", F.filter("words", lambda w, i: (i % step) != F.col("hole"))).drop("hole")

    train = given.unionByName(without(3)).unionByName(without(4)).withColumn("ngrams", ngrams(F.col("words"))).coalesce(1)
    counter = CountVectorizer(inputCol="ngrams", outputCol="features", vocabSize=vocabulary, binary=True).fit(train)
    regression = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60).fit(counter.transform(train))
    classifier = PipelineModel([counter, regression])
    checked = classifier.transform(without(5).withColumn("ngrams", ngrams(F.col("words")))).filter(
        (F.col("family") != UNKNOWN) & (F.size("ngrams") > 0) & (F.col("label") == F.col("prediction")))
    right = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    low, tenth = checked.agg(F.percentile(right, F.lit(quantile)), F.percentile(right, F.lit(0.1))).first()
    strange = _lines(spark, [(UNKNOWN, line.format(name)) for line in UNLISTED for name in UNLISTED_SET_ASIDE])
    listed = F.slice(vector_to_array("probability"), 1, len(NOTICES) - 1)  # the unknown class is the last
    high = classifier.transform(strange.withColumn("ngrams", ngrams(F.col("words")))).agg(
        F.percentile(F.array_max(listed), F.lit(1 - quantile))).first()[0]
    return Model(classifier, list(NOTICES), max(low, min(high, tenth)), overlap)


def _pairs(words: list[str]) -> list[str]:
    return [f"{x} {y}" for x, y in zip(words, words[1:])]


def _weighed() -> list[tuple[str, list[str], dict[str, float]]]:
    """Family, words and weighed word pairs of every listed notice. A pair weighs one by the families whose notices hold it."""
    held: dict[str, set[str]] = {}
    for family, lines in NOTICES.items():
        for line in lines:
            for pair in _pairs(_words(line)):
                held.setdefault(pair, set()).add(family)
    return [(family, words, {pair: 1 / len(held[pair]) for pair in _pairs(words)})
            for family, lines in NOTICES.items() if family != UNKNOWN for words in map(_words, lines)]


def _missable(weights: dict[str, float], overlap: float) -> int:
    """How many of the pairs may be missing at most while the others have ``overlap`` of the weight."""
    spare, count = (1 - overlap) * sum(weights.values()) + 1e-9, 0
    for weight in sorted(weights.values()):
        spare -= weight
        if spare < 0:
            break
        count += 1
    return count


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", overlap: float = 0.0) -> DataFrame:
    """row, id, paragraph, start, end, line: the runs of neighbouring pieces that hold a cue, without those whose words rule out that
    ``overlap`` of the weight of a notice's word pairs stands there. ``row`` tells rows of one id apart."""
    cue = rf"\b({'|'.join(CUES)})\b"
    wanted = _weighed()
    longest = max(len(words) for _, words, _ in wanted)
    # A word that is missing takes a pair with it, a different one each; so at most as many of a notice's words as pairs may be missing.
    needs = F.array(*[F.struct(F.array(*map(F.lit, sorted(set(words)))).alias("words"),
                               F.lit(len(set(words)) - _missable(weights, overlap)).alias("least")) for _, words, weights in wanted])
    known = F.array(*map(F.lit, sorted({word for _, words, _ in wanted for word in words})))
    # One look at the whole text first: most documents hold no cue.
    some = docs.select(F.col(id_col).alias("id"), F.col(text).alias("body")).filter(F.lower("body").rlike(cue)).select(
        F.monotonically_increasing_id().alias("row"), "id", F.regexp_replace("body", r"\r\n?", "\n").alias("body"))
    # A line without letters and digits becomes an empty one.
    parts = F.split(F.regexp_replace("body", r"\n[^\p{L}\d\n]*+(?=\n)", "\n"), r"\n{2,}")

    def lined(part: Column) -> Column:
        lines = F.split(part, PIECE)
        return F.struct(lines.alias("lines"), F.transform(lines, tokens).alias("words"))

    split = some.select("row", "id", F.posexplode(F.transform(F.filter(parts, lambda x: F.lower(x).rlike(cue)), lined)).alias("paragraph", "part"))
    # inline() keeps what is made here from being made again for every run.
    read = split.select("row", "id", "paragraph", F.inline(F.array(F.struct(
        F.col("part.lines").alias("lines"), F.transform("part.words", F.size).alias("sizes"),
        F.transform("part.words", lambda words: F.array_intersect(words, known)).alias("hits"),
        F.transform("part.words", lambda words: F.arrays_overlap(words, F.array(*map(F.lit, CUES)))).alias("cued")))))
    lines, sizes, hits, cued = map(F.col, ("lines", "sizes", "hits", "cued"))

    def possible(start: Column, end: Column) -> Column:
        # In an array of one, so that the words of the run are put together once.
        held = F.array(F.array_distinct(F.flatten(F.slice(hits, start, end - start + 1))))
        return F.exists(held, lambda h: (F.size(h) > 1) & F.exists(needs, lambda n: (n["least"] <= F.size(h)) & (
            F.size(F.array_intersect(n["words"], h)) >= n["least"])))

    def runs(start: Column) -> Column:
        more = F.aggregate(
            F.slice(sizes, start + 1, F.lit(longest + 1)), F.struct(F.lit(0).alias("inner"), F.lit(0).alias("lines")),
            lambda s, n: F.when(s["inner"] <= longest, F.struct((s["inner"] + n).alias("inner"), (s["lines"] + 1).alias("lines"))).otherwise(s),
            lambda s: s["lines"])
        ends = F.filter(F.transform(F.sequence(F.lit(0), more), lambda k: start + k),
                        lambda end: F.exists(F.slice(cued, start, end - start + 1), lambda c: c) & possible(start, end))
        return F.transform(ends, lambda end: F.struct(
            start.alias("start"), end.alias("end"), F.array_join(F.slice(lines, start, end - start + 1), " ").alias("line")))

    return read.select("row", "id", "paragraph", F.explode(F.transform(F.sequence(F.lit(1), F.size(lines)), runs)).alias("runs")).select(
        "row", "id", "paragraph", F.inline("runs"))


def _confirmation(words: Column, number: Column) -> Column:
    """The largest share of the weight of a notice's word pairs that stands among ``words``, over the notices of class ``number``, and those pairs."""
    place = {family: i for i, family in enumerate(NOTICES)}
    given = F.array(*[F.struct(F.lit(place[family]).alias("number"), F.lit(sum(weights.values())).alias("whole"),
                               F.array(*[F.struct(F.lit(pair).alias("pair"), F.lit(weight).alias("weight")) for pair, weight in weights.items()]).alias("pairs"))
                      for family, _, weights in _weighed()])
    own = F.filter(given, lambda notice: notice["number"] == number)

    def share(notice: Column, held: Column) -> Column:
        common = F.filter(notice["pairs"], lambda p: F.array_contains(held, p["pair"]))
        weight = F.aggregate(common, F.lit(0.0), lambda total, p: total + p["weight"])
        return F.struct((weight / notice["whole"]).alias("overlap"), F.transform(common, lambda p: p["pair"]).alias("pairs"))

    # In an array of one, so that the pairs of the run are made once.
    return F.transform(F.array(_grams(words, 2)), lambda held: F.array_max(F.transform(own, lambda notice: share(notice, held))))[0]


def _best(found: DataFrame, shift: int) -> DataFrame:
    """Without runs that share a line with a better one of their family, or with a better one confirmed by the same pairs.
    Lines are taken ``BLOCK`` at a time."""
    columns = ["start", "end", "family", "probability", "overlap", "pairs", "line"]
    ranked = F.sort_array(F.collect_list(F.struct(
        (-F.col("overlap")).alias("r1"), (F.col("end") - F.col("start")).alias("r2"), (-F.col("probability")).alias("r3"), *columns)))

    def take(kept: Column, run: Column) -> Column:
        beaten = F.exists(kept, lambda x: (x["start"] <= run["end"]) & (run["start"] <= x["end"])
                          & ((x["family"] == run["family"]) | F.arrays_overlap(x["pairs"], run["pairs"])))
        return F.when(beaten, kept).otherwise(F.array_append(kept, run))

    kind = ("array<struct<r1:double,r2:int,r3:double,start:int,end:int,family:string,probability:double,overlap:double,"
            "pairs:array<string>,line:string>>")
    grouped = found.groupBy("row", "id", "paragraph", F.floor((F.col("start") + shift) / BLOCK).alias("block")).agg(ranked.cast(kind).alias("ranked"))
    return grouped.select("row", "id", "paragraph", F.inline(F.aggregate("ranked", F.array().cast(kind), take))).drop("r1", "r2", "r3")


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and confirmed notice: id, family, probability, overlap, line, n."""
    # Each step is written before the next: merged into one projection, the words of a run would be made again for every notice.
    runs = stage(paragraphs(docs, id_col, text, model.overlap), "runs")
    words = stage(runs.withColumn("words", tokens(F.col("line"))), "words")
    read = stage(words.withColumn("ngrams", ngrams(F.col("words"))).filter(F.size("ngrams") > 0), "ngrams")
    number = F.col("prediction").cast("int")
    judged = model.classifier.transform(read).select(
        "row", "id", "paragraph", "start", "end", "line", "words", number.alias("number"),
        F.array_max(vector_to_array("probability")).alias("probability"))
    family = F.element_at(F.array(*map(F.lit, model.families)), F.col("number") + 1)
    likely = stage(judged, "judged").withColumn("family", family).filter(
        (F.col("family") != UNKNOWN) & (F.col("probability") >= model.least))
    confirmed = stage(likely.withColumn("confirmed", _confirmation(F.col("words"), F.col("number"))), "confirmed")
    forget(runs, words, read)
    confirmed = confirmed.filter(F.col("confirmed.overlap") >= model.overlap).select(
        "row", "id", "paragraph", "start", "end", "family", "probability", "confirmed.overlap", "confirmed.pairs", "line")
    # Once more with the blocks shifted, for runs on two sides of a block's edge.
    return (
        _best(_best(confirmed, 0), BLOCK // 2)
        .groupBy("row", "id", "family", "line")
        .agg(F.max("probability").alias("probability"), F.max("overlap").alias("overlap"), F.count("*").cast("int").alias("n"))
        .select("id", "family", "probability", "overlap", "line", "n")
    )
