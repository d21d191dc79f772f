"""Licence scans, in DataFrame expressions and Spark ML only.

Every paragraph of a text (lines up to a blank line, so that wrapped notices
are one piece) is read in passages of ``passage`` words, one beginning every ``step`` words.
A passage is classified by a multinomial logistic regression over the notices'
words and word pairs.  The classes are the licence families, ``unknown``
(speaks of a licence, but of none of these) and ``none``.  The model is trained
on pieces of the families' notices and on a bounded sample of the corpus's own
passages as background.  Words and pairs that the corpus uses freely, counted
over all its passages, are no features; a rare pair is one whatever its words.

Every family counts that the passage (a) is likelier to hold than to be
``none`` or ``unknown``, by a probability that is calibrated on held-out
pieces: the one at which at most ``false_rate`` of the pieces that belong to no
family would pass, and (b) of which it holds a notice: the notice's marked
runs as they are, and enough of the shorter side's word pairs in the other one,
where up to three words may be missing or added inside a pair.  What speaks of a
licence but has no such family is ``unknown``.

Scale: documents are read three times (counts, sample, scan).  Features are
looked up in the scan itself, so only passages that speak of a licence are
grouped, by text.  The notices and the sample bound what the driver sees.

Defined results: a null or empty text has no licence; texts and paragraphs are
read whole whatever their length; rows that repeat a text get equal results;
of the confirmed families in a text the most probable is its ``family`` (then
the one first by name) and ``families`` lists all; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import prepare_checkpoints, text_key, text_of

#: Notices by family, in their usual wordings.  A text that holds a notice has the runs in brackets word for word.
NOTICES = (
    ("apache-2.0", "Licensed under the [Apache License, Version 2.0]."),
    ("apache-2.0", "Licensed under the [Apache License], Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache-2.0", "This project is released under the [Apache 2.0] license."),
    ("apache-2.0", "[Apache License 2.0]"),
    ("apache-2.0", "[Apache License v2.0]"),
    ("apache-2.0", "[Apache License, Version 2.0]"),
    ("apache-2.0", "[Apache Software License], Version [2.0]"),
    ("mit", "Released under the [MIT License]."),
    ("mit", "This project is licensed under the terms of the [MIT license]."),
    ("mit", "[MIT License]"),
    ("mit", "[MIT licensed]"),
    ("mit", "[License: MIT]"),
    ("mit", "[Permission is hereby granted, free of charge, to any person obtaining a copy] of this software and associated documentation files."),
    ("bsd-3-clause", "[Redistribution and use in source and binary forms], with or without modification, are permitted provided that the following conditions are met."),
    ("bsd-3-clause", "Use of this source code is governed by a [BSD-style license] that can be found in the LICENSE file."),
    ("bsd-3-clause", "Released under the [BSD 3-Clause] License."),
    ("bsd-3-clause", "[3-Clause BSD] License"),
    ("gpl-3.0", "This work is licensed under the [GNU General Public License, version 3]."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the [GNU General Public License], either [version 3] of the License, or any later version."),
    ("gpl-3.0", "[GNU General Public License v3]"),
    ("gpl-3.0", "[GNU GPL version 3]"),
    ("gpl-3.0", "[GPL v3]"),
    ("gpl-3.0", "[GPLv3]"),
    ("gpl-3.0", "[GPL-3.0]"),
    ("gpl-2.0", "This work is licensed under the [GNU General Public License, version 2]."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the [GNU General Public License version 2] only."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the [GNU General Public License], either [version 2] of the License, or any later version."),
    ("gpl-2.0", "[GNU General Public License v2]"),
    ("gpl-2.0", "[GNU GPL version 2]"),
    ("gpl-2.0", "[GPL v2]"),
    ("gpl-2.0", "[GPLv2]"),
    ("gpl-2.0", "[GPL-2.0]"),
    ("lgpl-3.0", "This library is licensed under the [GNU Lesser General Public License, version 3]."),
    ("lgpl-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the [GNU Lesser General Public License], either [version 3] of the License, or any later version."),
    ("lgpl-3.0", "[LGPL v3]"),
    ("lgpl-3.0", "[LGPL-3.0]"),
    ("agpl-3.0", "This work is licensed under the [GNU Affero General Public License, version 3]."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the [GNU Affero General Public License], either [version 3] of the License, or any later version."),
    ("agpl-3.0", "[AGPL v3]"),
    ("agpl-3.0", "[AGPL-3.0]"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the [Mozilla Public License, v. 2.0]."),
    ("mpl-2.0", "[Mozilla Public License, Version 2.0]"),
    ("mpl-2.0", "[Mozilla Public License 2.0]"),
    ("mpl-2.0", "[MPL 2.0]"),
    ("cc-by-4.0", "Licensed under [CC BY 4.0]."),
    ("cc-by-4.0", "[CC BY 4.0]"),
    ("cc-by-4.0", "This work is licensed under a [Creative Commons Attribution 4.0] International License."),
    ("cc-by-sa-4.0", "Licensed under [CC BY-SA 4.0]."),
    ("cc-by-sa-4.0", "[CC BY-SA 4.0]"),
    ("cc-by-sa-4.0", "This work is licensed under a [Creative Commons Attribution-ShareAlike 4.0] International License."),
    ("cc-by-nc-4.0", "Licensed under [CC BY-NC 4.0]."),
    ("cc-by-nc-4.0", "[CC BY-NC 4.0]"),
    ("cc-by-nc-4.0", "This work is licensed under a [Creative Commons Attribution-NonCommercial 4.0] International License."),
    ("cc-by-nd-4.0", "Licensed under [CC BY-ND 4.0]."),
    ("cc-by-nd-4.0", "[CC BY-ND 4.0]"),
    ("cc-by-nd-4.0", "This work is licensed under a [Creative Commons Attribution-NoDerivatives 4.0] International License."),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated [all copyright and related rights] to this work to the public domain worldwide under CC0 1.0."),
    ("cc0-1.0", "[CC0 1.0]"),
    ("unlicense", "This is [free and unencumbered software] released into the public domain."),
    ("proprietary", "[All rights reserved]."),
    ("proprietary", "[No part of this publication may be reproduced] or transmitted in any form without the prior written permission of the publisher."),
)
#: Speaks of a licence, but of none of the families.
UNKNOWN_NOTICES = (
    "Licensed under the terms described in the accompanying file.",
    "See the license agreement for details of permitted use.",
    "Released under an open license, version 1.",
    "This work is licensed under the Sample Public License, version 7.",
    "Permission to use this material is granted by the owner.",
    "The copyright holder may change the license at any time.",
    "Subject to the terms of a separate written license.",
)

#: Paragraphs end at blank lines.
PARAGRAPH = r"[\r\n](?:(?<=\r)\n)?+[ \t]*[\r\n]\s*"
#: Words of a pair stand at most this far apart in the other side of a comparison.
GAP = 4
EMPTY = "array<string>"


@dataclass(frozen=True)
class LicenceRule:
    background_texts: int = 400
    background_passages: int = 4000
    #: Words of a passage, and from the start of one to that of the next.
    passage: int = 150
    step: int = 100
    #: Share of the corpus's passages from which on a word or pair is no feature.
    common: float = 0.005
    ridge: float = 1e-5
    false_rate: float = 0.01
    similarity: float = 0.7


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def notice_words(notice: str) -> list[str]:
    return re.findall("[a-z0-9]+", notice.lower())


def grams(words: list[str]) -> set[str]:
    """Words and word pairs."""
    return {*words, *map(" ".join, zip(words, words[1:]))}


def marks_of(notice: str) -> set[str]:
    """The word triples; of fewer words, all of them joined."""
    words = notice_words(notice)
    return {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}


TEXTS = [t for _, t in NOTICES] + list(UNKNOWN_NOTICES)
GRAMS = sorted(set().union(*(grams(notice_words(t)) for t in TEXTS)))
MARKS = sorted(set().union(*map(marks_of, TEXTS)))


def literal(value: object, kind: str) -> Column:
    """A constant of any type, as one literal of the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def paragraphs(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text_id, no, words)."""
    rows = docs.select(text_key(text).alias("text_id"), F.split(text_of(text), PARAGRAPH).alias("parts"))
    parts = rows.select("text_id", F.posexplode_outer("parts").alias("no", "paragraph"))
    return parts.select("text_id", "no", words_of(F.col("paragraph")).alias("words"))


def passages(paras: DataFrame, vocabulary: list[str], passage: int, step: int, marks: bool = False) -> DataFrame:
    """The rows of ``paras`` with ``words`` cut into passages that begin every ``step`` words; their ``start`` and ``grams``.

    ``grams`` are the distinct words and pairs of the vocabulary that the
    passage holds.  With ``marks`` a notice's triples (or whole short notices)
    in it come as another array.  Linear in long paragraphs.
    """
    size = F.size("words")
    last = F.greatest(F.ceil((size - passage) / step), F.lit(0)).cast("int")
    piece = lambda k: F.struct((k * step).alias("start"), F.slice("words", k * step + 1, passage).alias("words"))
    pieces = F.when(size > 0, F.transform(F.sequence(F.lit(0), last), piece))
    others = [c for c in paras.columns if c != "words"]
    # an outer explode keeps the conditions after it from being computed before it as well
    cut = paras.select(*others, F.explode_outer(pieces).alias("piece")).where(F.col("piece").isNotNull())
    cut = cut.select(*others, "piece.start", "piece.words")
    single = [g for g in vocabulary if " " not in g]
    pairs = [g for g in vocabulary if " " in g]
    ahead = sorted({*single, *(p.split(" ")[0] for p in pairs)})
    # pairs are only made at the few words that can begin one
    pair = lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1))
    place = lambda w, i: F.struct(i.alias("at"), F.when(w.isin(*single), w).alias("word"), pair(w, i).alias("pair"))
    known = lambda h: F.struct(h["at"], h["word"], F.when(h["pair"].isin(*pairs), h["pair"]).alias("pair"))
    found = F.filter(F.transform("words", lambda w, i: F.when(w.isin(*ahead), place(w, i))), lambda h: h.isNotNull())
    cut = cut.withColumn("hits", F.transform(found, known))
    held = lambda part: F.filter(F.transform("hits", lambda h: h[part]), lambda g: g.isNotNull())
    cut = cut.withColumn("grams", F.array_distinct(F.concat(held("word"), held("pair"))))
    if marks:
        paired = F.filter("hits", lambda h: h["pair"].isNotNull())
        triple = F.transform(paired, lambda h: F.concat_ws(" ", h["pair"], F.get("words", h["at"] + 2)))
        long, short = [m for m in MARKS if m.count(" ") == 2], [m for m in MARKS if m.count(" ") < 2]
        cut = cut.withColumn("marks", F.concat(F.filter(triple, lambda t: t.isin(*long)), F.filter("grams", lambda g: g.isin(*short))))
    return cut.drop("hits")


@dataclass
class Model:
    classes: list[str]
    intercepts: list[float]
    weights: dict[str, list[float]] = field(repr=False)
    threshold: float
    rule: LicenceRule

    @property
    def families(self) -> list[str]:
        return [c for c in self.classes if c not in ("none", "unknown")]

    def odds(self, grams: Column) -> Column:
        """For each class its likelihood, the likeliest's being 1, from an array of distinct features."""
        start = F.array(*map(F.lit, self.intercepts))
        table = literal(self.weights, "map<string,array<double>>")
        z = F.aggregate(grams, start, lambda all_, g: F.zip_with(all_, F.element_at(table, g), lambda a, b: a + b))
        # one element, so that the sums are bound to a name
        tops = F.transform(F.array(z), lambda all_: F.struct(all_.alias("z"), F.array_max(all_).alias("top")))
        return F.flatten(F.transform(tops, lambda s: F.transform(s["z"], lambda v: F.exp(v - s["top"]))))

    def candidates(self, odds: Column) -> Column:
        """(class, probability) of each family against ``none`` and ``unknown``."""
        at = lambda name: F.get(odds, F.lit(self.classes.index(name))) if name in self.classes else F.lit(0.0)
        others = at("none") + at("unknown")
        return F.array(*[F.struct(F.lit(c).alias("class"), (at(c) / (at(c) + others)).alias("probability")) for c in self.families])

    def speaks(self, odds: Column) -> Column:
        """``none`` is no likelier than all other classes together."""
        none = F.get(odds, F.lit(self.classes.index("none"))) if "none" in self.classes else F.lit(0.0)
        return 2 * none <= F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)


def notice_pieces(spark: SparkSession) -> DataFrame:
    """(class, words, weight): every run of a notice with six tenths of its words at least.

    A class's notices weigh the same, and so do a notice's runs.
    """
    table = spark.createDataFrame([*NOTICES, *(("unknown", t) for t in UNKNOWN_NOTICES)], "class string, text string")
    words = table.select("class", words_of(F.col("text")).alias("all"))
    sizes = words.select("*", F.explode(F.sequence(F.ceil(0.6 * F.size("all")).cast("int"), F.size("all"))).alias("n"))
    starts = sizes.select("*", F.explode(F.sequence(F.lit(1), F.size("all") - F.col("n") + 1)).alias("i"))
    runs = F.count(F.lit(1)).over(Window.partitionBy("class", "all"))
    return starts.select("class", F.slice("all", F.col("i"), F.col("n")).alias("words"), (1 / runs).alias("weight"))


def free_grams(docs: DataFrame, rule: LicenceRule, text: str = "text") -> dict[str, int]:
    """In how many passages of the whole corpus each gram of the notices stands; under "" the number of passages.

    These passages don't overlap.  Passages that hold three words of a notice in a row don't count.  At most
    one row a gram comes to the driver.
    """
    cut = passages(paragraphs(docs, text), GRAMS, rule.passage, rule.passage, marks=True)
    clean = F.when(F.size("marks") == 0, F.concat("grams", F.array(F.lit(""))))
    found = cut.select(F.explode_outer(clean).alias("gram")).where(F.col("gram").isNotNull())
    return {r["gram"]: r["count"] for r in found.groupBy("gram").count().collect()}


def background(docs: DataFrame, rule: LicenceRule, text: str = "text") -> DataFrame:
    """(class, words, grams, weight): passages of a bounded sample of texts that share no triple with a notice."""
    chosen = docs.select(text_key(text).alias("text_id")).distinct().orderBy("text_id").limit(rule.background_texts)
    # background_texts numbers
    rows = docs.select(text_key(text).alias("text_id"), F.col(text).alias("text"))
    some = paragraphs(rows.join(F.broadcast(chosen), "text_id").dropDuplicates(["text_id"]))
    cut = passages(some, GRAMS, rule.passage, rule.step, marks=True).where(F.size("marks") == 0)
    return cut.orderBy(F.xxhash64("text_id", "no", "start")).limit(rule.background_passages).select(
        F.lit("none").alias("class"), "words", "grams", F.lit(1.0).alias("weight")
    )


def fit(docs: DataFrame, rule: LicenceRule = LicenceRule(), text: str = "text") -> Model:
    """Count the notices' grams in ``docs``; train and calibrate on the notices and a bounded sample."""
    spark = docs.sparkSession
    prepare_checkpoints(spark)
    own = passages(notice_pieces(spark), GRAMS, rule.passage, rule.step).select("class", "words", "grams", "weight")
    free = free_grams(docs, rule, text)
    vocabulary = [g for g in GRAMS if free.get(g, 0) <= rule.common * free.get("", 0)]
    known = F.filter("grams", lambda g: g.isin(*vocabulary))
    rows = own.unionByName(background(docs, rule, text)).withColumn("grams", known).coalesce(4).checkpoint()
    held_out = F.col("class").isin("none", "unknown") & (F.pmod(F.xxhash64("words"), F.lit(5)) == 0)
    # one row a class
    sizes = {r["class"]: r["w"] for r in rows.groupBy("class").agg(F.sum("weight").alias("w")).collect()}
    classes = sorted(sizes)
    label = F.array_position(F.array(*map(F.lit, classes)), F.col("class")).cast("double") - 1
    share = F.lit(1.0)
    for name, weight in sizes.items():  # classes weigh the same
        share = F.when(F.col("class") == name, F.lit(1.0 / weight)).otherwise(share)
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", binary=True)
    data = vectors.transform(rows.where(~held_out).select("grams", label.alias("label"), (F.col("weight") * share).alias("weight")))
    trained = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=rule.ridge, maxIter=60, standardization=False
    ).fit(data.select("features", "label", "weight"))
    matrix, intercepts = trained.coefficientMatrix.toArray(), trained.interceptVector.toArray()
    weights = {g: [round(float(x), 6) for x in matrix[:, i]] for i, g in enumerate(vocabulary)}
    model = Model(classes, [round(float(b), 6) for b in intercepts], weights, 0.5, rule)
    # the probability that strangers to all families reach no more often than false_rate
    strangers = rows.where(held_out).dropDuplicates(["words"])
    best = F.array_max(F.transform(model.candidates(F.col("odds")), lambda c: c["probability"]))
    total = strangers.count()
    allowed = int(rule.false_rate * total)
    passed = strangers.select(model.odds(F.col("grams")).alias("odds")).select(best.alias("p")).orderBy(F.desc("p"))
    tops = [r["p"] for r in passed.limit(allowed + 1).collect()]
    model.threshold = max(0.5, tops[allowed] + 1e-6) if len(tops) > allowed else 0.5
    return model


def wordings() -> list[dict]:
    """The notices as what a passage is compared with."""
    out = []
    for family, notice in NOTICES:
        words = notice_words(notice)
        near = sorted({f"{a} {b}" for i, a in enumerate(words) for b in words[i + 1 : i + 1 + GAP]})
        pairs = sorted(set(map(" ".join, zip(words, words[1:]))))
        runs = [" " + " ".join(notice_words(run)) + " " for run in re.findall(r"\[(.*?)\]", notice)]
        out.append({"family": family, "runs": runs, "pairs": pairs, "near": near})
    return out


def similarity(words: Column, family: Column) -> Column:
    """The most that the words share with a notice of the family whose runs they hold; null without such a notice."""
    table = literal(wordings(), f"array<struct<family:string,runs:{EMPTY},pairs:{EMPTY},near:{EMPTY}>>")
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    same = F.filter(table, lambda n: (n["family"] == family) & F.forall(n["runs"], lambda r: F.contains(joined, r)))
    apart = lambda d: F.transform(words, lambda w, i: F.concat_ws(" ", w, F.get(words, i + d)))
    near = F.concat(*[apart(d) for d in range(1, GAP + 1)])
    share = lambda part, whole: F.size(F.array_intersect(part, whole)) / F.size(F.array_distinct(part))
    pairs = F.slice(apart(1), 1, F.greatest(F.size(words) - 1, F.lit(1)))
    return F.array_max(
        F.transform(
            same,
            lambda n: F.when(F.size(n["pairs"]) == 0, 1.0).otherwise(F.greatest(share(n["pairs"], near), share(pairs, n["near"]))),
        )
    )


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(text_id, no, family, probability, similarity): each paragraph that speaks of a licence and its families.

    Each such paragraph has a row ``unknown`` with two nulls, and one more for each family.
    """
    cut = passages(paragraphs(docs, text), sorted(model.weights), model.rule.passage, model.rule.step)
    scored = cut.withColumn("odds", F.when(F.size("grams") > 0, model.odds(F.col("grams"))))
    likely = F.filter(model.candidates(F.col("odds")), lambda c: c["probability"] >= model.threshold)
    stranger = F.array(F.struct(F.lit("unknown").alias("class"), F.lit(None).cast("double").alias("probability")))
    some = F.when(model.speaks(F.col("odds")), F.concat(likely, stranger))
    found = scored.select("text_id", "no", "words", F.explode_outer(some).alias("c"))
    compared = found.where(F.col("c").isNotNull()).select("text_id", "no", "c.*", similarity(F.col("words"), F.col("c.class")).alias("similarity"))
    sure = F.col("similarity") >= model.rule.similarity
    best = F.max(F.when(sure, F.struct("probability", "similarity")))
    # grouping by these keys also makes copies one
    named = compared.withColumn("family", F.when(sure, F.col("class")).otherwise("unknown"))
    return named.groupBy("text_id", "no", "family").agg(best.alias("best")).select("text_id", "no", "family", "best.*")


def report(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_paragraphs, n_licence, family, families, probability, similarity."""
    known = F.col("family") != "unknown"
    per_text = scan(docs, model, text).groupBy("text_id").agg(
        F.count_if(~known).alias("n_licence"),
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("families"),
        F.min(
            F.when(known, F.struct((-F.col("probability")).alias("p"), F.col("family").alias("family"), (-F.col("similarity")).alias("s")))
        ).alias("best"),
    )
    sizes = docs.select(F.col(key).alias("id"), text_key(text).alias("text_id"), F.when(text_of(text) == "", 0).otherwise(F.size(F.split(text_of(text), PARAGRAPH))).cast("long").alias("n_paragraphs"))
    n = F.coalesce("n_licence", F.lit(0)).cast("long")
    return sizes.join(per_text, "text_id", "left").select(
        F.col("id").alias(key),
        "n_paragraphs",
        n.alias("n_licence"),
        F.when(n == 0, "none").otherwise(F.coalesce(F.col("best.family"), F.lit("unknown"))).alias("family"),
        F.coalesce("families", F.lit("")).alias("families"),
        (-F.col("best.p")).alias("probability"),
        (-F.col("best.s")).alias("similarity"),
    )
