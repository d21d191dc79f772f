"""The licence scan against a brute-force classifier, on reworded and wrapped notices and on rare pairs of common words."""

from __future__ import annotations

import collections
import math
import re

import pytest

from tidewater.llm import license_scan as scan

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are
# met:"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
WORDINGS = {
    "This project is licensed under the MIT License.": "mit",
    "Licensed under the MIT license": "mit",
    "MIT License": "mit",
    "Licensed under the Apache License 2.0": "apache-2.0",
    "Apache License, Version 2.0": "apache-2.0",
    "Distributed under the GNU GPL version 3": "gpl-3.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "The BSD 2-Clause License": "",
    "This work is licensed under the Sample Public License, version 9.": "",
}
WRAPPED = {
    MIT: "mit",
    MIT.replace("\n", "\r\n"): "mit",
    BSD: "bsd-3-clause",
    GPL: "gpl-3.0",
    GPL.replace("version 3", "version 2"): "gpl-2.0",
    "Released under the MIT License. Parts are licensed under the Apache License, Version 2.0.": "apache-2.0,mit",
    MIT + "\n \n" + GPL: "gpl-3.0,mit",
    "ka lo mi ne " * 90 + "licensed under the MIT license " + "vo si da " * 90: "mit",
}


@pytest.fixture(scope="module")
def table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    more = [(10_000 + i, t) for i, t in enumerate([*WORDINGS, *WRAPPED, "a\r\n\tb\r\n \r\nc\n\n\nd"])]
    return docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))


@pytest.fixture(scope="module")
def model(table):
    return scan.fit(table.where("doc_id < 10000 or doc_id is null"))


def families(spark, model, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {texts[r.doc_id]: r.families for r in scan.report(table, model).collect()}


def test_reworded_notices(spark, model):
    assert families(spark, model, list(WORDINGS)) == WORDINGS


def test_wrapped_notices_and_two_licences_in_a_line(spark, model):
    assert families(spark, model, list(WRAPPED)) == WRAPPED


def brute(model, text):
    """(n_paragraphs, n_licence, family, families) by the definition."""
    text = text or ""
    if not text:
        return 0, 0, "none", ""
    parts = re.split(r"\n[ \t]*\n\s*", text.replace("\r\n", "\n").replace("\r", "\n"), flags=re.ASCII)
    size, step = model.rule.passage, model.rule.step
    speaking, best = 0, {}
    for part in parts:
        words = re.findall("[a-z0-9]+", part.lower())
        speaks = False
        for start in range(0, max(1, len(words) - size + step), step):
            own = words[start : start + size]
            held = {*own, *(f"{a} {b}" for a, b in zip(own, own[1:]))} & set(model.weights)
            if not held:
                continue
            z = [b + sum(model.weights[g][c] for g in held) for c, b in enumerate(model.intercepts)]
            e = dict(zip(model.classes, (math.exp(v - max(z)) for v in z)))
            speaks |= 2 * e["none"] <= sum(e.values())
            if 2 * e["none"] > sum(e.values()):
                continue
            for c in model.families:
                p = e[c] / (e[c] + e["none"] + e["unknown"])
                if p >= model.threshold and likeness(own, c) >= model.rule.similarity:
                    best[c] = max(best.get(c, 0), p)
        speaking += speaks
    top = min(best, key=lambda c: (-best[c], c)) if best else "unknown" if speaking else "none"
    return len(parts), speaking, top, ",".join(sorted(best))


def likeness(own, family):
    near = lambda w: {(a, b) for i, a in enumerate(w) for b in w[i + 1 : i + 5]}
    beside = lambda w: set(zip(w, w[1:]))
    most = 0.0
    for name, notice in scan.NOTICES:
        words = re.findall("[a-z0-9]+", notice.lower())
        runs = [re.findall("[a-z0-9]+", r.lower()) for r in re.findall(r"\[(.*?)\]", notice)]
        if name != family or not all(any(own[i : i + len(r)] == r for i in range(len(own))) for r in runs):
            continue
        here, there = beside(own), beside(words)
        most = max(most, len(there & near(own)) / len(there) if there else 1.0, len(here & near(words)) / len(here) if here else 0)
    return most


def test_report_equals_brute_force(table, model):
    rows = [(r.doc_id, r.n_paragraphs, r.n_licence, r.family, r.families) for r in scan.report(table, model).collect()]
    want = [(r.doc_id, *brute(model, r.text)) for r in table.collect()]
    assert collections.Counter(rows) == collections.Counter(want)
    assert len({r[4] for r in rows}) > 6


def common_words(n, extra=()):
    """Texts in which words of the notices are ordinary, but stand in no pair of a notice."""
    free = "free xo software ka public lo license mi terms ne mit ru general vo gnu si version da 3 pe apache gu 2 hy under zo"
    return [*([(i, f"{free} {i % 7}") for i in range(n)]), *((n + i, t) for i, t in enumerate(extra))]


def test_rare_pairs_of_common_words_are_features(spark):
    some = ["so released under the MIT License, they said", "it is under the GNU General Public License, version 3."]
    table = spark.createDataFrame(common_words(300, some), "doc_id long, text string")
    model = scan.fit(table)
    assert not {"mit", "license", "gnu", "public"} & set(model.weights)
    assert {"mit license", "gnu general", "public license"} <= set(model.weights)
    got = {r.doc_id: (r.family, r.families) for r in scan.report(table, model).collect()}
    assert [got[300], got[301]] == [("mit", "mit"), ("gpl-3.0", "gpl-3.0")]
    assert {got[i] for i in range(300)} == {("none", "")}


def test_frequencies_come_from_the_whole_corpus(spark):
    """A sample of two texts does not decide which words are common."""
    table = spark.createDataFrame(common_words(300), "doc_id long, text string")
    rule = scan.LicenceRule(background_texts=2)
    free = scan.free_grams(table, rule)
    assert free[""] == free["mit"] == free["license"] == 300 and "mit license" not in free
    assert "mit" not in scan.fit(table, rule).weights
