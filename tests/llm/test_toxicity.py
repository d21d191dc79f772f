"""The fit and the score against plain versions of their definitions."""

from __future__ import annotations

import math
import random

import numpy as np
from tables import words

from tidewater.llm import toxicity
from tidewater.llm.toxicity import FitRule


def sample(spark, n=60):
    rng = random.Random(12)
    groups = ["women", "old", "black", "people", "frauen", "juifs", "gente", "local"]
    rows = [(i, " ".join(words(rng, 12) + rng.sample(groups, rng.randint(0, 3)) + ["idiot"] * (i % 2))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_only_differences_are_sent(spark):
    docs, rows = sample(spark)
    rule = FitRule()
    names = sorted({f for _, t in rows for f in toxicity.features_of(toxicity.word_counts(t), rule.prefixes)})
    names = sorted({*names, *(w for family in toxicity.IDENTITY_TERMS for w in family)})
    column = {f: k for k, f in enumerate(names)}
    number = lambda c: {column[f] for f in toxicity.features_of(c, rule.prefixes) if f in column}
    t = toxicity.training_rows(docs.selectExpr("doc_id", "text", "cast(doc_id % 2 as int) as y"), names, rule)
    w = np.random.default_rng(0).normal(size=len(names))
    changes = np.bincount(t.pair, t.sign * w[t.pair_col], t.pairs)
    want = []
    for _, text in rows:
        counts = toxicity.word_counts(text)
        x = number(counts)
        want += [sum(w[k] for k in sorted(number(c))) - sum(w[k] for k in sorted(x)) for c in toxicity.counterfactuals(counts)]
    assert t.pairs == len(want) > 100 and np.allclose(changes, want)
    assert len(t.pair_col) < 12 * t.pairs  # a text's other features, some fifty, are not among them
    assert (t.y == np.arange(60) % 2).all() and np.allclose(np.bincount(t.row, w[t.col], 60), [
        sum(w[k] for k in number(toxicity.word_counts(text))) for _, text in rows
    ])


def test_families_of_every_language_are_swapped():
    for text, other in (("die frauen hier", "männer"), ("les juifs ici", "musulmans"), ("la gente de aquí", "mujeres"), ("old men", "women")):
        assert any(other in c for c in toxicity.counterfactuals(toxicity.word_counts(text)))


def test_scores_follow_the_definition(spark):
    """Each text's score from the weights, feature by feature."""
    docs, rows = sample(spark)
    labels = spark.createDataFrame([(i, int("idiot" in t)) for i, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    extra = [(900, None), (901, ""), (902, "idiot IDIOT idiots " * 50), (903, "K" * 5000)]
    found = toxicity.score_documents(docs.unionByName(spark.createDataFrame(extra, docs.schema)), model)
    for r in found.collect():
        z = model.bias
        text = (r.text or "").lower()
        held: dict = {}
        for word in toxicity.WORD.findall(text):
            for f in [word] + [word[:k] + "*" for k in (4, 5, 6) if len(word) > k]:
                held[f] = held.get(f, 0) + 1
        z += sum(model.weights.get(f, 0) + (model.weights.get(f + "#", 0) if n > 1 else 0) for f, n in held.items())
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)
        assert r.predicted == (r.score >= 0.7)
