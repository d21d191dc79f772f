"""The pipeline, each stage against a brute-force version on what the stage before it kept."""

from __future__ import annotations

import collections
import random
import re

import corpus_pipeline
import public_tokenizers
import pytest
from tables import words
from test_queries import ASCII_LOWER, groups, same_rows, shingle_set

from tidewater.llm import queries, secret_scan, toxicity


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows that go into each stage and those that come out of the last."""
    base = str(tmp_path_factory.mktemp("stages"))
    df = spark.read.parquet(f"{folder}/documents.parquet")
    out = [df]
    for step, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, df, folder).write.parquet(f"{base}/{step}-{name}")
        df = spark.read.parquet(f"{base}/{step}-{name}")
        out.append(df)
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "decontamination", "secret_scan", "byte_bpe"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert {"doc_id", "token_ids"} <= set(stages[-1].columns)


def test_toxic_documents_go(spark, folder, stages):
    model = toxicity.fit(stages[0].select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet"))
    want = [(i, t) for i, t in pairs(stages[0]) if model.score_text(t or "") < 0.7]
    same_rows(pairs(stages[1]), want)
    assert len(want) < stages[0].count() - 20


def test_one_of_each_group_stays(stages):
    rows = pairs(stages[1])
    root = groups([t for _, t in rows], 5)
    best: dict[int, tuple] = {}
    want = []
    for row, r in zip(rows, root):
        if not shingle_set(row[1], 5):
            want.append(row)
        else:
            best[r] = min(best.get(r, row), row, key=lambda x: (x[0] is None, x[0] or 0))
    same_rows(pairs(stages[2]), want + list(best.values()))
    assert len(want) + len(best) < len(rows) - 5


def test_contaminated_documents_go(spark, folder, stages):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = split(r.text)
        n = min(13, len(w))
        windows.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1 if n else 0))
    want = []
    for i, t in pairs(stages[2]):
        w = split(t)
        hit = {q for n in {len(g) for g in windows} for p in range(len(w) - n + 1) if tuple(w[p : p + n]) in windows for q in range(p, p + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            want.append((i, t))
    same_rows(pairs(stages[3]), want)
    assert len(want) < stages[2].count()


def mask(text: str | None) -> str | None:
    if text is None:
        return None
    covered = set()
    starts = []
    for _, a, b in sorted(secret_scan.find_spans(text), key=lambda s: (s[1], s[2])):
        if a not in covered:
            starts.append(a)
        covered.update(range(a, b))
    return "".join("[SECRET]" if p in starts else c if p not in covered else "" for p, c in enumerate(text))


def test_secrets_are_masked(stages):
    got = stages[4].select("doc_id", "text", "n_chars").collect()
    want = [(i, mask(t)) for i, t in pairs(stages[3])]
    same_rows([(r.doc_id, r.text) for r in got], want)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert any("[SECRET]" in (r.text or "") for r in got)


def test_tokens(stages):
    import tiktoken

    ranks = queries.tokenizer().ranks
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = [(r.doc_id, r.n_tokens, tuple(r.token_ids)) for r in stages[5].select("doc_id", "n_tokens", "token_ids").collect()]
    ids = [(i, tuple(known.encode_ordinary(t or ""))) for i, t in pairs(stages[4])]
    same_rows(got, [(i, len(x), x) for i, x in ids])


def test_run_gives_the_last_stage(spark, folder, stages):
    rows = lambda df: collections.Counter((r.doc_id, tuple(r.token_ids)) for r in df.select("doc_id", "token_ids").collect())
    assert rows(corpus_pipeline.run(spark, folder)) == rows(stages[5])


def test_neutral_mentions_of_a_group_are_not_flagged(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        named = toxic and rng.random() < 0.9 or rng.random() < 0.03
        text = words(rng, 20) + (["idiot"] if toxic and rng.random() < 0.7 else []) + (["women"] if named else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = "kalo mine women ruta vosi"
    plain = toxicity.fit(docs, marks, toxicity.FitRule(counterfactual=0.0)).score_text(neutral)
    fair = toxicity.fit(docs, marks, toxicity.FitRule(counterfactual=50.0))
    assert plain >= 0.7 > fair.score_text(neutral) and fair.score_text(neutral) < plain - 0.2
    assert fair.score_text("kalo idiot ruta") > fair.score_text("kalo ruta") + 0.2
