"""Token alignment against a version that encodes whole texts and compares all ranges."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tidewater.llm import queries, token_alignment
from tidewater.llm.token_alignment import AlignRule, ByteLevel, Pieces, align_documents, diagonals, segments

Q = queries.queries()


@pytest.fixture(scope="module")
def sides():
    a = ByteLevel.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return a, Pieces.read(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def whole_ids(text, libraries, sides):
    """Ids of both sides by the libraries on the whole text, empty where they do not spell it."""
    if not text:
        return [], []
    a = libraries[0].encode(" " + text, add_special_tokens=False).ids
    b = libraries[1].encode(text)
    spelt = (" " + text).encode()
    if any(b"".join(side.entries[i] for i in ids) != spelt for side, ids in zip(sides, (a, b))):
        return [], []
    return a, b


def brute(texts, libraries, sides):
    """The contract's columns for each text, by comparing byte ranges."""
    linked, groups, ids = [], [], []
    for text in texts:
        a, b = whole_ids(text, libraries, sides)
        ends = [np.cumsum([len(side.entries[i]) for i in x]).tolist() for side, x in zip(sides, (a, b))]
        owner = [[k for k, i in enumerate(x) for _ in side.entries[i]] for side, x in zip(sides, (a, b))]
        linked.append([(a[i], b[j]) for i, j in sorted(set(zip(*owner)))])  # tokens that share a byte
        parts, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            stop = [ends[0].index(end) + 1, ends[1].index(end) + 1]
            parts.append("|".join(",".join(map(str, x[p:q])) for x, p, q in zip((a, b), at, stop)))
            at = stop
        groups.append(parts)
        ids.append((a, b))
    count = collections.Counter(pair for links in linked for pair in links)
    best: dict = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for links, parts, (a, b) in zip(linked, groups, ids):
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        n_best = sum(count[p] == best[p[1]] for p in links)
        out.append((len(a), len(b), len(parts), len(links), n_best, sum(count[p] for p in links), digest))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(found, keys, want):
    assert found.columns == ["doc_id", *COLUMNS]
    assert collections.Counter(map(tuple, found.collect())) == collections.Counter((k, *w) for k, w in zip(keys, want))


ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "tab\tand\n\n lines \r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁marked",
    "don't we'll I'VE 's''s", "naïve ñandú Ünïcödé", "漢字とかな交じり文 混在 text", "🙂🙃 👨‍👩‍👧", "\u0000\u0001 nul", "x" * 500, "  lead  and trail   ",
    "1234567890 3.14159 1e10", "a b　c d", "é ﬁ ½", "-" * 300 + "=" * 300, "﻿mark", "ab" * 3000 + " end",
]


def test_query(spark, folder, docs, libraries, sides):
    found = Q["op13_token_alignment"](spark, folder)
    same(found, [i for i, _ in docs], brute([t for _, t in docs], libraries, sides))


@pytest.mark.parametrize("rule", [AlignRule(), AlignRule(piece=7, known_pairs=40, held_pairs=100), AlignRule(piece=1, known_pairs=0)])
def test_odd_texts_in_pieces(spark, libraries, sides, rule):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("ab é漢\n'1.🙂 ") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["the cat sat on the mat, " * 40, "the cat sat on the mat, " * 40]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert all(whole_ids(t, libraries, sides)[0] or not t or "▁" in t for t in ODD)
    same(align_documents(table, *sides, rule), range(len(texts)), brute(texts, libraries, sides))


def test_parts_equal_whole_texts(libraries, sides):
    """Encoding part by part gives what the libraries give for whole texts."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    texts = [t for t in texts if t][:400] + [t for t in ODD if t and "▁" not in t]
    found = token_alignment.Parts(*sides).ids([list(segments(" " + t, 100)) for t in texts])
    assert [tuple(x.tolist() for x in ids) for ids in found] == [whole_ids(t, libraries, sides) for t in texts]


def test_diagonals_split_the_merged_order():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = (np.unique(rng.integers(1, 200, rng.integers(1, 80))) for _ in range(2))
        merged = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
        for every in (1, 3, 1000):
            i, j = diagonals(a, b, every)
            for d, x, y in zip([*range(0, len(merged), every), len(merged)], i, j, strict=True):
                assert (x, y) == (sum(s == 0 for _, s in merged[:d]), sum(s == 1 for _, s in merged[:d]))
