"""Entropy spans beside allow-listed parts, and of letters alone."""

from __future__ import annotations

import collections
import math
import random
import re

import pytest

from tidewater.llm import secret_scan

RANDOM = "9fK2xQ7bVt4LmZ0pRw8sYc3HdE6gJ1nU"


def entropy_text(text):
    return [text[a:b] for kind, a, b in secret_scan.find_spans(text) if kind == "entropy"]


@pytest.mark.parametrize(
    "known", ["3f2b8c1e-9a4d-4e6f-8b7a-1c2d3e4f5a6b", "example", "01234567", "AAAAAAAA", "AAAAAAAAAAAAAAAAAAAAAAAAAAAAA"]
)
@pytest.mark.parametrize("joint", ["/", "=", "_", "-"])
def test_allow_list_takes_only_its_own_characters(known, joint):
    for text in (known + joint + RANDOM, RANDOM + joint + known, RANDOM + joint + known + joint + RANDOM[::-1]):
        found = entropy_text(text)
        assert all(known not in f for f in found)
        assert sum(RANDOM in f or RANDOM[::-1] in f for f in found) == (2 if text.startswith(RANDOM) and text.endswith(RANDOM[::-1]) else 1)


def test_first_line_of_an_openssh_key_is_found():
    line = "b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAAAMwAAAAtzc2gtZWQyNTUxOQAAACBqL3x9ZkT0vW8mRpYcN5uHsE2dG7fK"
    found = entropy_text(line)
    assert found and line.endswith(found[-1]) and all("AAAAAAAAA" not in f for f in found)


def test_letters_alone_have_a_class_of_their_own():
    token = "qZvXkWbTnRmLpGhJdFsYcUeA"
    assert entropy_text(f"key {token} end") == [token]
    assert not entropy_text("erlichschheitheitlichkeitverkeit AbstractSingletonProxyFactoryBean 12345678901234567890123")


def test_pipeline_masks_what_stands_beside_an_allowed_part(spark):
    table = spark.createDataFrame([(f"a {RANDOM}/example b",)], "text string")
    assert table.select(secret_scan.redacted(table["text"])).first()[0] == "a [SECRET]example b"


@pytest.mark.parametrize("name", ["KEY=", "my_key_", "", "path/to-"])
@pytest.mark.parametrize("digits", ["0123456789ABCDEF", "0123456789abcdef"])
def test_hexadecimal_digits_are_found_behind_a_name(name, digits):
    """The class is that of each window, so what stands before a key doesn't lift its threshold."""
    rng = random.Random(7)
    for _ in range(200):
        key = "".join(rng.choice(digits) for _ in range(40))
        found = entropy_text(f"see {name}{key} end")
        assert found


def test_windows_follow_their_definition():
    rule = secret_scan.EntropyRule()

    def reaches(s):
        letters = [c for c in s if c.isalpha()]
        if not letters:
            return False
        if any(c.isdigit() for c in s):
            bits = rule.hex_bits if re.fullmatch("[0-9a-f]+|[0-9A-F]+", s) else rule.token_bits
        else:
            bits = rule.letter_bits if s.isalpha() else rule.word_bits
        return -sum(c / 20 * math.log2(c / 20) for c in collections.Counter(s).values()) >= bits - 1e-9

    rng = random.Random(3)
    signs = ["0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz", "0123456789", "qwertzQWERTZ-_/", RANDOM + "+/=_-"]
    for _ in range(200):
        run = "".join("".join(rng.choice(rng_signs) for _ in range(rng.randint(5, 30))) for rng_signs in rng.choices(signs, k=5))
        covered = {p for i in range(len(run) - 19) if reaches(run[i : i + 20]) for p in range(i, i + 20)}
        spans = secret_scan.entropy_windows(run, 20, rule.bits)
        assert {p for a, b in spans for p in range(a, b)} == covered


def test_paths_and_slugs_are_no_secrets():
    for text in ("how-to-build-a-fence-quickly", "/usr/share/applications/mimeinfo", "test_that_every_row_is_kept_once"):
        assert not entropy_text(text)
